from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quotewell.sources import partitions, readers, sinks
from quotewell.sources.schemas import FEEDS
from quotewell.streaming import ingest


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_tsv_by_position(spark, tmp_path):
    path = write(tmp_path / "spot.txt", "\t".join(map(str, range(20))) + "\n" + "\t".join(["x"] * 20) + "\n")
    typed = readers.read_tsv(spark, path)
    assert len(typed.columns) == 16
    assert [typed.schema[c].dataType.simpleString() for c in ("s1", "s5", "s10", "s16")] == ["string", "double", "string", "double"]
    rows = typed.orderBy("s1").collect()
    assert (rows[0].s1, rows[0].s5, rows[0].s13, rows[0].s16) == ("0", 4.0, 13.0, 19.0)
    assert (rows[1].s1, rows[1].s5) == ("x", None)
    text = readers.read_tsv(spark, path, text=None)
    assert text.orderBy("s1").first().s16 == "19"


def test_dimension_and_lists(spark, tmp_path):
    path = write(tmp_path / "prd.csv", "000001.SZ,2,-,Ping\n600000.SH,2,01,Pu\n00700.HK,2,-,-\n")
    assert [tuple(r) for r in readers.read_products(spark, path).collect()] == [("000001", "2", "-", "Ping")]
    assert readers.read_products(spark, path, "SH").first().prdtid == "600000"
    assert readers.read_products(spark, path, None).count() == 3
    diff = write(tmp_path / "diff.txt", "[000001.SZ,20180330093432150,871663]\n\n[000002,20180330093432151,5]\n[000003,bad,x]\n")
    at = datetime(2018, 3, 30, 9, 34, 32, 150000)
    assert [tuple(r) for r in readers.read_diff(spark, diff, "trade").orderBy("securityid").collect()] == [
        ("000001", at, 871663), ("000002", at + timedelta(milliseconds=1), 5), ("000003", None, None)]
    assert readers.read_diff(spark, diff, "index").columns == ["securityid", "ts"]
    kv = write(tmp_path / "a.properties", "# note\nx = 1\ny=a=b\n\n")
    assert sorted(tuple(r) for r in readers.read_kv(spark, kv).collect()) == [("x", "1"), ("y", "a=b")]
    days = write(tmp_path / "days.txt", "20170101\n20170102,new year\n")
    assert [r[0] for r in readers.read_holidays(spark, days).orderBy("trade_date").collect()] == [date(2017, 1, 1), date(2017, 1, 2)]


def test_header_marker_and_sh_types(spark):
    schema = FEEDS["sh"]["trade"]
    raw = spark.createDataFrame([
        ("600000", "2014010209250403", "10.5", "100.000", "1050", "7", "8"), ("HEAD:v1", "", "", "", "", "", ""),
    ], schema)
    row = readers.normalize(raw, "trade", "sh").collect()
    assert len(row) == 1 and row[0].tradeqty == 100 and row[0].price == 10.5
    assert row[0].ts == datetime(2014, 1, 2, 9, 25, 4, 3000) and row[0].clock == 92504003
    assert row[0].trade_date == date(2014, 1, 2)


@pytest.mark.parametrize("name,fmt,feed", [
    ("hdfs://x/am_hq_snap_spot.txt", "new", "snap"), ("am_hq_snap_level.txt", "new", "snap_level"),
    ("am_hq_order.txt", "new", "order"), ("stock_status.txt", "new", "stock_status"), ("readme", "new", None),
    ("d/SNAPSHOTDW_1.txt", "old", "snap_level"), ("d/SnapShot_1.txt", "old", "snap"), ("STOCKSTATUS.txt", "old", "stock_status"),
    ("stockinfo.txt", "old", "stock_info"), ("TRADE.txt", "old", "trade"), ("order/INDEX.txt", "old", "index"),
])
def test_file_routing(spark, name, fmt, feed):
    df = spark.createDataFrame([(name,)], "f string")
    assert df.select(readers.feed_of_file(F.col("f"), fmt)).first()[0] == feed


def test_cells_skip_absent(spark, rows):
    df = spark.createDataFrame([("k1", 1, None), ("k2", 2, "b")], "k string, x int, y string")
    assert rows(readers.scan_cells(df, "k"), "row", "qualifier") == [
        ("k1", "Detail", "x", "1"), ("k2", "Detail", "x", "2"), ("k2", "Detail", "y", "b")]


def days(spark, values):
    return spark.createDataFrame(
        [(date(2024, 1, d), k, v) for d, k, v in values], "trade_date date, k string, v int"
    )


def table(spark, path):
    return sorted((r.trade_date.day, r.k, r.v) for r in spark.read.parquet(path).collect())


def test_upsert_last_write_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(days(spark, [(1, "a", 1), (1, "b", 1), (2, "a", 1)]), path, ["trade_date", "k"])
    late = days(spark, [(1, "b", 7), (1, "b", 8), (3, "c", 9)])
    dry = sinks.upsert(late, path, ["trade_date", "k"], dry_run=True).first()
    assert (dry.n_keys, dry.first_key.k) == (2, "b")
    assert len(table(spark, path)) == 3
    for _ in range(2):
        sinks.upsert(late, path, ["trade_date", "k"], [F.desc("v")])
        assert table(spark, path) == [(1, "a", 1), (1, "b", 8), (2, "a", 1), (3, "c", 9)]
    sinks.upsert_columns(days(spark, [(1, "a", 5), (1, "zz", 6)]), path, ["k"], ["v"])
    assert table(spark, path) == [(1, "a", 5), (1, "b", 8), (2, "a", 1), (3, "c", 9)]


def test_upsert_does_not_depend_on_how_rows_are_dealt(spark, tmp_path):
    found = []
    for n in (1, 8):
        path = str(tmp_path / f"t{n}")
        rows = days(spark, [(1 + i % 2, f"k{i % 5}", (i * 7919) % 400) for i in range(400)]).repartition(n)
        sinks.upsert(rows, path, ["trade_date", "k"])
        found.append(table(spark, path))
    assert found[0] == found[1] and len(found[0]) == 10
    sinks.upsert_columns(days(spark, [(1, "k0", 1), (1, "k0", 2)]), path, ["k"], ["v"])
    assert len(table(spark, path)) == 10 and (1, "k0", 2) in table(spark, path)


def test_upsert_keeps_absent_cells(spark, tmp_path):
    path = str(tmp_path / "t")
    two = lambda *rows: spark.createDataFrame(rows, "k string, a long, b long").withColumn("trade_date", F.lit(date(2024, 1, 1)))
    sinks.upsert(two(("x", 1, 2), ("y", 3, 4)), path, ["trade_date", "k"])
    sinks.upsert(two(("x", None, 9), ("z", None, 5)).drop("a"), path, ["trade_date", "k"], keep_absent=True)
    got = sorted((r.k, r.a, r.b) for r in spark.read.parquet(path).collect())
    assert got == [("x", 1, 9), ("y", 3, 4), ("z", None, 5)]
    sinks.upsert(two(("x", None, 7)), path, ["trade_date", "k"])
    assert sorted((r.k, r.a, r.b) for r in spark.read.parquet(path).collect())[0] == ("x", None, 7)


def test_replace_range_and_days(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_partition(days(spark, [(d, "a", d) for d in (1, 2, 3, 4)]), path)
    with pytest.raises(ValueError):
        sinks.replace_range(days(spark, [(2, "n", 0), (9, "out", 0)]), path, "2024-01-02", "2024-01-03", "trade_date")
    assert len(table(spark, path)) == 4
    sinks.replace_range(days(spark, [(2, "n", 0)]), path, "2024-01-02", "2024-01-03", "trade_date")
    assert table(spark, path) == [(1, "a", 1), (2, "n", 0), (4, "a", 4)]
    sinks.replace_partition(days(spark, [(4, "x", 1)]), path)
    assert table(spark, path) == [(1, "a", 1), (2, "n", 0), (4, "x", 1)]
    pruned = readers.read_day(spark, path, "20240102", "20240104")
    assert pruned.count() == 2
    scan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in scan
    sinks.replace_all(days(spark, [(1, "z", 1)]), str(tmp_path / "all"))
    sinks.write_by_security(days(spark, [(1, "z", 1)]).withColumnRenamed("k", "securityid"), str(tmp_path / "by"))
    assert spark.read.parquet(str(tmp_path / "by")).first().securityid == "z"


def test_catalog_partitions(spark, tmp_path):
    path = str(tmp_path / "feed")
    sinks.replace_partition(days(spark, [(d, "a", d) for d in (1, 2, 3)]), path)
    spark.sql(f"CREATE TABLE feed_t (k string, v int, trade_date date) USING parquet PARTITIONED BY (trade_date) LOCATION '{path}'")
    spark.sql("MSCK REPAIR TABLE feed_t")
    got = [r[0].day for r in partitions.list_days(spark, "feed_t", "2024-01-02").collect()]
    assert got == [2, 3]
    sinks.replace_partition(days(spark, [(5, "late", 5)]), path)
    partitions.refresh_partitions(spark, ["feed_t"], "2024-01-01", "2024-01-31")
    assert spark.table("feed_t").count() == 4
    assert partitions.purge_partitions(spark, ["feed_t"], "2024-01-01", "2024-01-02") == ["feed_t/2024-01-01", "feed_t/2024-01-02"]
    assert spark.table("feed_t").count() == 4
    partitions.purge_partitions(spark, ["feed_t"], "2024-01-01", "2024-01-02", confirm=True)
    assert [r[0].day for r in partitions.list_days(spark, "feed_t").collect()] == [3, 5]
    partitions.analyze(spark, "feed_t")
    ranged = partitions.run_range(lambda d: d.groupBy("trade_date").count(), spark.table("feed_t"), "2024-01-03", "2024-01-04")
    assert ranged.count() == 1
    assert partitions.calendar_days(spark, "2024-01-01", "2024-01-31").count() == 31
    spark.sql("DROP TABLE feed_t")


def test_stage_day(spark, tmp_path):
    raw = write(tmp_path / "raw" / "x_trade.txt", "\n".join(
        f"00000{i}\t2018033010000{i}000\tM\t{i}\t1\t2\tF\t10.0\t5" for i in range(3)))
    target = str(tmp_path / "trade")
    partitions.stage_day(spark, raw, target, "trade", prepare_only=True)
    assert sinks.read_if_exists(spark, target) is None
    partitions.stage_day(spark, raw, target, "trade")
    assert readers.read_day(spark, target, "20180330").count() == 3


def test_ingest_waits_for_marker_and_loads_once(spark, tmp_path):
    line = "000001\t20180330100000{}\tM\t1\t1\t2\tF\t10.0\t5\n"
    write(tmp_path / "in" / "20180330" / "am_hq_trade.txt", line.format("000") + line.format("001"))
    write(tmp_path / "in" / "20180330" / "am_hq_order.txt", "ignored by the trade feed\n")
    write(tmp_path / "in" / "20180331" / "am_hq_trade.txt", line.format("002").replace("20180330", "20180331"))
    write(tmp_path / "in" / "20180330" / "ok", "")
    target = str(tmp_path / "trade")

    def run():
        return ingest.ingest_feeds(spark, str(tmp_path / "in"), {"trade": target}, str(tmp_path / "cp"), feeds=["trade"])

    assert run() == ["20180330"] and spark.read.parquet(target).count() == 2
    assert run() == ["20180330"] and spark.read.parquet(target).count() == 2
    write(tmp_path / "in" / "20180330" / "notes.txt", "of no feed\n")
    refused = ingest.refused_files(spark, str(tmp_path / "in"), ["20180330"]).collect()
    assert [r.path.rsplit("/", 1)[-1] for r in refused] == ["notes.txt"]
    write(tmp_path / "in" / "20180331" / "ok", "")
    assert run() == ["20180330", "20180331"]
    got = spark.read.parquet(target).groupBy("trade_date").count().orderBy("trade_date").collect()
    assert [(r[0].day, r[1]) for r in got] == [(30, 2), (31, 1)]


def test_repeated_batch_adds_nothing(spark, tmp_path):
    store = ingest.append_by_batch(str(tmp_path / "t"))
    batch = days(spark, [(1, "a", 1), (2, "b", 2)])
    store(batch, 0)
    store(batch, 0)
    store(batch, 1)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
