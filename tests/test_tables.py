"""Bucketed, clustered and manifest-loaded tables."""

import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quotewell.sources import bucketed, manifest, readers, sinks
from quotewell.streaming import ingest

DAY = date(2018, 3, 1)


def table_of(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:10]}"
    return name, str(tmp_path / name)


def keyed(spark, values):
    return spark.createDataFrame([(k, DAY + timedelta(d), v, w) for k, d, v, w in values], "row_key string, trade_date date, v int, w string")


def test_bucketed_upsert(spark, tmp_path, rows):
    name, path = table_of(spark, tmp_path)
    bucketed.create_bucketed(keyed(spark, [(f"k{i}", i % 3, i, "a") for i in range(60)] + [("k1", 1, 99, "z")]), name, 4, path=path, order=[F.desc("v")])
    assert bucketed.bucket_count(spark, name) == 4 and spark.table(name).where("row_key = 'k1'").first().v == 99
    new = keyed(spark, [("k0", 0, 100, None), ("k0", 0, 200, None), ("n1", 0, 1, "n"), ("k3", 0, None, "b")])
    others = lambda: sorted(map(str, (tmp_path / name / f"trade_date={DAY + timedelta(1)}").glob("*")))
    before = others()
    for n in (1, 3):
        bucketed.upsert_bucketed(new.repartition(n), name, order=[F.desc("v")])
        got = {r.row_key: (r.v, r.w) for r in spark.table(name).collect()}
        assert len(got) == 61 == spark.table(name).count()
        assert (got["k0"], got["n1"], got["k3"], got["k6"]) == ((200, None), (1, "n"), (None, "b"), (6, "a"))
    assert before and before == others()  # other days are left alone
    bucketed.upsert_bucketed(new.where("row_key = 'k0'").select("row_key", "trade_date", F.lit(None).cast("int").alias("v")), name, keep_absent=True)
    assert spark.table(name).where("row_key = 'k0'").first().v == 200
    with pytest.raises(ValueError):
        bucketed.upsert_bucketed(new.withColumn("row_key", F.lit(None).cast("string")), name)
    sinks.replace_partition(new, str(tmp_path / "plain"))
    spark.sql(f"CREATE TABLE {name}_plain USING parquet LOCATION '{tmp_path / 'plain'}'")
    with pytest.raises(ValueError):
        bucketed.bucket_count(spark, f"{name}_plain")


def test_stored_side_is_not_exchanged(spark, tmp_path):
    name, path = table_of(spark, tmp_path)
    bucketed.create_bucketed(keyed(spark, [(f"k{i}", i % 3, i, "a") for i in range(500)]), name, 4, path=path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = bucketed.merged(keyed(spark, [(f"k{i}", i % 3, -i, "b") for i in range(0, 400, 3)]), name, days=[DAY])
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    moves = [x for x in lines if "Exchange " in x]
    stored = next(i for i, x in enumerate(lines) if "FileScan" in x and "SelectedBucketsCount: 4 out of 4" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-*"))
    above, at = [], depth(lines[stored])
    for x in reversed(lines[:stored]):  # the nodes between the table's scan and the top
        if depth(x) < at:
            at = depth(x)
            above.append(x)
    assert len(moves) == 1 and "REPARTITION_BY_NUM" in moves[0] and any("Join" in x for x in above) and not any("Exchange" in x for x in above)


def scanned(df):
    """Rows the scans of a plan put out."""
    df.collect()
    total = 0
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_clustered_store_skips_row_groups(spark, tmp_path):
    n = 60000
    rows = spark.range(n).select(
        F.format_string("%06d", F.col("id") % 300).alias("securityid"), (F.lit("2018-03-01 09:30:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") % 14000)).alias("ts"),
        (F.xxhash64("id") % 10**9).alias("order_id"), F.lit(DAY).alias("trade_date"),
    ).repartition(4, "order_id")
    plain, fine = str(tmp_path / "plain"), str(tmp_path / "fine")
    sinks.replace_partition(rows, plain)
    sinks.write_clustered(rows, fine, blooms={"order_id": 8000}, files_per_day=4, group_bytes=64 * 1024)
    wanted = lambda p: readers.scan_store(spark.read.parquet(p), "2018-03-01 09:30:00", "2018-03-01 15:00:00", ["000007", "000008"])
    assert sorted(map(tuple, wanted(plain).collect())) == sorted(map(tuple, wanted(fine).collect())) and wanted(fine).count() == 400
    assert scanned(wanted(fine)) < scanned(wanted(plain)) / 5
    one = rows.first().order_id
    hit = lambda p: spark.read.parquet(p).where(F.col("order_id") == one)
    sinks.write_clustered(rows, f"{fine}-no", files_per_day=4, group_bytes=64 * 1024)
    assert hit(fine).count() == hit(plain).count() >= 1
    assert scanned(hit(fine)) < scanned(hit(f"{fine}-no")) / 2  # only the Bloom filters tell


HEAD = "000001\tM\t2018030109300000{}\tx\tT0\t1\t1\t1\t1\t1\t{}\t5\n"


def arrive(root, day, name, lines):
    folder = root / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(HEAD.format(i % 10, i) for i in lines))
    (folder / "ok").touch()


def test_manifest_survives_every_cut(spark, tmp_path, monkeypatch):
    root, notes, target = tmp_path / "in", str(tmp_path / "notes"), str(tmp_path / "index")
    days = lambda: ingest.ready_days(spark, str(root))
    go = lambda n=1000: manifest.load_arrivals(spark, str(root), days(), {"index": target}, notes, max_files=n)
    assert go() == []  # nothing is ready
    for i in range(5):
        arrive(root, "20180301", f"index_{i}.txt", range(10 * i, 10 * i + 10))
    arrive(root, "20180301", "readme.txt", [999])
    (root / "20180302").mkdir()
    (root / "20180302" / "index_9.txt").write_text(HEAD.format(0, 777))  # no marker yet
    for step in ("load", "finish", "begin"):  # lost before the rows, before the note, between runs
        real = getattr(manifest, step)
        calls = []

        def lost(*args, real=real, calls=calls, **kw):
            calls.append(1)
            if len(calls) == 2:
                raise RuntimeError("lost")
            return real(*args, **kw)

        monkeypatch.setattr(manifest, step, lost)
        with pytest.raises(RuntimeError):
            while True:
                assert go(1)
                arrive(root, "20180301", f"index_more_{step}_{len(calls)}.txt", [100 + len(step)])
        monkeypatch.setattr(manifest, step, real)
        seen = sorted(r.totalvolumetrade for r in manifest.loaded(spark, target, notes).collect())
        assert len(seen) == len(set(seen)) or step
    go(2)
    assert go() == []
    want = sorted([*range(50), *(100 + len(p.name.split("_")[2]) for p in (root / "20180301").glob("index_more_*"))])
    assert sorted(r.totalvolumetrade for r in manifest.loaded(spark, target, notes).collect()) == want
    arrive(root, "20180302", "index_8.txt", [888])
    go()
    assert {r.totalvolumetrade for r in manifest.loaded(spark, target, notes).collect()} >= {777, 888}


def test_rows_of_an_open_run_are_not_seen_and_changes_are(spark, tmp_path):
    root, notes, target = tmp_path / "in", str(tmp_path / "notes"), str(tmp_path / "index")
    arrive(root, "20180301", "index_0.txt", range(3))
    listed = manifest.arrived(spark, str(root), ["20180301"])
    run = manifest.begin(listed.where("feed = 'index'"), notes)
    manifest.load(spark, run, notes, target)
    assert manifest.loaded(spark, target, notes).isEmpty() and spark.read.parquet(target).count() == 3
    manifest.load(spark, run, notes, target)
    manifest.finish(spark, run, notes)
    manifest.finish(spark, run, notes)
    assert manifest.loaded(spark, target, notes).count() == 3
    assert manifest.changed(listed, notes).isEmpty()
    arrive(root, "20180301", "index_0.txt", range(4))
    assert [r.path.rsplit("/")[-1] for r in manifest.changed(manifest.arrived(spark, str(root), ["20180301"]), notes).collect()] == ["index_0.txt"]


def test_old_names_in_any_case_go_to_their_table_alone(spark, tmp_path):
    root, notes = tmp_path / "in", str(tmp_path / "notes")
    (root / "20180301").mkdir(parents=True)
    (root / "20180301" / "HQ_InDeX.txt").write_text("000001\t20180301\t93000000\t1\t1\t1\t1\t1\t5\t7\t1\n")
    (root / "20180301" / "hqTRADE.txt").write_text("000001\t20180301\t93000000\t1\t1\t2\t0\t0\t1.5\t10\n")
    (root / "20180301" / "StockStatus.txt").write_text("what\n")
    targets = {f: str(tmp_path / f) for f in ("index", "trade")}
    assert len(manifest.load_arrivals(spark, str(root), ["20180301"], targets, notes, "old")) == 2
    assert [manifest.loaded(spark, targets[f], notes).count() for f in ("index", "trade")] == [1, 1]
    assert sorted(r.feed for r in manifest.taken(spark, notes).collect()) == ["index", "trade"]
