"""Queries that go through stored tables: ingest, partition replacement,
upserts and the daily chain. Each run works in a new folder below the shared one."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from proxy.core import query
from quotewell.functions.times import FULL_SESSIONS, in_sessions
from quotewell.operators.observed import RuleWatch
from quotewell.operators.rules import row_rules
from quotewell.plans import daily, publish, recon
from quotewell.session import scratch_dir
from quotewell.sources import bucketed, manifest, partitions, readers, sinks
from quotewell.sources.readers import normalize
from quotewell.sources.schemas import INDEX, TRADE
from quotewell.streaming import ingest


@query("ingest_available_now", "trade_date:s n:i volume:i", """
select trade_date, count(*) as n, sum(totalvolumetrade) as volume from {sql_index} group by trade_date""")
def ingest_available_now(t):
    base = scratch_dir(t.spark, "ingest")
    raw = t["raw_index"].select(*INDEX.fieldNames())
    raw.write.csv(f"{base}/raw", sep="\t")
    store = ingest.append_by_batch(f"{base}/table")

    def load(batch, batch_id):
        store(normalize(batch, "index"), batch_id)

    for _ in range(2):  # the second run finds nothing new
        ingest.ingest_available(
            t.spark, f"{base}/raw", INDEX, f"{base}/checkpoint", load, options={"sep": "\t"}
        )
    return t.spark.read.parquet(f"{base}/table").groupBy("trade_date").agg(
        F.count("*").alias("n"), F.sum("totalvolumetrade").alias("volume")
    )


_FILES = {"index": ("hq_index", INDEX), "trade": ("hq_trade", TRADE)}


def _drop_files(t, root, part, marked=True):
    """One half of the index and trade files into day folders, with their markers and a file of no table."""
    rows = {"index": t["raw_index"], "trade": t["raw_trade_ticks"]}
    for half in (0, 1):
        for feed, (name, schema) in _FILES.items():
            mine = rows[feed].where(F.pmod(F.xxhash64("securityid", "origtime"), F.lit(4)) == 2 * part + half)
            mine.select(*schema.fieldNames()).write.mode("append").option("mapreduce.output.basename", name).csv(f"{root}/d{half}", sep="\t")
        for other in ("ok", "notes") if marked else ("notes",):
            t.spark.range(1).select(F.lit("x").alias("value")).coalesce(1).write.mode("append").option("mapreduce.output.basename", other).text(f"{root}/d{half}")


@query("ingest_manifest", "feed:s trade_date:s n:i volume:d", """
select 'index' as feed, trade_date, count(*) as n, sum(totalvolumetrade) as volume from {sql_index} group by trade_date
union all select 'trade', trade_date, count(*), sum(tradeqty) from {sql_trade_ticks} group by trade_date""")
def ingest_manifest(t):
    """Loads that are cut off before and after their rows are written, with files arriving in between."""
    base = scratch_dir(t.spark, "manifest")
    root, notes = f"{base}/in", f"{base}/notes"
    targets = {feed: f"{base}/{feed}" for feed in _FILES}
    _drop_files(t, root, 0)
    days = ingest.ready_days(t.spark, root, "ok-*")
    listed = manifest.arrived(t.spark, root, days)
    manifest.begin(listed.where("feed = 'index'"), notes, 1)  # noted, then lost
    cut = manifest.begin(listed.where("feed = 'trade'"), notes)
    manifest.load(t.spark, cut, notes, targets["trade"])  # loaded, but not noted as done
    _drop_files(t, root, 1)
    for _ in range(2):  # the second load finds nothing new
        manifest.load_arrivals(t.spark, root, ingest.ready_days(t.spark, root, "ok-*"), targets, notes, max_files=5)
    parts = [
        manifest.loaded(t.spark, targets[feed], notes).groupBy("trade_date").agg(F.count("*").alias("n"), F.sum(c).alias("volume")).withColumn("feed", F.lit(feed))
        for feed, c in (("index", "totalvolumetrade"), ("trade", "tradeqty"))
    ]
    return parts[0].unionByName(parts[1])


@query("ingest_routed_feeds", "feed:s trade_date:s n:i", """
select 'index' as feed, cast(trade_date as varchar) as trade_date, count(*) as n from {sql_index} group by trade_date
union all select 'trade', cast(trade_date as varchar), count(*) from {sql_trade_ticks} group by trade_date
union all select 'refused', 'notes', 4 where exists (select 1 from {events})""")
def ingest_routed_feeds(t):
    """Index and trade files of two days in a stream each, and what no stream takes."""
    base = scratch_dir(t.spark, "routed")
    targets = {feed: f"{base}/{feed}" for feed in _FILES}
    for part in (0, 1):
        _drop_files(t, f"{base}/in", part, marked=part == 1)
        days = ingest.ingest_feeds(t.spark, f"{base}/in", targets, f"{base}/checkpoint", marker="ok-*", feeds=list(_FILES))
        assert len(days) == 2 * part  # days without a marker wait
    parts = [
        t.spark.read.parquet(targets[feed]).groupBy(F.col("trade_date").cast("string").alias("trade_date")).agg(F.count("*").alias("n")).withColumn("feed", F.lit(feed))
        for feed in _FILES
    ]
    name = F.regexp_extract("path", r"([a-z_]+)[^/]*$", 1).alias("trade_date")
    refused = ingest.refused_files(t.spark, f"{base}/in", days, marker="ok-*").groupBy(name).agg(F.count("*").alias("n"))
    return parts[0].unionByName(parts[1]).unionByName(refused.withColumn("feed", F.lit("refused")))


def _ticks(t):
    return t["events"].select(
        "event_id", "user_id", "event_type", F.col("value").cast("decimal(12,2)").alias("value"),
        F.to_date("ts").alias("trade_date"),
    )


_TICKS = "(select *, cast(ts as date) as trade_date, cast(value as decimal(12,2)) as v from {events}) as e"


@query("replace_partitions", "trade_date:s n:i total:d", f"""
select trade_date, count(*) as n, sum(case when trade_date between date '2024-01-10' and date '2024-01-12' then v + 1 else v end) as total
from {_TICKS} where trade_date <> date '2024-01-13' group by trade_date""")
def replace_partitions(t):
    path = scratch_dir(t.spark, "replace")
    ticks = _ticks(t)
    sinks.replace_partition(ticks, path, "trade_date", ["user_id"])
    # the range 10-13 comes again, with other values and without the 13th
    fresh = ticks.where(F.col("trade_date").between("2024-01-10", "2024-01-12")).withColumn("value", F.col("value") + 1)
    sinks.replace_range(fresh, path, "2024-01-10", "2024-01-13", "trade_date")
    return t.spark.read.parquet(path).groupBy("trade_date").agg(
        F.count("*").alias("n"), F.sum("value").alias("total")
    )


@query("upsert_rows", "trade_date:s n:i total:d", f"""
select trade_date, count(*) as n, sum(case when event_type in ('error', 'view') then v + 100 else v end) as total
from {_TICKS} group by trade_date""")
def upsert_rows(t):
    path = scratch_dir(t.spark, "upsert")
    keys = ["trade_date", "user_id", "event_id"]
    ticks = _ticks(t)
    sinks.upsert(ticks.where("event_type <> 'error'"), path, keys)
    late = ticks.where("event_type in ('error', 'view')")
    # every key comes three times; the largest value is the one that stays
    late = late.withColumn("value", F.explode(F.array(*[F.col("value") + n for n in (50, 100, 70)])))
    for n in (1, 8):  # writing the same rows again changes nothing, however they are dealt
        sinks.upsert(late.repartition(n), path, keys)
    absent = ticks.select(*keys, F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("decimal(12,2)").alias("value"))
    sinks.upsert(absent, path, keys, keep_absent=True)  # null cells leave the stored ones
    return t.spark.read.parquet(path).groupBy("trade_date").agg(
        F.count("*").alias("n"), F.sum("value").alias("total")
    )


@query("upsert_bucketed", "trade_date:s n:i total:d", f"""
select trade_date, count(*) as n, sum(case when event_type in ('error', 'view') then v + 100 else v end) as total
from {_TICKS} group by trade_date""")
def upsert_bucketed(t):
    """As upsert_rows, in a table bucketed by row key."""
    path, table = scratch_dir(t.spark, "bucketed"), f"bucketed_{uuid.uuid4().hex[:12]}"
    ticks = _ticks(t).withColumn("row_key", F.concat_ws("-", "user_id", "event_id"))
    bucketed.create_bucketed(ticks.where("event_type <> 'error'"), table, 8, path=path)
    late = ticks.where("event_type in ('error', 'view')")
    late = late.withColumn("value", F.explode(F.array(*[F.col("value") + n for n in (50, 100, 70)])))
    for n in (1, 5):  # the same rows again change nothing
        bucketed.upsert_bucketed(late.repartition(n), table, order=[F.desc("value")])
    absent = ticks.where("event_type = 'click'").select("row_key", "trade_date", F.lit(None).cast("decimal(12,2)").alias("value"))
    bucketed.upsert_bucketed(absent, table, keep_absent=True)
    return t.spark.table(table).groupBy("trade_date").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("upsert_flag_column", "trade_date:s flag:s n:i", """
select t.trade_date, case when price = 0 or tradeqty = 0 or bidapplseqnum = offerapplseqnum then '0'
  when bidapplseqnum > offerapplseqnum then '1' else '2' end as flag, count(*) as n
from {sql_trade_ticks} t join {products_sz} p on p.prdtid = t.securityid group by 1, 2""")
def upsert_flag_column(t):
    path = scratch_dir(t.spark, "flags")
    trades = normalize(t["raw_trade_ticks"], "trade")
    sinks.upsert(publish.publish_trades(trades, t["products_sz"]), path, ["trade_date", "row_key"])
    sinks.upsert_columns(recon.revised_flags(trades), path, ["row_key"], ["TradeBSFlag"])
    return t.spark.read.parquet(path).groupBy("trade_date", F.col("TradeBSFlag").alias("flag")).agg(
        F.count("*").alias("n")
    )


@query("publish_trades_observed", "trade_date:s rule:s n:i", """
select trade_date, 'trade_range' as rule, count(*) filter (where exectype = 'F' and (price <= 0 or tradeqty <= 0)) as n
from {sql_trade_ticks} group by trade_date
union all select trade_date, 'published', count(*) from {sql_trade_ticks} t join {products_sz} p on p.prdtid = t.securityid
group by trade_date""")
def publish_trades_observed(t):
    """Trades on their way into the store; the rules are counted by the job that writes them."""
    path = scratch_dir(t.spark, "observed")
    stored = sinks.written(normalize(t["raw_trade_ticks"], "trade"), "ticks")
    watch = RuleWatch(stored, row_rules("trade"), sinks.days_of(stored))
    sinks.upsert(publish.publish_trades(watch.watched, t["products_sz"]), path, ["trade_date", "row_key"])
    written = t.spark.read.parquet(path).groupBy("trade_date").agg(F.count("*").alias("n")).withColumn("rule", F.lit("published"))
    return watch.counts().unionByName(written)


@query("daily_chain", "trade_date:s n_store:i n_file:i n_common:i n_file_only:i n_store_only:i n_after:i", """
select t.trade_date, count(*) filter (where tradeqty > 10) as n_store, count(*) as n_file,
  count(*) filter (where tradeqty > 10) as n_common, count(*) filter (where tradeqty <= 10) as n_file_only,
  0 as n_store_only, count(*) as n_after
from {sql_trade_ticks} t join {products_sz} p on p.prdtid = t.securityid
where clock between 90000000 and 113000000 or clock between 130000000 and 150000000 group by t.trade_date""")
def daily_chain(t):
    base = scratch_dir(t.spark, "chain")
    products = t["products_sz"]
    # only listed products, so that a filled store can hold every file row
    trades = normalize(t["raw_trade_ticks"], "trade").join(
        products.select(F.col("prdtid").alias("securityid")), "securityid", "left_semi"
    )
    stored = publish.publish_trades(trades.where("tradeqty > 10"), products)
    sinks.upsert(stored, f"{base}/trade", ["trade_date", "row_key"])
    daily.run_day({"trade": trades}, {"trade": f"{base}/trade"}, products, f"{base}/out", insert=True)
    stats = t.spark.read.parquet(f"{base}/out/stats")
    after = t.spark.read.parquet(f"{base}/trade").where(
        in_sessions(F.col("MDTime").cast("bigint"), FULL_SESSIONS)
    ).groupBy("trade_date").agg(F.count("*").alias("n_after"))
    return stats.join(after, "trade_date")


@query("recon_store_with_history", "trade_date:s n_store:i n_file:i n_common:i n_file_only:i n_store_only:i feed:s days_kept:i", """
select trade_date, count(*) filter (where tradeqty > 10) as n_store, count(*) as n_file,
  count(*) filter (where tradeqty > 10) as n_common, count(*) filter (where tradeqty <= 10) as n_file_only,
  0 as n_store_only, 'trade' as feed, (select count(distinct trade_date) from {sql_trade_ticks} h join {products_sz} q on q.prdtid = h.securityid
    where h.tradeqty > 10 or (day(h.trade_date) > 15 and (h.clock between 90000000 and 113000000 or h.clock between 130000000 and 150000000))) as days_kept
from {sql_trade_ticks} t join {products_sz} p on p.prdtid = t.securityid
where day(trade_date) > 15 and (clock between 90000000 and 113000000 or clock between 130000000 and 150000000) group by t.trade_date""")
def recon_store_with_history(t):
    """Files of some days against a store that holds others, too: those stay as they are and out of the statistics."""
    base = scratch_dir(t.spark, "history")
    products = t["products_sz"]
    trades = normalize(t["raw_trade_ticks"], "trade").join(
        products.select(F.col("prdtid").alias("securityid")), "securityid", "left_semi"
    )
    sinks.upsert(publish.publish_trades(trades.where("tradeqty > 10"), products), f"{base}/trade", ["trade_date", "row_key"])
    files = trades.where(F.dayofmonth("trade_date") > 15)
    for _ in range(2):  # the second run replaces the statistics of the first
        daily.run_day({"trade": files}, {"trade": f"{base}/trade"}, products, f"{base}/out", insert=False)
    daily.run_day({"trade": files}, {"trade": f"{base}/trade"}, products, f"{base}/filled", insert=True)
    kept = t.spark.read.parquet(f"{base}/trade").select("trade_date").distinct().count()
    return t.spark.read.parquet(f"{base}/out/stats").withColumn("days_kept", F.lit(kept))


# --- readers, sinks and partition upkeep -----------------------------------

@query("day_range_rows", "trade_date:s n:i total:d", f"""
select trade_date, count(*) as n, sum(v) as total from {_TICKS} where trade_date between date '2024-01-05' and date '2024-01-09' group by trade_date""")
def day_range_rows(t):
    path = scratch_dir(t.spark, "days")
    sinks.replace_partition(_ticks(t), path, "trade_date")
    job = lambda df: df.groupBy("trade_date").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return partitions.run_range(job, readers.read_day(t.spark, path, "20240101", "20240120"), "2024-01-05", "2024-01-09")


@query("tsv_by_position", "event_type:s user_id:s n:i total:d", """
select event_type, cast(user_id as varchar) as user_id, count(*) as n, sum(cast(value as decimal(12,2))) as total
from {events} group by event_type, user_id""")
def tsv_by_position(t):
    path = scratch_dir(t.spark, "tsv")
    t["events"].select("event_id", "event_type", "user_id", F.col("value").cast("decimal(12,2)")).write.csv(path, sep="\t")
    typed = readers.read_tsv(t.spark, path, (1, 2, 3), (0, 1, 2))
    untyped = readers.read_tsv(t.spark, path, (1, 2, 3), None)
    rows = typed.select("s1", "s2", F.col("s3").cast("decimal(12,2)").alias("s3")).intersectAll(untyped.select("s1", "s2", F.col("s3").cast("decimal(12,2)").alias("s3")))
    return rows.groupBy(F.col("s1").alias("event_type"), F.col("s2").alias("user_id")).agg(F.count("*").alias("n"), F.sum("s3").alias("total"))


@query("products_by_exchange", "exchange:s prdtid:s symbol:s", """
select 'SZ' as exchange, split_part(prdtid, '.', 1) as prdtid, symbol from {products_csv} where prdtid like '%.SZ'
union all select 'all', prdtid, symbol from {products_csv}""")
def products_by_exchange(t):
    path = scratch_dir(t.spark, "products")
    t["products_csv"].write.csv(path)
    parts = [readers.read_products(t.spark, path, x).select(F.lit(x or "all").alias("exchange"), "prdtid", "symbol") for x in ("SZ", None)]
    return parts[0].unionByName(parts[1])


@query("key_value_lines", "key:s value:s", "select concat('user.', user_id) as key, concat(event_type, '=', event_id) as value from {events}")
def key_value_lines(t):
    path = scratch_dir(t.spark, "kv")
    line = F.concat(F.lit(" user."), "user_id", F.lit(" = "), "event_type", F.lit("="), F.col("event_id").cast("string"))
    noise = F.explode(F.array(line, F.lit("# a note"), F.lit("")))
    t["events"].select(noise.alias("value")).write.text(path)
    return readers.read_kv(t.spark, path)


@query("listing_by_security", "securityid:s n:i", "select securityid, count(*) as n from {sql_index} group by securityid")
def listing_by_security(t):
    base = scratch_dir(t.spark, "listing")
    rows = normalize(t["raw_index"], "index")
    sinks.replace_all(rows.limit(0), base)
    sinks.replace_all(rows, base)  # the whole table is replaced
    sinks.write_by_security(t.spark.read.parquet(base), f"{base}-by")
    return t.spark.read.option("basePath", f"{base}-by").schema("n long, securityid string").parquet(f"{base}-by").groupBy("securityid").agg(F.count("*").alias("n"))


@query("upsert_dry_run", "n_keys:i first_user:i", "select count(distinct (user_id, event_id)) as n_keys, min(user_id) as first_user from {events}")
def upsert_dry_run(t):
    ticks = _ticks(t)
    return sinks.upsert(ticks.union(ticks), scratch_dir(t.spark, "dry"), ["user_id", "event_id"], dry_run=True).select(
        "n_keys", F.col("first_key.user_id").alias("first_user"))


@query("stage_days", "trade_date:s n:i volume:i", """
select trade_date, count(*) as n, sum(totalvolumetrade) as volume from {sql_index} group by trade_date""")
def stage_days(t):
    base = scratch_dir(t.spark, "stage")
    t["raw_index"].select(*INDEX.fieldNames()).write.csv(f"{base}/raw", sep="\t")
    for _ in range(2):  # staging a day again replaces it
        partitions.stage_day(t.spark, f"{base}/raw", f"{base}/table", "index")
    return readers.read_day(t.spark, f"{base}/table").groupBy("trade_date").agg(F.count("*").alias("n"), F.sum("totalvolumetrade").alias("volume"))


@query("partition_upkeep", "trade_date:s n:i", f"""
select trade_date, count(*) as n from {_TICKS} where trade_date <= date '2024-01-12' group by trade_date""")
def partition_upkeep(t):
    """Partitions that come and go behind the catalog's back, then a purge in a managed table."""
    path, name = scratch_dir(t.spark, "upkeep"), f"upkeep_{uuid.uuid4().hex[:12]}"
    ticks = _ticks(t)
    sinks.replace_partition(ticks.where("trade_date <= date'2024-01-08'"), path, "trade_date")
    t.spark.sql(f"CREATE TABLE {name} (event_id BIGINT, user_id BIGINT, event_type STRING, value DECIMAL(12,2), trade_date DATE) "
                f"USING parquet PARTITIONED BY (trade_date) LOCATION '{path}'")
    partitions.refresh_partitions(t.spark, [name])
    sinks.replace_partition(ticks.where("trade_date > date'2024-01-08'"), path, "trade_date")
    partitions.refresh_partitions(t.spark, [name])
    days = partitions.list_days(t.spark, name, None, "2024-01-12")
    managed = f"{name}_managed"
    t.spark.table(name).write.partitionBy("trade_date").saveAsTable(managed)
    partitions.purge_partitions(t.spark, [managed], "2024-01-13", "2024-12-31", confirm=True)
    rows = t.spark.table(managed).groupBy("trade_date").agg(F.count("*").alias("n"))
    return days.join(rows, "trade_date")


@query("file_routes", "name:s fmt:s feed:s", """
select name, fmt, case when fmt = 'new' then
    case k when 0 then 'snap' when 1 then 'snap_level' when 2 then 'index' when 3 then 'stock_status' when 4 then 'order' when 5 then 'trade' end
  else case k when 2 then 'index' when 3 then 'stock_status' when 4 then 'order' when 5 then 'trade' when 6 then 'stock_info' when 0 then 'snap' when 1 then 'snap_level' end
  end as feed
from (select concat('day/', event_id, '_', case event_id % 8 when 0 then 'snap_spot' when 1 then 'snap_level' when 2 then 'index' when 3 then 'stock_status'
    when 4 then 'order' when 5 then 'trade' when 6 then 'stockinfo' else 'other' end, '.txt') as name, event_id % 8 as k, fmt
  from {events} cross join (values ('new'), ('old')) as f(fmt))""")
def file_routes(t):
    kinds = F.array(*[F.lit(x) for x in ("snap_spot", "snap_level", "index", "stock_status", "order", "trade", "stockinfo", "other")])
    names = t["events"].select(F.concat(F.lit("day/"), F.col("event_id").cast("string"), F.lit("_"), kinds[(F.col("event_id") % 8).cast("int")], F.lit(".txt")).alias("name"))
    parts = [names.select("name", F.lit(fmt).alias("fmt"), readers.feed_of_file(F.col("name"), fmt).alias("feed")) for fmt in ("new", "old")]
    return parts[0].unionByName(parts[1])
