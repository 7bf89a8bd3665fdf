"""Mergeable states, digests and bitmaps: equal to the plain way however they are cut."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quotewell.operators import bitmaps, peaks, relational, rules
from quotewell.plans import recon
from quotewell.plans.marts import flows


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def moved(spark):
    rng = random.Random(5)
    first = date(2017, 1, 1)
    rows = [(rng.choice("abcdefg"), first + timedelta(rng.randrange(365)), rng.randrange(9), rng.randrange(9)) for _ in range(800)]
    rows += [("out", first, 0, 5), ("out", first + timedelta(40), 1, 0), (None, first, 3, 1)]
    df = spark.createDataFrame(rows, "pty_id string, data_dt date, fin_in_amt int, fin_out_amt int")
    return df.withColumn("net_in", F.col("fin_in_amt") - F.col("fin_out_amt")).cache()


@pytest.mark.parametrize("period", ["data_dt", "week", "month", "quarter", "year"])
def test_states_merge_to_the_peak_of_the_whole(moved, rows, period):
    cut = moved.withColumn("p", F.col("data_dt") if period == "data_dt" else F.trunc("data_dt", period))
    states = peaks.peak_states(cut, ["pty_id"], "p", "data_dt", "net_in", flows.IN_OUT)
    got = peaks.merge_states(states, ["pty_id"], "p", list(flows.IN_OUT)).withColumn("cost", peaks.floored())
    want = relational.max_running_floor0(moved, "pty_id", "data_dt", "net_in", "cost", flows.IN_OUT)
    names = ["pty_id", "fin_in_amt", "fin_out_amt", "cost"]
    assert rows(got.select(*names), *names) == rows(want.select(*names), *names)


def test_states_merge_in_any_grouping(moved, rows):
    months = moved.withColumn("p", F.trunc("data_dt", "month"))
    states = peaks.peak_states(months, ["pty_id"], "p", "data_dt", "net_in", flows.IN_OUT)
    quarters = peaks.merge_states(states.withColumn("q", F.trunc("p", "quarter")), ["pty_id", "q"], "p", list(flows.IN_OUT))
    twice = peaks.merge_states(quarters, ["pty_id"], "q", list(flows.IN_OUT))
    once = peaks.merge_states(states, ["pty_id"], "p", list(flows.IN_OUT))
    assert rows(twice, "pty_id") == rows(once, "pty_id")


def test_year_reads_the_current_month_alone(spark, moved, tmp_path, rows):
    path, source = str(tmp_path / "states"), str(tmp_path / "flows")
    moved.write.partitionBy("data_dt").parquet(source)
    stored = spark.read.parquet(source)
    nothing = stored.select("data_dt", "pty_id", F.col("net_in").alias("assure_in_amt"), F.lit(0).alias("assure_out_amt")).where("false")
    tables = {
        "vw_ms_cust_fc_fin_idx_d": stored.select("data_dt", "pty_id", F.col("fin_in_amt").alias("cash_in"), F.col("fin_out_amt").alias("cash_out")),
        "vw_ms_cust_fc_tran_idx_d": nothing,
    }
    for day in ("2017-01-31", "2017-03-31", "2017-02-28", "2017-04-30"):  # in any order
        flows.store_cost_states(flows.margin_flows(tables, flows.month_begin(day), day), path, day, day)
    got = flows.margin_io_year_incremental(tables, "2017-05-20", path)
    want = flows.margin_io_year(tables, "2017-05-20")
    assert rows(got.select(*want.columns), "pty_id") == rows(want, "pty_id")
    # a late flow: its month is stored again, the months after stay
    late = spark.createDataFrame([("a", date(2017, 2, 3), 1000, 0)], "pty_id string, data_dt date, fin_in_amt int, fin_out_amt int")
    tables["vw_ms_cust_fc_fin_idx_d"] = tables["vw_ms_cust_fc_fin_idx_d"].unionByName(late.select("data_dt", "pty_id", F.col("fin_in_amt").alias("cash_in"), F.col("fin_out_amt").alias("cash_out")))
    flows.store_cost_states(flows.margin_flows(tables, flows.month_begin("2017-02-28"), "2017-02-28"), path, "2017-02-01", "2017-02-28")
    again = flows.cost_between(spark, path, "2017-01-01", "2017-05-20")
    want = flows.margin_io_year(tables, "2017-05-20").select("pty_id", "max_cost_fc")
    assert rows(again.select("pty_id", "max_cost_fc"), "pty_id") == rows(want, "pty_id")
    month = flows.margin_flows(tables, flows.month_begin("2017-05-20"), "2017-05-20")
    files = {r[0] for r in month.select(F.col("data_dt")).distinct().collect()}
    assert files and min(files) >= date(2017, 5, 1) and max(files) <= date(2017, 5, 20)
    assert "PartitionFilters: [isnotnull(month" in executed(flows.cost_between(spark, path, "2017-02-01", "2017-05-20"))


def test_a_month_whose_flows_went_away_loses_its_state(spark, moved, tmp_path):
    path = str(tmp_path / "states")
    flows.store_cost_states(moved, path, "2017-01-01", "2017-03-31")
    flows.store_cost_states(moved.where("data_dt <> data_dt or month(data_dt) = 3"), path, "2017-02-01", "2017-03-31")
    assert [r[0] for r in spark.read.parquet(path).select(F.month("month")).distinct().orderBy(F.month("month")).collect()] == [1, 3]


# --- digests ---------------------------------------------------------------

KEYS = ["trade_date", "securityid", "ts", "applseqnum"]


def ticks(spark, days=3, securities=4, n=200):
    rows = []
    for d in range(days):
        for s in range(securities):
            for i in range(n):
                at = datetime(2018, 3, 1 + d, 9, 30) + timedelta(seconds=i * 20)
                rows.append((at.date(), f"{s:06d}", at, i))
    return spark.createDataFrame(rows, "trade_date date, securityid string, ts timestamp_ntz, applseqnum long")


def both_ways(files, store, **options):
    plain = recon.key_counts(files, store, KEYS, **options)
    diff = recon.digest_diff(files, store, KEYS, **options)
    return plain, diff


def same_result(plain, diff, rows):
    assert rows(diff.summary(["trade_date"]), "trade_date") == rows(recon.summary(plain, ["trade_date"]), "trade_date")
    assert rows(diff.summary()) == rows(recon.summary(plain))
    one = lambda c: c.where("n_file = 0 or n_store = 0").select(*KEYS, "n_file", "n_store")
    assert rows(one(diff.counts), *KEYS) == rows(one(plain), *KEYS)


def test_equal_sides_move_no_keys(spark, rows):
    files = ticks(spark)
    plain, diff = both_ways(files, files.repartition(5))
    same_result(plain, diff, rows)
    assert diff.counts.isEmpty() and diff.blocks.where("not same").isEmpty()


def test_losses_swaps_repeats_and_strangers(spark, rows):
    files = ticks(spark)
    seq = F.col("applseqnum")
    store = files.where("not (securityid = '000001' and applseqnum in (3, 4))")
    store = store.withColumn("applseqnum", F.when((F.col("securityid") == "000002") & (seq == 7), -seq).otherwise(seq))
    strangers = files.limit(50).withColumn("securityid", F.lit("999999"))
    repeated = files.where("securityid = '000003' and applseqnum between 20 and 22")
    other_day = files.withColumn("trade_date", F.date_add("trade_date", 300)).withColumn("ts", F.expr("ts + interval 300 days"))
    for scope in ("file_securities", "all"):
        plain, diff = both_ways(files.unionByName(repeated).unionByName(repeated), store.unionByName(strangers).unionByName(other_day), scope=scope)
        same_result(plain, diff, rows)
    # few of the 3 x 4 x 14 blocks differ, so few of the keys are shuffled
    compared = diff.counts.agg(F.sum(F.col("n_file") + F.col("n_store"))).first()[0]
    assert 0 < compared < 400 < files.count()


def test_two_copies_do_not_cancel(spark, rows):
    """An XOR of hashes is the same for two copies of one key and two of another."""
    base = ticks(spark, 1, 1, 4)
    files = base.where("applseqnum in (0, 1)").unionByName(base.where("applseqnum in (0, 1)"))
    digest = recon.digests(files, KEYS).drop("n").first()
    other = recon.digests(base.where("applseqnum in (2, 3)").unionByName(base.where("applseqnum in (2, 3)")), KEYS).drop("n").first()
    assert digest != other


@pytest.mark.parametrize("sessions", [None, [(93000000, 95959999)]])
def test_digest_of_sessions_and_empty_sides(spark, rows, sessions):
    files = ticks(spark, 2, 2)
    plain, diff = both_ways(files, files.where("applseqnum % 50 <> 0"), sessions=sessions)
    same_result(plain, diff, rows)
    for a, b in ((files, files.limit(0)), (files.limit(0), files), (files.limit(0), files.limit(0))):
        plain, diff = both_ways(a, b, sessions=sessions)
        assert rows(diff.summary(["trade_date"]), "trade_date") == rows(recon.summary(plain, ["trade_date"]), "trade_date")


# --- bitmaps ---------------------------------------------------------------

NUMBERS = [1, 2, 7, 8, 9, 32767, 32768, 32769, 65536, 65537, 10**6, 2**40, 2**62, -1, -5, -32768, -32769]


def numbers(spark, values):
    return spark.createDataFrame([(d, v) for d, v in values], "d int, v long")


def test_bitmaps_are_sets(spark):
    rng = random.Random(8)
    named = [(d, v) for d in (1, 2) for v in NUMBERS + [rng.randrange(10**5) + 1 for _ in range(500)]]
    known = [x for x in named if rng.random() < 0.6] + [(1, 3), (3, 1)]
    a, b = numbers(spark, named * 3 + [(1, None)]), numbers(spark, known + [(2, None)])
    sets = [bitmaps.number_bitmaps(x, "v", ["d"]) for x in (a, b)]
    lost = set(named) - set(known)
    assert {r.d: r.n for r in bitmaps.count_outside(*sets, ["d"]).collect()} == {d: sum(x[0] == d for x in lost) for d in (1, 2)}
    out = bitmaps.rows_outside(a, "v", sets[1], ["d"]).collect()
    assert len(out) == 3 * sum(x in lost for x in named) and {(r.d, r.v) for r in out} == lost
    halves = bitmaps.number_bitmaps(b.where("v % 2 = 0"), "v", ["d"]).unionByName(bitmaps.number_bitmaps(b.where("v % 2 <> 0"), "v", ["d"]))
    merged = bitmaps.merged_bitmaps(halves, ["d"])
    assert bitmaps.count_outside(sets[1], merged, ["d"]).isEmpty() and bitmaps.count_outside(merged, sets[1], ["d"]).isEmpty()
    assert bitmaps.count_outside(sets[0], sets[0].limit(0), ["d"]).count() == 2 and bitmaps.count_outside(sets[0].limit(0), sets[1], ["d"]).isEmpty()


def test_bitmap_rule_by_channel_shuffles_bitmaps(spark, rows):
    day = date(2018, 3, 1)
    orders = spark.createDataFrame([(day, c, i) for c in (1, 2) for i in range(1, 4000) if i % 100], "trade_date date, mdstreamid int, applseqnum long").repartition(3)
    trades = spark.createDataFrame([(day, c, i, i + 1 if i % 7 else 0) for c in (1, 2) for i in range(1, 3998)], "trade_date date, mdstreamid int, bidapplseqnum long, offerapplseqnum long")
    got = rules.missing_reference_bitmap(trades, orders, channel="mdstreamid")
    assert rows(got) == [(day, "trade_without_order", 78)]  # 100, 200, ... of each channel
    assert rows(rules.missing_reference_bitmap(trades, orders)) == rows(rules.missing_reference(trades, orders)) == [(day, "trade_without_order", 39)]
    known = bitmaps.number_bitmaps(orders, "applseqnum", ["trade_date"])
    assert rows(rules.missing_reference_bitmap(trades, known=known)) == [(day, "trade_without_order", 39)]
    out = bitmaps.number_bitmaps(orders, "applseqnum", ["trade_date"])
    plan = executed(out)
    assert plan.index("Exchange hashpartitioning(trade_date") < plan.index("partial_bitmap_construct_agg")  # below: built before the shuffle


def test_scattered_numbers_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(bitmaps, "ROWS", 50)
    df = spark.range(0, 400, 1, 1).select(F.lit(1).alias("d"), (F.col("id") * 40000).alias("v"))
    sets = bitmaps.number_bitmaps(df, "v", ["d"])
    assert "REPARTITION_BY_NUM" in executed(sets)  # one task of a file built a bitmap of 4 KB for each of its rows
    assert sets.agg(F.sum(F.bitmap_count("bits"))).first()[0] == 400 and bitmaps.rows_outside(df, "v", sets, ["d"]).isEmpty()
