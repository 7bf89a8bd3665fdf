"""Validity joins, months in one plan, reports, volumes over ranges, observed rules."""

import random
from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quotewell.operators import intervals, relational, rules, volumes
from quotewell.operators.observed import RuleWatch


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def valid(spark):
    rng = random.Random(11)
    first = date(2017, 1, 1)
    facts = [(i, rng.choice(["a", "b", "c", None, "zz"]), first + timedelta(rng.randrange(730))) for i in range(600)] + [(600, "a", None)]
    rows = [(k, n, first + timedelta(rng.randrange(-400, 700)), rng.randrange(-5, 300)) for n, k in enumerate("abcabcabcab")]
    rows = [(k, n, b, b + timedelta(d)) for k, n, b, d in rows] + [("a", 50, date(1990, 1, 1), date(2999, 12, 31)), ("b", 51, None, date(2999, 1, 1)), ("c", 52, first, None), (None, 53, first, date(2999, 1, 1))]
    path = [spark.createDataFrame(facts, "id int, k string, day date"), spark.createDataFrame(rows, "k string, n int, bgn_dt date, end_dt date")]
    return path, facts, rows


@pytest.mark.parametrize("unit", ["week", "month", "year"])
def test_validity_join_equals_the_comparison(spark, valid, unit):
    (df, periods), facts, rows = valid
    met = [(i, n) for i, k, d in facts for key, n, b, e in rows if k is not None and k == key and d and b and e and b <= d < e]
    args = (df, "day", periods, ["k"], "2017-01-01", "2018-12-31")
    assert sorted(tuple(r) for r in intervals.join_valid(*args, unit=unit).select("id", "n").collect()) == sorted(met)
    semi = intervals.join_valid(*args, how="left_semi", unit=unit)
    assert semi.columns == df.columns and sorted(r.id for r in semi.collect()) == sorted({i for i, _ in met})
    left = intervals.join_valid(*args, how="left", unit=unit).select("id", "n").collect()
    assert sorted((r.id, r.n) for r in left if r.n is not None) == sorted(met) and {r.id for r in left} == {i for i, *_ in facts}
    for how in ("inner", "left", "left_semi"):
        assert "NestedLoop" not in executed(intervals.join_valid(*args, how=how, unit=unit))


def test_bins_are_clipped_to_the_range(spark):
    periods = spark.createDataFrame([("a", date(1990, 1, 1), date(2999, 12, 31)), ("b", date(2017, 3, 31), date(2017, 4, 1)), ("c", date(2017, 5, 5), date(2017, 5, 5)), ("d", date(2018, 1, 1), date(2017, 1, 1))], "k string, bgn_dt date, end_dt date")
    bins = intervals.binned(periods, "2017-01-15", "2017-12-31").collect()
    assert sorted((r.k, r._bin.month) for r in bins) == [("a", m) for m in range(1, 13)] + [("b", 3)]
    assert intervals.binned(periods, "2030-01-01", "2029-01-01").isEmpty()
    with pytest.raises(ValueError):
        intervals.join_valid(periods, "bgn_dt", periods, ["k"], "2017-01-01", "2017-02-01", how="full")


def test_conflicting_rates_are_an_error(spark, rows):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "data_dt int, ccy string")
    rate = lambda r: spark.createDataFrame(r, "data_dt int, ccy string, exchange_rate decimal(8,4)").repartition(2)
    from decimal import Decimal as D
    good = relational.with_rate(df, rate([(1, "x", D(2)), (1, "x", D(2)), (2, "x", None)]))
    assert rows(good.select("data_dt", "ccy", "exchange_rate"), "data_dt", "ccy") == [(1, "x", D(2)), (1, "y", D(1)), (2, "x", D(1))]
    with pytest.raises(PySparkException, match="different rates on 1 x"):
        relational.with_rate(df, rate([(1, "x", D(2)), (1, "x", D(3))])).collect()


DAY = date(2018, 3, 1)


def test_report_takes_every_rule(spark):
    trades = spark.createDataFrame(
        [(DAY, "s1", i, i, F_, 1.0, 5, 7, 100000000 + i) for i, F_ in ((1, "F"), (2, "F"))] + [(DAY, "s2", 3, 3, "F", 0.0, 5, 8, 200000000)],
        "trade_date date, securityid string, ts int, applseqnum long, exectype string, price double, tradeqty long, bidapplseqnum long, clock long",
    ).withColumn("offerapplseqnum", F.lit(9).cast("long"))
    orders = spark.createDataFrame([(DAY, "s1", 1, 9, 1.0, 5, None, 100000000), (DAY, "s3", 1, 10, 1.0, 5, " ", 1)], "trade_date date, securityid string, ts int, applseqnum long, price double, orderqty long, note string, clock long")
    holidays = spark.createDataFrame([(DAY,)], "trade_date date")
    got = rules.report({"trade": trades, "order": orders}, detail=True, volumes=True, tracked={"order": ["note"]}, holidays=holidays)
    assert sorted((r.securityid, r.rule, r.n) for r in got.collect()) == sorted([
        ("s2", "trade_range", 1), ("s1", "trade_without_order", 1), ("s2", "trade_without_order", 1), ("s1", "rows:trade", 2), ("s2", "rows:trade", 1),
        ("s1", "rows:order", 1), ("s3", "rows:order", 1), ("s1", "blank:order:note", 1), ("s3", "blank:order:note", 1),
        ("s1", "non_trading_day:trade", 2), ("s1", "non_trading_day:order", 1),
    ])
    whole = {r.rule: r.n for r in rules.report({"trade": trades, "order": orders}, volumes=True).collect()}
    assert whole["trade_without_order"] == 2 and whole["securities:trade"] == 2 and whole["rows:order"] == 2 and whole["order_range"] == 0


def test_volumes_of_ranges_merge(spark):
    first = date(2018, 1, 1)
    df = spark.range(60000).select(F.date_add(F.lit(str(first)).cast("date"), (F.col("id") % 40).cast("int")).alias("trade_date"), F.format_string("%06d", F.pmod(F.xxhash64("id"), F.lit(30000))).alias("securityid"))
    states, maps = volumes.daily_states({"x": df, "y": df.where("securityid < '000100'")}), volumes.daily_bitmaps({"x": df, "y": df.where("securityid < '000100'")})
    for lo, hi in (("2018-01-01", "2018-02-28"), ("2018-01-03", "2018-01-09"), ("2018-01-05", "2018-01-05")):
        inside = df.where(F.col("trade_date").between(lo, hi))
        want = {"x": inside, "y": inside.where("securityid < '000100'")}
        about = {r.feed: (r.n_rows, r.n_items) for r in volumes.over_range(states, lo, hi).collect()}
        exact = {r.feed: r.n_items for r in volumes.exact_over_range(maps, lo, hi).collect()}
        for name, rows in want.items():
            n, items = rows.count(), rows.select("securityid").distinct().count()
            assert about[name][0] == n and abs(about[name][1] - items) <= 0.02 * items and exact[name] == items
    assert volumes.over_range(states, "2030-01-01", "2030-01-02").isEmpty()


def test_rules_are_counted_by_the_job_that_writes(spark, tmp_path):
    days = [DAY, DAY + timedelta(1), DAY + timedelta(2)]
    path = str(tmp_path / "rows")
    spark.createDataFrame([(days[i % 2], float(i % 4 - 1), i) for i in range(100)], "trade_date date, price double, tradeqty int").write.parquet(path)
    df = spark.read.parquet(path)
    bad = {"trade_range": rules.bad_trade(), "cheap": F.col("price") < 1}
    watch = RuleWatch(df, bad, days)
    out = watch.watched.where("tradeqty < 50").withColumn("x", F.lit(1))
    out.write.parquet(str(tmp_path / "out"))
    got = sorted(map(tuple, watch.counts().collect()))
    assert got == sorted(map(tuple, rules.count_rows(df, bad).collect())) and len(got) == 4
    assert sorted(map(tuple, watch.counts(99).collect())) == got  # a count that does not fit: counted afresh
    short = RuleWatch(df, bad, days[:1])
    short.watched.count()
    short.watched.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError):
        short.counts(100)
    assert executed(RuleWatch(df, bad, days).watched.where("price > 0")).count("FileScan") == 1


def test_first_rows(spark, rows):
    df = spark.createDataFrame([(i % 7, i, None if i % 5 else i) for i in range(50)], "a int, b int, c int")
    assert rows(relational.first_rows(df, [F.desc("a")], 3)) == [(6, 48, None), (6, 41, None), (6, 34, None)]
    assert rows(relational.first_rows(df.limit(0), [F.desc("a")], 3)) == []
    assert "TakeOrderedAndProject" in executed(relational.first_rows(df, [F.desc("a")], 3))


def test_months_in_one_plan_without_nested_loops(spark):
    from proxy.core import Tables
    from quotewell.plans.marts import products, ranges

    t = Tables(spark, "/root/testdata/sf0.001")
    out = ranges.product_profit_range(t, "1998-04-30", "1998-06-30")
    plan = executed(out)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = sorted(tuple(r) for r in out.where("data_dt = date'1998-05-31'").select("pty_id", "prdt_id", "flag", "hold_days", "buy_cnt", "sell_cnt").collect())
    want = products.product_profit_month(t, "1998-05-31").select("pty_id", "prdt_id", "flag", "hold_days", "buy_cnt", "sell_cnt")
    assert got == sorted(tuple(r) for r in want.collect()) and got
