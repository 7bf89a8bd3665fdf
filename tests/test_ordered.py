"""Skewed inputs: one key holds most rows, and copies hold a third of them."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quotewell.operators import copies, ordered, relational


@pytest.fixture(scope="module")
def ticks(spark, tmp_path_factory):
    rng = random.Random(3)
    out = []
    for i in range(1500):
        key = "hot" if rng.random() < 0.8 else rng.choice("abc")
        out.append((key, rng.choice([None, *range(40)]), i, rng.choice([None, rng.randint(-5, 5)])))
    out += [(None, 1, -1, 3), (None, 2, -2, None)]
    path = str(tmp_path_factory.mktemp("ticks") / "rows")
    spark.createDataFrame(out, "k string, t int, seq int, v int").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("ranges", [2, 9, 300, 5000])
def test_previous_equals_plain_window(ticks, ranges):
    w = Window.partitionBy("k").orderBy("t", "seq")
    want = ticks.withColumn("prev_v", F.lag("v").over(w)).withColumn("prev_t", F.lag("t").over(w))
    got = ordered.with_previous(ticks, ["k"], ["t", "seq"], ["v", "t"], ranges=ranges)
    got = got.select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


@pytest.mark.parametrize("ranges", [2, 9, 300, 5000])
@pytest.mark.parametrize("keys", [["k"], []])
def test_running_sum_equals_plain_window(ticks, ranges, keys):
    w = Window.partitionBy(*keys).orderBy("t", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = ticks.withColumn("s", F.sum("v").over(w))
    got = ordered.with_running_sum(ticks, keys, ["t", "seq"], "v", "s", ranges).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


@pytest.mark.parametrize("ranges", [3, 400])
def test_rank_equals_plain_window(ticks, ranges):
    want = ticks.withColumn("rk", F.rank().over(Window.orderBy(F.desc_nulls_last("v"))))
    got = ordered.with_rank(ticks, "v", "rk", "n", ranges)
    assert got.where("n <> 1502").isEmpty()
    got = got.drop("n").select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


@pytest.mark.parametrize("chunk", [1, 3, 1 << 20])
def test_copies_fold_and_unfold(spark, chunk):
    df = spark.createDataFrame([("x", 1)] * 10 + [("y", None)] * 3 + [("z", 2)], "a string, b int")
    back = copies.unfold_copies(copies.fold_copies(df), chunk=chunk)
    assert back.count() == 14 and back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


@pytest.mark.parametrize("ranges", [3, 400])
def test_row_number_over_copies(spark, ranges):
    df = spark.createDataFrame(
        [("hot", 1, "a")] * 7 + [("hot", i % 5, "b") for i in range(20)] + [("c", 1, "d")], "k string, t int, x string"
    )
    got = copies.with_row_number(df, ["k"], ["t"], "rn", ranges)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("t", "x")).cast("bigint"))
    assert got.exceptAll(want).isEmpty() and got.count() == 28


def test_keep_latest_trims_before_the_shuffle(ticks):
    plan = relational.keep_latest(ticks, ["k"], [F.desc("seq")])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle


def test_one_exchange_when_no_key_is_hot(spark):
    df = spark.range(4000).selectExpr("id % 97 as k", "id % 13 as t", "id as seq", "id % 5 as v")
    out = ordered.with_previous(df, ["k"], ["t", "seq", "v"], ["v"], ranges=8, fold=True)
    final = executed(out)
    assert final.count("Exchange hashpartitioning") == 1 and "Broadcast" not in final


def test_hot_key_takes_many_tasks_and_one_exchange(spark, ticks):
    out = ordered.with_previous(ticks, ["k"], ["t", "seq", "v"], ["v"], ranges=40, fold=True)
    final = executed(out)
    # the rows once; the table of ends reads the same exchange again
    moves = [line for line in final.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moves) == 2 and sum("ReusedExchange" in line for line in moves) == 1
    dealt = ordered.deal(ticks, ["k"], ["t", "seq", "v"], 40)
    sizes = dealt.rows.where("k = 'hot'").groupBy(ordered.RANGE).count().collect()
    assert len(sizes) >= 25 and max(r["count"] for r in sizes) < 150


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_keys_are_found_in_a_sample(spark):
    df = spark.range(40000).selectExpr("case when id % 3 = 0 then 'hot' else cast(id % 9001 as string) end as k", "id as t", "id % 7 as v")
    dealt = ordered.deal(df, ["k"], ["t"], 12)
    sizes = {(r.k, r[ordered.RANGE]): r["count"] for r in dealt.rows.where(f"{ordered.RANGE} >= 0").groupBy("k", ordered.RANGE).count().collect()}
    assert {k for k, _ in sizes} == {"hot"} and len(sizes) >= 3 and max(sizes.values()) < 8000 and sum(sizes.values()) == 13334
    assert ordered.hot_ranges(df.where("k <> 'hot'"), ["k"], ["t"], 12) is None
    w = Window.partitionBy("k").orderBy("t")
    got = ordered.with_previous(df, ["k"], ["t"], ["v"], ranges=12)
    assert got.exceptAll(df.withColumn("prev_v", F.lag("v").over(w))).isEmpty() and got.count() == 40000


def test_copies_fill_no_task(spark):
    """A third of the table is one row: it is counted before the exchange."""
    df = spark.createDataFrame([("hot", 5, "x")] * 900 + [("hot", i % 50, str(i)) for i in range(900)] + [(str(i), 1, "y") for i in range(900)], "k string, t int, x string")
    w = Window.partitionBy("k").orderBy("t", "x")
    dealt = ordered.deal(df, ["k"], ["t", "x"], 24, fold=True)
    assert dealt.cut and dealt.rows.agg(F.sum(ordered.COPIES)).first()[0] == 2700 and dealt.rows.count() == 1801
    assert executed(dealt.rows).count("Exchange hashpartitioning") == 2  # the heavy row's counts, then all rows
    got = ordered.with_previous(df, ["k"], ["t", "x"], ["x"], ranges=24, fold=True).drop(ordered.COPIES)
    want = df.distinct().withColumn("prev_x", F.lag("x").over(w))
    assert got.exceptAll(want).isEmpty() and got.count() == 1801
    numbered = copies.with_row_number(df, ["k"], ["t"], "rn", 24, chunk=100)
    assert numbered.exceptAll(df.withColumn("rn", F.row_number().over(w).cast("bigint"))).isEmpty() and numbered.count() == 2700


@pytest.mark.parametrize("keys", [["k"], []])
def test_empty_tables(spark, keys):
    df = spark.createDataFrame([], "k string, t int, v int")
    assert ordered.with_running_sum(df, keys, ["t"], "v", "s").count() == 0
    assert ordered.with_previous(df, ["k"], ["t"], ["v"]).count() == 0
    assert copies.with_row_number(df, keys, ["t"], "n").count() == 0 and ordered.with_rank(df, "v", "rk", "n").count() == 0


def test_no_window_over_everything(ticks):
    plan = executed(ordered.with_rank(ticks, "v", "rk", ranges=300))
    assert "Window" in plan and "SinglePartition" not in plan


def test_missing_from_keeps_copies_and_matches_nulls(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (None, "n"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(2,), (None,)], "k int")
    assert sorted(tuple(r) for r in relational.missing_from(left, right, ["k"]).collect()) == [(1, "a"), (1, "a")]


def test_running_cost_floors_at_zero(spark, rows):
    flows = spark.createDataFrame(
        [("a", 1, 10, 0), ("a", 2, 0, 4), ("a", 2, 3, 0), ("b", 1, 0, 5), ("b", 2, 1, 0)],
        "p string, d int, i int, o int",
    ).withColumn("net", F.col("i") - F.col("o"))
    got = relational.max_running_floor0(flows, "p", "d", "net", "cost", {"i": "i", "o": "o"})
    assert rows(got.select("p", "i", "o", "cost"), "p") == [("a", 13, 4, 10), ("b", 1, 5, 0)]


def test_partial_upsert_leaves_absent_cells(spark, rows):
    base = spark.createDataFrame([(1, "0", "x"), (2, "0", "y")], "k int, f string, other string")
    change = spark.createDataFrame([(1, "2"), (2, None), (3, "1")], "k int, f string")
    assert rows(relational.partial_upsert(base, change, ["k"], ["f"]), "k") == [(1, "2", "x"), (2, "0", "y")]
