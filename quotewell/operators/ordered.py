"""Ordered scans (previous row, running sum, row number, rank) that stay whole
and exact when one key holds most of the table.

A plain window puts every row of a key into one task. Here the keys of a sample
are counted first. A key that holds more than its share (2 of ``ranges`` equal shares of the
table) is cut into ranges of its order, at places taken from a sample of its
rows; all other keys stay whole. Rows are then dealt by (key, range) in one
exchange, which serves the folding of copies, the totals and the window alike.

What a range needs from the ones before it (last row, running total) is one
value per range, found on the dealt rows and joined back to them. All tables of
ranges have at most ``ranges`` rows, 4 per shuffle partition by default.
The cuts are written out, so a re-run after a lost executor cuts alike.

Exact copies cannot be told apart by any order. ``fold`` counts them after the
exchange; copies that would fill ranges of their own are counted before it.
Order columns sort ascending, nulls first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from quotewell.session import scratch_dir

RANGES_PER_PARTITION = 4
SAMPLES_PER_RANGE = 32
COUNT_RATE = 1 / 16  # of the rows, to find hot keys
BLOCK = 64  # ranges whose totals are added up in one window
COPIES, RANGE = "_copies", "_range"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)])


def _renamed(keys: Sequence[str]) -> list[str]:
    return [f"_k_{k}" for k in keys]


def range_count(df: DataFrame, ranges: int | None) -> int:
    return ranges or RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int) -> DataFrame | None:
    """For each key above its share (at most ranges / 2 of them): _k_ keys, the
    order values at which its ranges start, and those of them that fill a range
    of their own. None where no key is. Samples decide where rows are cut, which
    changes no result."""
    names = _renamed(keys)
    own = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.lit(1).alias("_one"))
    rate, rows = COUNT_RATE, 0
    while True:  # all rows are counted, keys in a sample of them, or in all where the sample would be small
        seen = Observation()
        counted = own.observe(seen, F.count("*").alias("rows")).sample(rate, 7).groupBy(*names).agg(F.count("*").alias("n"))
        most = counted.agg(F.max("n")).first()[0] or 0
        rows = seen.get["rows"] if most else 0  # an empty plan observes nothing
        if rate == 1 or rows * rate >= SAMPLES_PER_RANGE * ranges:
            break
        rate = 1.0
    if not rows or most * ranges < 2 * rows * rate:
        return None
    hot = _written(own.sample(rate, 7).groupBy(*names).agg(F.count("*").alias("n")).where(F.col("n") * ranges >= 2 * rows * rate), "hot-keys")
    rate = min(1.0, SAMPLES_PER_RANGE * ranges / rows)
    mine = df.join(F.broadcast(hot), _same(keys, names)) if keys else df
    sample = mine.select(*names, F.struct(*order).alias("at")).sample(rate, 11)  # some 32 rows a range in all
    sorted_ = sample.groupBy(*names).agg(F.array_sort(F.collect_list("at")).alias("seen"))
    size = F.size("seen")
    units = F.floor(size * F.lit(ranges) / F.lit(rate * rows)).cast("int") if keys else F.least(F.lit(max(2, ranges)), size + 1)
    picked = F.transform(F.sequence(F.lit(1), units - 1), lambda i: F.element_at("seen", (F.lit(1) + F.floor(i * size / units)).cast("int")))
    cuts = sorted_.where(units >= 2).select(*names, picked.alias("picked"))
    again = F.filter(
        F.zip_with("picked", F.slice("picked", F.lit(2), F.size("picked")), lambda a, b: F.when(a == b, a)), lambda x: x.isNotNull()
    )
    cuts = _written(cuts.select(*names, F.array_distinct("picked").alias("_starts"), F.array_distinct(again).alias("_heavy")), "ranges")
    return None if cuts.isEmpty() else cuts


def _range_of(order: Sequence[str]) -> Column:
    """How many starts lie at or before this row: a binary search."""
    at = F.struct(*order)

    def narrow(low: Column, step: Column) -> Column:
        probe = low + step
        return F.when(F.get(F.col("_starts"), probe - 1) <= at, probe).otherwise(low)

    # steps from the greatest power of two within the number of starts down to 1
    depth = F.floor(F.log2(F.size("_starts"))).cast("int")
    steps = F.transform(F.sequence(depth, F.lit(0), F.lit(-1)), lambda i: F.pow(F.lit(2), i).cast("int"))
    return F.when(F.col("_starts").isNull(), F.lit(-1)).otherwise(F.aggregate(steps, F.lit(0), narrow))


@dataclass(frozen=True)
class Dealt:
    """Rows dealt by ``part``: the keys and, where any key is cut, the range (-1 for keys that are whole)."""

    rows: DataFrame
    part: list[str]
    cut: bool

    def window(self, order: Sequence[str]):
        return Window.partitionBy(*self.part).orderBy(*order)

    def joined(self, rows: DataFrame, carried: DataFrame, column: str) -> DataFrame:
        """rows with ``column`` of the table of ranges (part, column), at most one row a range."""
        names = _renamed(self.part)
        small = F.broadcast(carried.select(*[F.col(p).alias(n) for p, n in zip(self.part, names, strict=True)], column))
        return rows.join(small, _same(self.part, names), "left").drop(*names)


def deal(df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int, fold: bool = False) -> Dealt:
    """One exchange of the rows by key and range. With ``fold`` equal rows become
    one with their number in ``_copies``; keys and order then have to name all columns."""
    columns, hot = df.columns, hot_ranges(df, keys, order, ranges)
    if hot is None:
        moved = df.repartition(*keys) if keys else df
        return Dealt(moved.groupBy(*columns).agg(F.count("*").alias(COPIES)) if fold else moved, list(keys), False)
    names = _renamed(keys)
    if keys:
        known = df.join(F.broadcast(hot), _same(keys, names), "left")
    else:
        known = df.withColumns({c: hot.select(c).scalar() for c in ("_starts", "_heavy")})
    part = [*keys, RANGE]
    marked = known.withColumn(RANGE, _range_of(order))
    if not fold:
        return Dealt(marked.select(*columns, RANGE).repartition(*part), part, True)
    one = F.lit(1).cast("bigint").alias(COPIES)
    if hot.where(F.size("_heavy") > 0).isEmpty():
        light = marked.select(*columns, RANGE, one)
    else:
        heavy = F.coalesce(F.array_contains("_heavy", F.struct(*order)), F.lit(False))
        counted = marked.where(heavy).groupBy(*columns, RANGE).agg(F.count("*").alias(COPIES))
        light = marked.where(~heavy).select(*columns, RANGE, one).unionByName(counted)
    folded = light.repartition(*part).groupBy(*columns, RANGE).agg(F.sum(COPIES).alias(COPIES))
    return Dealt(folded, part, True)


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
    prefix: str = "prev_", ranges: int | None = None, fold: bool = False,
) -> DataFrame:
    """Adds ``prefix + column``: the value on the previous row of the same key
    (with ``fold``: the previous different row, see ``deal``)."""
    dealt = deal(df, keys, order, range_count(df, ranges), fold)
    w = dealt.window(order)
    lagged = {prefix + c: F.lag(c).over(w) for c in columns}
    if not dealt.cut:
        return dealt.rows.withColumns(lagged)
    last = dealt.rows.groupBy(*dealt.part).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_last"), F.max(RANGE).alias("_r"))
    # only range 0 of a key can be empty, so the row before a range is the last of the one below
    carried = last.where("_r >= 0").select(*[(F.col(p) + 1).alias(p) if p == RANGE else p for p in dealt.part], "_last")
    rows = dealt.rows.withColumns({**lagged, "_first": F.row_number().over(w) == 1})
    out = dealt.joined(rows, carried, "_last")
    return out.withColumns(
        {prefix + c: F.when(F.col("_first"), F.col("_last").getField(c)).otherwise(F.col(prefix + c)) for c in columns}
    ).drop("_first", "_last", RANGE)


def sums_before(totals: DataFrame, keys: Sequence[str], ranges: int) -> DataFrame:
    """totals (keys, _range, _total) with _before: the sum over the key's lower
    ranges. Ranges add up within blocks, blocks are sent on to later blocks."""
    block = F.floor(F.col(RANGE) / BLOCK).cast("int")
    blocked = totals.withColumn("_block", block)
    w = Window.partitionBy(*keys, "_block").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    within = blocked.withColumn("_before", F.sum("_total").over(w))
    last = (ranges - 1) // BLOCK
    if not last:
        return within.drop("_block")
    names = _renamed([*keys, "_block"])
    later = F.explode(F.sequence(F.col("_block") + 1, F.lit(last))).alias("_later")
    spread = (
        blocked.groupBy(*keys, "_block").agg(F.sum("_total").alias("_sum")).where(F.col("_block") < last)
        .select(*keys, later, "_sum").groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_later").alias("_k__block"))
        .agg(F.sum("_sum").alias("_lower"))
    )
    both = within.join(spread, _same([*keys, "_block"], names), "left").drop(*names)
    return both.withColumn("_before", _added(F.col("_before"), F.col("_lower"))).drop("_lower", "_block")


def _added(a: Column, b: Column) -> Column:
    """The sum, a null being nothing; null where both are."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def with_running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
    ranges: int | None = None, fold: bool = False,
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` up to and including this row. Without
    keys the sum runs over the whole table. With ``fold`` value is ``_copies``."""
    count = range_count(df, ranges)
    dealt = deal(df, keys, order, count, fold)
    upto = dealt.window(order).rowsBetween(Window.unboundedPreceding, 0)
    if not dealt.cut:  # without keys only an empty table is not cut
        return dealt.rows.withColumn(out, F.sum(value).over(upto))
    totals = dealt.rows.groupBy(*dealt.part).agg(F.sum(value).alias("_total"), F.max(RANGE).alias("_r"))
    carried = sums_before(totals.where("_r >= 0").drop("_r"), keys, count)
    run = dealt.rows.withColumn(out, F.sum(value).over(upto))
    kind = run.schema[out].dataType
    return dealt.joined(run, carried, "_before").withColumn(out, _added(F.col(out), F.col("_before")).cast(kind)).drop("_before", RANGE)


def with_rank(df: DataFrame, value: str, out: str = "rk", total: str | None = None, ranges: int | None = None) -> DataFrame:
    """Adds the global ``rank() over (order by value desc)`` without bringing the
    table into one task: count per distinct value, run the counts from the top
    down, join the ranks back. ``total`` names an optional row-count column.
    Numeric values only; null values rank last."""
    counts = (
        df.groupBy(value).agg(F.count("*").alias("_n"))
        .withColumn("_null_last", F.col(value).isNull())
        .withColumn("_down", -F.col(value))
    )
    run = with_running_sum(counts, [], ["_null_last", "_down"], "_n", "_upto", ranges)
    ranks = run.select(F.col(value).alias("_value"), (F.col("_upto") - F.col("_n") + 1).alias(out))
    ranked = df.join(ranks, df[value].eqNullSafe(ranks["_value"]), "left").drop("_value")
    return ranked.withColumn(total, counts.agg(F.sum("_n")).scalar()) if total else ranked
