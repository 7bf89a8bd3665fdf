"""Greatest running total as a state that merges.

The state of a stretch of days is (total, peak): the sum of its nets and the
greatest running sum within it. Two stretches in a row merge into
(t1 + t2, greatest(p1, t1 + p2)), which is associative, so states may be stored
per key and period, recomputed one period at a time and folded in any grouping.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOTAL, PEAK = "total", "peak"


def peak_states(flows: DataFrame, keys: Sequence[str], period: str, day: str, net: str, sums: Mapping[str, str]) -> DataFrame:
    """One state per key and period: ``keys``, ``period``, ``sums`` (output ->
    input), total, peak. Flows of a day add up before they run; the window sees
    at most one row per day of the period."""
    daily = flows.groupBy(*keys, period, day).agg(F.sum(net).alias("_net"), *[F.sum(c).alias(name) for name, c in sums.items()])
    run = F.sum("_net").over(Window.partitionBy(*keys, period).orderBy(day))
    return daily.withColumn("_run", run).groupBy(*keys, period).agg(
        *[F.sum(name).alias(name) for name in sums], F.sum("_net").alias(TOTAL), F.max("_run").alias(PEAK)
    )


def merge_states(states: DataFrame, keys: Sequence[str], period: str, sums: Sequence[str]) -> DataFrame:
    """The states of a key's periods, in their order, as one. There is one row
    per key and period, so a key's window is as long as its list of periods."""
    before = Window.partitionBy(*keys).orderBy(period).rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.sum(TOTAL).over(before), F.lit(0)) + F.col(PEAK)
    return states.withColumn("_reached", reached).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums], F.sum(TOTAL).alias(TOTAL), F.max("_reached").alias(PEAK)
    )


def floored(peak: Column | str = PEAK) -> Column:
    """A running total starts at 0, so its peak is never below."""
    return F.greatest(F.col(peak) if isinstance(peak, str) else peak, F.lit(0))
