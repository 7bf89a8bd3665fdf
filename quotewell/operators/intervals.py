"""Rows joined to the validity interval that holds their day, for any number of
days at once.

A comparison of days alone would be a nested-loop join. Intervals are cut into
the months they touch instead, and rows meet them by key and month; the exact
test follows on what met. Intervals are clipped to the days asked for first, so
one that is open to 2999 gives no more rows than the range has months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.functions.times import as_date

UNITS = {"month": "interval 1 month", "week": "interval 7 days", "year": "interval 1 year"}


def binned(intervals: DataFrame, first, last, begin: str = "bgn_dt", end: str = "end_dt", unit: str = "month", out: str = "_bin") -> DataFrame:
    """One row for each ``unit`` that a half-open interval [begin, end) shares
    with the days from ``first`` to ``last``. Empty and reversed intervals, and
    those with a null bound, have none."""
    lo = F.greatest(F.col(begin), as_date(first))
    hi = F.least(F.date_sub(F.col(end), 1), as_date(last))
    some = F.col(begin).isNotNull() & F.col(end).isNotNull() & (lo <= hi)
    step = F.expr(UNITS[unit])
    return intervals.where(some).withColumn(out, F.explode(F.sequence(F.trunc(lo, unit), F.trunc(hi, unit), step)))


def join_valid(
    df: DataFrame, day: str, intervals: DataFrame, keys: Sequence[str], first, last,
    begin: str = "bgn_dt", end: str = "end_dt", how: str = "inner", unit: str = "month",
) -> DataFrame:
    """Rows of ``df`` with each interval row of the same keys that holds their
    ``day`` (begin <= day < end). Intervals that overlap each give a row, as a
    comparison join would. ``how`` is inner, left or left_semi; days of ``df``
    lie between ``first`` and ``last``, rows of other days match nothing."""
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"no {how} join by validity")
    rest = [c for c in intervals.columns if c not in (*keys, begin, end)]
    cut = binned(intervals, first, last, begin, end, unit).select(
        *[F.col(k).alias(f"_v_{k}") for k in keys], F.col("_bin").alias("_v_bin"), F.col(begin).alias("_v_begin"), F.col(end).alias("_v_end"),
        *([] if how == "left_semi" else rest),
    )
    same: Column = F.trunc(F.col(day), unit) == F.col("_v_bin")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_v_{k}"))
    holds = (F.col("_v_begin") <= F.col(day)) & (F.col(day) < F.col("_v_end"))
    joined = df.join(cut, same & holds, how)
    return joined.drop(*[f"_v_{k}" for k in keys], "_v_bin", "_v_begin", "_v_end")
