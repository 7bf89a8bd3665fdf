"""Relational steps shared by the jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in ``order``. The row_number = 1 filter makes Spark
    trim each map task to one row per key before the shuffle, so a key with a
    third of the table costs one row per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def conditional_sums(code: Column, sums: Mapping[str, tuple[str | Sequence[str], Column | int]]) -> list[Column]:
    """``sum(case code when k then v else 0)`` per entry name -> (code(s), value)."""
    out = []
    for name, (codes, value) in sums.items():
        codes = [codes] if isinstance(codes, str) else list(codes)
        value = value if isinstance(value, Column) else F.lit(value)
        out.append(F.sum(F.when(code.isin(*codes), value).otherwise(F.lit(0))).alias(name))
    return out


def union_padded(frames: Sequence[DataFrame], measures: Sequence[str]) -> DataFrame:
    """Union all; a measure a branch lacks counts as 0."""
    out = None
    for f in frames:
        padded = f.withColumns({m: F.lit(0) for m in measures if m not in f.columns})
        out = padded if out is None else out.unionByName(padded)
    return out


def with_rate(df: DataFrame, rates: DataFrame, on: Sequence[str] = ("data_dt", "ccy"),
              rate: str = "exchange_rate", inner: bool = False, default: int | None = 1) -> DataFrame:
    """Adds the day's rate per currency; ``default`` where there is none (or,
    with ``inner``, drops rows that have none). A rate row that repeats counts
    once; two different rates of a day and currency are an error when they are met.

    The rate table is broadcast: it holds one row per currency and calendar day,
    and the day filter on ``df`` reaches it through the join key, so a year is
    at most 366 x some 180 currencies. Shuffling instead would put all rows of
    a day's home currency into one partition."""
    one = F.when(F.max(rate) == F.min(rate), F.max(rate)).when(
        F.min(rate).isNotNull(), F.raise_error(F.concat(F.lit("different rates on "), F.concat_ws(" ", *[F.first(c).cast("string") for c in on])))
    )
    r = F.broadcast(rates.groupBy(*on).agg(one.alias(rate)))
    if inner:
        return df.join(r, list(on))
    out = df.join(r, list(on), "left")
    return out if default is None else out.withColumn(rate, F.coalesce(F.col(rate), F.lit(default)))


def close_or_nav(price: Column, nav: Column) -> Column:
    """Closing price, else net asset value, else 0."""
    return F.coalesce(F.nullif(price, F.lit(0)), nav, F.lit(0))


def missing_from(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` with no match in ``other``; copies stay, nulls match nulls."""
    keys = other.select(*[F.col(c).alias(f"_o_{c}") for c in on]).distinct()
    condition = F.lit(True)
    for c in on:
        condition = condition & df[c].eqNullSafe(keys[f"_o_{c}"])
    return df.join(keys, condition, "left_anti")


def present_in(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(other.select(*on), list(on), "left_semi")


def max_running_floor0(flows: DataFrame, customer: str, day: str, net: str, out: str,
                       sums: Mapping[str, str]) -> DataFrame:
    """Highest running net inflow per customer, never below 0, next to plain
    ``sums`` (output -> input). ``flows`` may hold many rows per day: they are
    added up per (customer, day) first, so the window sees at most one row per
    calendar day of the period."""
    daily = flows.groupBy(customer, day).agg(
        F.sum(net).alias(net), *[F.sum(c).alias(c) for c in sums.values()]
    )
    running = daily.withColumn(
        "_run", F.sum(net).over(Window.partitionBy(customer).orderBy(day))
    )
    return running.groupBy(customer).agg(
        *[F.sum(c).alias(name) for name, c in sums.items()],
        F.greatest(F.max("_run"), F.lit(0)).alias(out),
    )


def carry_forward(df: DataFrame, keys: Sequence[str], day: str, value: str, out: str) -> DataFrame:
    """Last known value up to each day. For calendar-length series."""
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def partial_upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str],
                   columns: Sequence[str]) -> DataFrame:
    """New values for some columns of existing rows; an absent new value leaves
    the old one. ``changes`` holds at most one row per key."""
    renamed = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    merged = base.join(renamed, list(keys), "left")
    return merged.withColumns(
        {c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in columns}
    ).select(*base.columns)


def threshold_sums(df: DataFrame, value: str, threshold: float) -> DataFrame:
    """Sum above and sum up to a threshold, in one pass."""
    v = F.col(value)
    return df.agg(
        F.sum(F.when(v > threshold, v)).alias("sum_above"),
        F.sum(F.when(v <= threshold, v)).alias("sum_upto"),
    )


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows in ``order``, in that order; ties fall to the
    greatest of the remaining columns. Every task keeps n rows, nothing is
    sorted as a whole."""
    rest = [F.desc_nulls_last(c) for c in df.columns]
    return df.orderBy(*order, *rest).limit(n)
