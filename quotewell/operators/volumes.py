"""Rows and distinct securities over ranges of days, from stored daily states.

A day's distinct count cannot be added to another day's. Its sketch can: each
day keeps rows and a HyperLogLog sketch, and a range merges sketches instead of
reading rows again. Where ids are whole numbers a day keeps their bitmaps
(``operators.bitmaps``) too, which merge alike and count exactly.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.functions.times import as_date
from quotewell.operators import bitmaps

DAY, SECURITY = "trade_date", "securityid"
LOG2_REGISTERS = 15  # standard error 1.04 / sqrt(2^15) = 0.6 %


def daily_states(feeds: Mapping[str, DataFrame], item: str = SECURITY, bits: int = LOG2_REGISTERS) -> DataFrame:
    """(trade_date, feed, n_rows, sketch): at most 2^bits registers a day and
    feed, whatever the number of rows."""
    parts = [
        df.groupBy(DAY).agg(F.count("*").alias("n_rows"), F.hll_sketch_agg(item, F.lit(bits)).alias("sketch")).withColumn("feed", F.lit(name))
        for name, df in feeds.items()
    ]
    return reduce(DataFrame.unionByName, parts).select(DAY, "feed", "n_rows", "sketch")


def _inside(states: DataFrame, first, last) -> DataFrame:
    return states.where(F.col(DAY).between(as_date(first), as_date(last)))


def over_range(states: DataFrame, first, last) -> DataFrame:
    """(feed, n_rows, n_items): rows, and about how many distinct items the days
    hold together (null items do not count)."""
    merged = _inside(states, first, last).groupBy("feed").agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("feed", "n_rows", F.hll_sketch_estimate("sketch").alias("n_items"))


def daily_bitmaps(feeds: Mapping[str, DataFrame], item: Column | str = SECURITY) -> DataFrame:
    """(trade_date, feed, bucket, bits): the items of a day as whole numbers."""
    number = (F.col(item) if isinstance(item, str) else item).cast("bigint")
    parts = [
        bitmaps.number_bitmaps(df.select(DAY, number.alias("_number")), "_number", [DAY]).withColumn("feed", F.lit(name)) for name, df in feeds.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def exact_over_range(states: DataFrame, first, last) -> DataFrame:
    """(feed, n_items): how many distinct items the days hold together."""
    merged = bitmaps.merged_bitmaps(_inside(states, first, last), ["feed"])
    return merged.groupBy("feed").agg(F.sum(F.bitmap_count(bitmaps.BITS)).alias("n_items"))
