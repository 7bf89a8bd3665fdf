"""Removing rows that break rules before they are published (old format)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.functions.times import CONTINUOUS_SESSIONS, in_sessions
from quotewell.operators import rules
from quotewell.operators.relational import keep_latest, missing_from
from quotewell.operators.rules import COUNTERS, DAY, SECURITY


def clean_snapshots(df: DataFrame, ranges: int | None = None) -> DataFrame:
    """Drops rows with bad prices or totals, and every row at a (security, time)
    where a counter fell during continuous trading."""
    fell = rules.breaks(
        df, ["ts", "numtrades"], falls=COUNTERS, keep=["clock"], ranges=ranges
    ).where(in_sessions(F.col("clock"), CONTINUOUS_SESSIONS))
    good = df.where(~(rules.bad_snapshot_price() | rules.negative(COUNTERS)))
    return missing_from(good, fell, [DAY, SECURITY, "ts"])


def clean_book(df: DataFrame) -> DataFrame:
    """Drops every row at a (security, time) with a priced level of quantity 0."""
    bad = df.where(rules.level_without_quantity())
    return missing_from(df, bad, [DAY, SECURITY, "ts"])


def _latest(df: DataFrame, *order: str) -> DataFrame:
    """One row per (security, time); ties fall to the greatest of the remaining columns."""
    keys = [DAY, SECURITY, "ts"]
    rest = [c for c in df.columns if c not in keys and c not in order]
    return keep_latest(df, keys, [F.desc_nulls_last(c) for c in (*order, *rest)])


def latest_snapshots(df: DataFrame) -> DataFrame:
    """One row per (security, time): the largest volume."""
    return _latest(df, "totalvolumetrade", "numtrades", "totalvaluetrade", "lastpx")


def latest_books(df: DataFrame) -> DataFrame:
    """One row per (security, time): the last one sent."""
    return _latest(df, "sendtime")


def clean_trades(df: DataFrame, fmt: str = "old", ranges: int | None = None) -> DataFrame:
    """Drops executed trades without price or quantity, and trades whose number
    does not rise or whose time falls."""
    key = [DAY, SECURITY, "ts", "applseqnum"]
    unpriced = df.where(rules.bad_trade(rules.executed(fmt))).select(*key)
    unordered = rules.breaks(
        df, ["applseqnum"], falls=["ts"], not_rising=["applseqnum"], ranges=ranges
    ).select(*key)
    return missing_from(df, unpriced.unionByName(unordered), key)


def clean_orders(df: DataFrame, tolerance: int = 1000, ranges: int | None = None) -> DataFrame:
    """Drops negative prices and quantities, and orders whose number falls or
    whose clock falls by more than ``tolerance``."""
    unordered = rules.breaks(
        df, ["applseqnum"], falls={"applseqnum": 0, "clock": tolerance}, ranges=ranges
    )
    good = df.where((F.col("price") >= 0) & (F.col("orderqty") >= 0))
    return missing_from(good, unordered, [DAY, SECURITY, "applseqnum", "clock"])


def clean_index(df: DataFrame, ranges: int | None = None) -> DataFrame:
    """Drops every row at a (security, time) where time or volume fell."""
    fell = rules.breaks(
        df, ["ts", "totalvolumetrade"], falls=["ts", "totalvolumetrade"], ranges=ranges
    )
    return missing_from(df, fell, [DAY, SECURITY, "ts"])
