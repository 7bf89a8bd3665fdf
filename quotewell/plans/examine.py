"""Examining rows already in the serving table: blank cells, levels without a
price, limits, totals and extremes that move backwards, closed days."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.operators import rules
from quotewell.operators.ordered import with_previous
from quotewell.plans.publish import INDEX_COLUMNS, SNAP_COLUMNS, SNAP_NEW_COLUMNS, SNAP_SH_COLUMNS
from quotewell.sources.schemas import DEPTH

_LEVEL_CELLS = ("OrderQty", "Price", "NumOrders", "NoOrders")
# Serving-table columns that must not be blank, all ten levels on both sides.
TRACKED = [
    *[f"{side}{i}{cell}" for side in ("Buy", "Sell") for i in range(1, DEPTH + 1) for cell in _LEVEL_CELLS],
    *SNAP_COLUMNS.values(), "ClosePx", "DiffPx1", "DiffPx2", "MinPx", "MaxPx", "TotalBidQty", "TotalOfferQty",
    *SNAP_SH_COLUMNS.values(), "SLYOne", "SLYTwo",
]
_TO_FEED = {
    **{store: feed for feed, store in {**SNAP_COLUMNS, **SNAP_NEW_COLUMNS, **INDEX_COLUMNS}.items()},
    **{f"{store}{i}{cell}": f"{feed}{what}{i}" for store, feed in (("Buy", "bid"), ("Sell", "offer"))
       for i in range(1, DEPTH + 1) for cell, what in (("Price", "px"), ("OrderQty", "size"))},
    "SecurityID": "securityid",
}


def moves_back(df: DataFrame, falls: list[str], rises: list[str], detail: bool = False,
               ranges: int | None = None) -> DataFrame:
    """Columns that fall (or rise) between consecutive rows of a security, one
    rule per column, all in one ordered pass. Zero means "no value"."""
    keys, watched = [rules.DAY, rules.SECURITY], [*falls, *rises]
    # copies never move against each other, so one of each is enough: they fold
    rows = df.select(*keys, "ts", *watched)
    prev = with_previous(rows, keys, ["ts", *watched], watched, "_prev_", ranges, fold=True)
    tests = {f"{c}_falls": (F.col(c) != 0) & (F.col(c) < F.col(f"_prev_{c}")) for c in falls}
    tests |= {f"{c}_rises": (F.col(c) != 0) & (F.col(c) > F.col(f"_prev_{c}")) for c in rises}
    return rules.count_rows(prev, tests, detail)


def examine(store: DataFrame, holidays: DataFrame | None = None, absent: bool = True,
            detail: bool = False) -> DataFrame:
    """(trade_date, rule, n) over stored snapshots. ``absent`` counts missing
    cells as blank too."""
    df = store.withColumnsRenamed(_TO_FEED).withColumn("clock", F.col("MDTime").cast("bigint"))
    tests = {
        f"blank:{c}": rules.blank(_TO_FEED.get(c, c), absent) for c in TRACKED if c in store.columns
    }
    tests |= {
        "level_qty_without_price": rules.level_without_price(), "outside_limits": rules.outside_limits(),
        "outside_high_low": rules.outside_high_low(),
    }
    parts = [
        rules.count_rows(df, tests, detail),
        moves_back(df, ["totalvolumetrade", "totalvaluetrade", "highpx"], ["lowpx"], detail),
    ]
    if holidays is not None:
        parts.append(rules.on_closed_days(df, holidays, detail=detail))
    return reduce(DataFrame.unionByName, parts)
