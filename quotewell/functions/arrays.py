"""Array columns: order queues and the ten-level book, without Python UDFs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def pipe_list(text: Column) -> Column:
    """'100|200|5' -> array of doubles; null when blank."""
    parts = F.split(F.trim(text), "[|]")
    return F.when(
        F.trim(text) != "", F.transform(parts, lambda x: x.try_cast("double"))
    )


def nonzero_list(cells: list[Column]) -> Column:
    """Numbered columns -> array of the values that parse and are not zero."""
    values = F.array(*[c.try_cast("double") for c in cells])
    return F.filter(values, lambda x: x != 0.0)


def side_levels(prices: list[str], sizes: list[str]) -> Column:
    """One book side as array<struct<px,qty>>, best level first."""
    return F.array(*[
        F.struct(F.col(p).cast("double").alias("px"), F.col(q).cast("bigint").alias("qty"))
        for p, q in zip(prices, sizes)
    ])


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def price_without_quantity(prices: list[Column], sizes: list[Column]) -> Column:
    return any_of([(p != 0.0) & (q == 0) for p, q in zip(prices, sizes)])


def quantity_without_price(prices: list[Column], sizes: list[Column]) -> Column:
    return any_of([(p == 0.0) & (q > 0) for p, q in zip(prices, sizes)])


def book_out_of_order(bids: list[Column], offers: list[Column]) -> Column:
    """``bids`` worst to best, ``offers`` best to worst, any depth >= 2.

    Bad when bids do not rise from the first quoted level, a bid gap follows a
    quoted level, the best bid passes the best offer, offers do not rise, or an
    offer is quoted behind an empty level. Written level by level as plain
    comparisons so the whole test stays inside generated code.
    """
    bad = []
    for i in range(len(bids) - 1):
        here, nxt = bids[i], bids[i + 1]
        bad.append((here != 0.0) & (nxt <= here))
        if i > 0:
            bad.append((here == 0.0) & (bids[i - 1] > 0.0))
    best_bid, best_offer = bids[-1], offers[0]
    bad.append((best_bid != 0.0) & (best_offer != 0.0) & (best_bid > best_offer))
    for here, nxt in zip(offers, offers[1:]):
        bad.append((here == 0.0) & (nxt > 0.0))
        bad.append((here != 0.0) & (nxt != 0.0) & (nxt <= here))
    return any_of(bad)
