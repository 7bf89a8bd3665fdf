"""Money, ratios and blank-cell handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trade_money(price: Column, quantity: Column) -> Column:
    """price * quantity, half-even at three decimals, computed in decimals."""
    return F.bround(price.cast("decimal(20,6)") * quantity.cast("decimal(18,0)"), 3)


def whole_part(text: Column) -> Column:
    """'1200.00' -> 1200."""
    return F.substring_index(text, ".", 1).try_cast("bigint")


def drop_dash(c: Column) -> Column:
    return F.nullif(c, F.lit("-"))


def drop_null_word(c: Column) -> Column:
    return F.nullif(c, F.lit("NULL"))


def blank_or_nan(c: Column) -> Column:
    """Empty, null or the word NaN (a double's NaN prints as that word)."""
    text = F.trim(c.cast("string"))
    return F.coalesce(text.isin("", "NaN"), F.lit(True))


def ratio(numerator: Column, denominator: Column, digits: int | None = None, empty=0) -> Column:
    """numerator / denominator as a double; ``empty`` when the denominator is 0."""
    raw = numerator.cast("double") / denominator.cast("double")
    value = F.when(denominator == 0, F.lit(empty).cast("double")).otherwise(raw)
    return value if digits is None else F.round(value, digits)


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def floor_zero(c: Column) -> Column:
    return F.greatest(c, F.lit(0))
