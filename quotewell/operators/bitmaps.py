"""Sets of whole numbers as bitmaps: 32,768 neighbours share one row of 4 KB.

Order numbers of a day and channel run almost without gaps, so their set is a
few bitmaps, which are built map-side and take the place of the rows in the
shuffle. Membership is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "bucket", "bits"
ROWS = 1 << 16  # numbers a task builds bitmaps of: scattered ones take 4 KB each


def place(number: Column) -> tuple[Column, Column]:
    """Which bitmap a number is in, and at which bit."""
    return F.bitmap_bucket_number(number), F.bitmap_bit_position(number)


def number_bitmaps(df: DataFrame, number: str, by: Sequence[str]) -> DataFrame:
    """by..., bucket, bits: the numbers of each group as bitmaps, nulls left out.
    The rows are counted, and dealt by bitmap where one task would hold too many."""
    bucket, bit = place(F.col(number).cast("bigint"))
    known = df.where(F.col(number).isNotNull()).select(*by, bucket.alias(BUCKET), bit.alias("_bit"))
    tasks = -(-known.count() // ROWS)
    if tasks > 1:
        known = known.repartition(tasks, F.xxhash64(*by, BUCKET))
    return known.groupBy(*by, BUCKET).agg(F.bitmap_construct_agg("_bit").alias(BITS))


def merged_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of the same numbers from several loads as one set."""
    return bitmaps.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def is_set(bits: Column, bit: Column) -> Column:
    """Whether a bit of a bitmap is set; false without a bitmap."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    one = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8).cast("int") + 1)
    return F.coalesce(byte.bitwiseAND(one) != 0, F.lit(False))


def count_outside(named: DataFrame, known: DataFrame, by: Sequence[str]) -> DataFrame:
    """by..., n: how many numbers of ``named`` bitmaps are not in ``known`` ones.
    What both hold together, less what is known; groups without any are left out."""
    both = named.select(*by, BUCKET, BITS, F.lit(None).cast("binary").alias("_known")).unionByName(
        known.select(*by, BUCKET, BITS, F.col(BITS).alias("_known"))
    )
    met = both.groupBy(*by, BUCKET).agg(F.bitmap_count(F.bitmap_or_agg(BITS)).alias("_all"), F.bitmap_count(F.bitmap_or_agg("_known")).alias("_in"))
    return met.groupBy(*by).agg(F.sum(F.col("_all") - F.coalesce("_in", F.lit(0))).alias("n")).where("n > 0")


def rows_outside(df: DataFrame, number: str, known: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows whose number is in no bitmap of their group; copies stay, rows
    without a number go. Bitmaps meet rows by (by, bucket): the rows of a bucket
    that fills more than a task are split by the engine's skew join."""
    bucket, bit = place(F.col(number).cast("bigint"))
    names = [f"_b_{c}" for c in (*by, BUCKET)]
    sets = known.select(*[F.col(c).alias(n) for c, n in zip((*by, BUCKET), names, strict=True)], F.col(BITS).alias("_bits"))
    same = F.lit(True)
    for c, n in zip((*by, "_bucket"), names, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(n))
    placed = df.where(F.col(number).isNotNull()).withColumns({"_bucket": bucket, "_bit": bit})
    return placed.join(sets, same, "left").where(~is_set(F.col("_bits"), F.col("_bit"))).select(*df.columns)
