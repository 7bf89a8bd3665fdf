"""Exact copies as a count: fold before a shuffle, unfold after the work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.operators.ordered import COPIES, with_running_sum

CHUNK = 1 << 20  # copies that are dealt to one place


def fold_copies(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct row plus ``_copies``. Counts combine before the
    shuffle, so a row repeated a billion times crosses the network once per
    map task."""
    return df.groupBy(*(columns or df.columns)).agg(F.count("*").alias(COPIES))


def unfold_copies(df: DataFrame, number: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Each row ``_copies`` times, numbered 1.. in ``number`` if asked for. Chunk
    numbers are exploded and dealt over tasks first, then the positions inside
    each chunk, so rows of any number of copies take one way."""
    position = number or "_position"
    last = F.floor((F.col(COPIES) - 1) / chunk).cast("bigint")
    chunks = df.where(F.col(COPIES) > 0).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    dealt = chunks.repartition(*[c for c in df.columns if c != COPIES], "_chunk")
    positions = F.sequence(F.col("_chunk") * chunk + 1, F.least(F.col(COPIES), (F.col("_chunk") + 1) * chunk))
    out = dealt.withColumn(position, F.explode(positions)).drop(COPIES, "_chunk")
    return out if number else out.drop(position)


def with_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str,
                    ranges: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """``row_number()`` per key. Ties are broken by all remaining columns, so
    the numbering is the same on every run; copies take consecutive numbers."""
    ties = [c for c in df.columns if c not in keys and c not in order]
    run = with_running_sum(df, keys, [*order, *ties], COPIES, "_upto", ranges, fold=True)
    first = run.withColumn("_before", F.col("_upto") - F.col(COPIES)).drop("_upto")
    return (
        unfold_copies(first, "_nth", chunk)
        .withColumn(out, F.col("_before") + F.col("_nth"))
        .drop("_before", "_nth")
    )
