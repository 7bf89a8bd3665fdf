"""Table sinks. Tables are Parquet folders partitioned by day; every write
replaces whole partitions, so a re-run gives the same table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.functions.times import as_date
from quotewell.operators.relational import keep_latest, missing_from, partial_upsert
from quotewell.session import scratch_dir
from quotewell.sources.files import drop_folder

DAY = "trade_date"


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def as_stored(df: DataFrame, stored: DataFrame | None) -> DataFrame:
    """``df`` with the stored table's column types, so that all partitions of a
    table keep one schema. Columns the table does not have yet stay as they are."""
    if stored is None:
        return df
    types = {f.name: f.dataType for f in stored.schema.fields}
    return df.withColumns({c: F.col(c).cast(types[c]) for c in df.columns if c in types})


def replace_partition(df: DataFrame, path: str, partition: str = DAY,
                      sort: Sequence[str] = ()) -> None:
    """Overwrites exactly the partitions ``df`` holds. The rebalance hint sizes
    files and splits a big day over several; sorting inside files gives the
    reader usable min/max statistics."""
    out = df.hint("rebalance", F.col(partition))
    if sort:
        out = out.sortWithinPartitions(partition, *sort)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition).parquet(path))


def replace_range(df: DataFrame, path: str, lo, hi, partition: str = "data_dt") -> None:
    """Empties the partitions from ``lo`` to ``hi`` and writes ``df`` into them.
    Days of the range without new rows are dropped. Rows of ``df`` outside the
    range are an error: nothing is written then."""
    spark = df.sparkSession
    inside = F.col(partition).between(as_date(lo), as_date(hi))
    if not df.where(~F.coalesce(inside, F.lit(False))).isEmpty():
        raise ValueError(f"rows with {partition} outside {lo} to {hi}")
    old = read_if_exists(spark, path)
    fresh = as_stored(df, old)
    if old is None:
        return replace_partition(fresh, path, partition)
    gone = (
        old.where(inside).select(partition).distinct()
        .join(fresh.select(partition).distinct(), partition, "left_anti")
    )
    stale = [r[0] for r in gone.collect()]  # at most one value per day of the range
    replace_partition(fresh, path, partition)
    for day in stale:
        drop_folder(spark, f"{path}/{partition}={day}")


def replace_all(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def days_of(df: DataFrame, partition: str = DAY) -> list:
    """The days ``df`` holds (one value per calendar day), null among them if any is."""
    days = [r[0] for r in df.select(partition).distinct().collect()]
    return sorted(d for d in days if d is not None) + [None] * (None in days)


def on_days(df: DataFrame, days: Sequence, partition: str = DAY) -> DataFrame:
    """Rows of the days, as a literal filter that prunes partitions. Dates go
    into it as one piece of text: a column object for each takes seconds where
    there are thousands."""
    known = [d for d in days if d is not None]
    if known and all(type(d) is date for d in known):
        hit = F.expr(f"`{partition}` IN ({', '.join(f"DATE'{d}'" for d in known)})")
    else:
        hit = F.col(partition).isin(known)
    return df.where(hit | F.col(partition).isNull() if None in days else hit)


def written(df: DataFrame, name: str) -> DataFrame:
    """df by way of a scratch table: what follows reads files, and the steps that
    made df run once however often it is looked at."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """The first row per key in ``order``; ties fall to the greatest values of
    the remaining columns, so the choice does not depend on how rows are dealt."""
    return keep_latest(df, keys, [*order, *[F.desc_nulls_last(c) for c in df.columns if c not in keys]])


def upsert(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[Column] = (),
           partition: str = DAY, dry_run: bool = False, keep_absent: bool = False,
           days: Sequence | None = None) -> DataFrame | None:
    """Rows of ``df`` replace stored rows with the same key; within ``df`` the
    first in ``order`` stays (see ``one_per_key``).

    The touched ``days`` are read by a literal filter, so other partitions are
    neither read nor rewritten; without them the new rows are written to scratch
    once and listed there. Stored rows without a new one
    are added as they are. With ``keep_absent`` a null cell of a new row leaves
    the stored cell as it is. ``dry_run`` writes nothing and returns one row:
    the number of keys that would be written, and the least of them."""
    if dry_run:
        return df.select(*keys).distinct().agg(F.count("*").alias("n_keys"), F.min(F.struct(*keys)).alias("first_key"))
    old = read_if_exists(df.sparkSession, path)
    new = one_per_key(as_stored(df, old), keys, order)
    if old is not None:
        if days is None:
            new = written(new, "upsert")
            days = days_of(new, partition)
        touched = on_days(old, days, partition)
        if keep_absent:
            cells = [c for c in old.columns if c not in keys and c != partition]
            was = touched.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_was_{c}") for c in cells])
            same = reduce(lambda a, k: a & new[k].eqNullSafe(was[f"_k_{k}"]), keys, F.lit(True))
            found = new.join(was, same, "left")
            new = found.select(
                *[F.coalesce(F.col(c), F.col(f"_was_{c}")).alias(c) if c in cells else F.col(c) for c in new.columns],
                *[F.col(f"_was_{c}").alias(c) for c in cells if c not in new.columns],
            )
        new = missing_from(touched, new, keys).unionByName(new, allowMissingColumns=True)
    replace_partition(new, path, partition, keys)
    return None


def upsert_columns(changes: DataFrame, path: str, keys: Sequence[str], columns: Sequence[str],
                   partition: str = DAY) -> None:
    """Sets some columns of rows already stored; keys not stored are ignored, and
    of several changes to a key one is taken (see ``one_per_key``)."""
    on = list(dict.fromkeys([partition, *keys]))
    changes = written(one_per_key(changes.select(*on, *columns), on), "changes")
    stored = on_days(changes.sparkSession.read.parquet(path), days_of(changes, partition), partition)
    replace_partition(partial_upsert(stored, as_stored(changes, stored), on, columns), path, partition, keys)


def write_diff(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_stats(stats: DataFrame, path: str, by: Sequence[str] = ("feed", DAY)) -> None:
    """Statistics by feed and day; a repeated run replaces its own rows."""
    (stats.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by).parquet(path))


def write_by_security(df: DataFrame, path: str, security: str = "securityid") -> None:
    df.hint("rebalance", F.col(security)).write.mode("overwrite").partitionBy(security).parquet(path)


def write_clustered(df: DataFrame, path: str, cluster: Sequence[str] = ("securityid", "ts"), blooms: Mapping[str, int] | None = None,
                    partition: str = DAY, files_per_day: int | None = None, group_bytes: int | None = None) -> None:
    """Overwrites the partitions ``df`` holds, rows ranged and sorted by
    ``cluster`` over the files of a day, so that the least and greatest values
    of a file's row groups are close together and a range scan skips the others.
    ``blooms`` (column -> about how many distinct values a row group has) adds
    Bloom filters, by which look-ups of single ids skip row groups that the
    values of the range cannot rule out. One exchange, by range."""
    order = [F.col(partition), *[F.col(c) for c in cluster]]
    ranged = df.repartitionByRange(files_per_day, *order) if files_per_day else df.repartitionByRange(*order)
    out = ranged.sortWithinPartitions(*order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if group_bytes:
        out = out.option("parquet.block.size", group_bytes)
    for column, values in (blooms or {}).items():
        out = out.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", values)
    out.partitionBy(partition).parquet(path)
