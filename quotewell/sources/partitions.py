"""Day-partition upkeep of catalog tables, and range runs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.functions.times import as_date
from quotewell.sources.readers import normalize, read_raw
from quotewell.sources.sinks import DAY, replace_partition


def list_days(spark: SparkSession, table: str, lo=None, hi=None, partition: str = DAY) -> DataFrame:
    """Days a partitioned catalog table holds, from its partition list."""
    spec = F.regexp_extract("partition", partition + r"=([^/]+)", 1)
    days = spark.sql(f"SHOW PARTITIONS {table}").select(F.try_to_date(spec).alias(partition))
    if lo is not None:
        days = days.where(F.col(partition) >= as_date(lo))
    if hi is not None:
        days = days.where(F.col(partition) <= as_date(hi))
    return days.orderBy(partition)


def _day_list(spark: SparkSession, table: str, lo, hi, partition: str) -> list[date]:
    # one value per calendar day of the range
    return [r[0] for r in list_days(spark, table, lo, hi, partition).collect()]


def refresh_partitions(spark: SparkSession, tables: Sequence[str], lo=None, hi=None,
                       partition: str = DAY) -> None:
    """Drops the listed days from the partition list and adds them again from
    what the folders hold now. Files are untouched (external tables)."""
    for table in tables:
        for day in _day_list(spark, table, lo, hi, partition):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition}=DATE'{day}')")
        spark.sql(f"MSCK REPAIR TABLE {table} ADD PARTITIONS")
        spark.catalog.refreshTable(table)


def purge_partitions(spark: SparkSession, tables: Sequence[str], lo, hi, confirm: bool = False,
                     partition: str = DAY) -> list[str]:
    """Removes the days' rows and partitions of managed tables. Without
    ``confirm`` only says what would go."""
    gone = []
    for table in tables:
        for day in _day_list(spark, table, lo, hi, partition):
            gone.append(f"{table}/{day}")
            if confirm:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition}=DATE'{day}') PURGE")
    return gone


def stage_day(spark: SparkSession, raw_path: str, target: str, feed: str, fmt: str = "new",
              prepare_only: bool = False, sep: str = "\t") -> DataFrame:
    """A raw day file into its day partition of the feed table. With
    ``prepare_only`` the rows are returned but not written."""
    df = normalize(read_raw(spark, raw_path, feed, fmt, sep), feed, fmt)
    if not prepare_only:
        replace_partition(df, target, DAY, ["securityid", "ts"])
    return df


def run_range(job: Callable[[DataFrame], DataFrame], df: DataFrame, lo, hi,
              partition: str = DAY) -> DataFrame:
    """A job over all days of a range at once; absent days simply have no rows."""
    return job(df.where(F.col(partition).between(as_date(lo), as_date(hi))))


def calendar_days(spark: SparkSession, lo, hi) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(as_date(lo), as_date(hi))).alias(DAY))


def analyze(spark: SparkSession, table: str) -> None:
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
