"""Day-partitioned catalog tables bucketed by row key. A bucket of an upsert
meets the same bucket of the touched days, so stored rows are never shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.sources.sinks import DAY, as_stored, days_of, on_days, one_per_key, written


def bucket_count(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").collect()
    if not rows:
        raise ValueError(f"{table} is not bucketed")
    return int(rows[0]["data_type"])


def create_bucketed(df: DataFrame, table: str, buckets: int, key: str = "row_key", partition: str = DAY,
                    path: str | None = None, order: Sequence[Column] = ()) -> None:
    """A new table, one file for each day and bucket. Of rows with one key the
    first in ``order`` stays. The key determines the day, as row keys do."""
    rows = one_per_key(df.repartition(buckets, key), [key], order)
    columns = [c for c in df.columns if c != partition] + [partition]
    writer = rows.select(*columns).write.partitionBy(partition).bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def merged(df: DataFrame, table: str, key: str = "row_key", partition: str = DAY, order: Sequence[Column] = (),
           days: Sequence | None = None, keep_absent: bool = False) -> DataFrame:
    """The touched days as an upsert leaves them: new rows where there is one,
    stored ones elsewhere. One join by bucket; the new side is dealt into the
    table's buckets, the stored side stays where it is."""
    spark = df.sparkSession
    stored = spark.table(table)
    buckets = bucket_count(spark, table)
    fresh = as_stored(df, stored).select(*[c for c in stored.columns if c in df.columns])
    if days is None:
        fresh = written(fresh, "upsert")
        days = days_of(fresh, partition)
    new = one_per_key(fresh.repartition(buckets, key), [key], order)
    old = on_days(stored, days, partition)
    met = new.select(F.struct("*").alias("_new"), F.col(key).alias("_k")).join(
        old.select(F.struct("*").alias("_old"), F.col(key).alias("_ok")), F.col("_k") == F.col("_ok"), "full"
    )
    isnew = F.col("_k").isNotNull()

    def cell(c: str) -> Column:
        was = F.col("_old").getField(c)
        if c not in fresh.columns:
            return was
        value = F.col("_new").getField(c)
        return F.when(isnew, F.coalesce(value, was) if keep_absent else value).otherwise(was)

    return met.select(*[cell(c).alias(c) for c in stored.columns])


def upsert_bucketed(df: DataFrame, table: str, key: str = "row_key", partition: str = DAY, order: Sequence[Column] = (),
                    days: Sequence | None = None, keep_absent: bool = False) -> None:
    """Rows of ``df`` replace stored rows with the same key. Only the partitions
    of the touched days are read and written; writing the same rows again
    changes nothing. Rows without a key are refused."""
    if not df.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"rows without {key}")
    spark = df.sparkSession
    rows = merged(df, table, key, partition, order, days, keep_absent)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    spark.catalog.refreshTable(table)
