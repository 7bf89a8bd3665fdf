"""Helpers the operators share: scratch tables, row keys, rows as one struct."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import quotewell
from quotewell.session import scratch_dir

# Rows are passed to Python in batches of at most so many rows and bytes; a batch
# must fit into a worker next to its arrays. A row larger than that comes alone.
BATCH_ROWS, BATCH_BYTES = 256, 16 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_SHIPPED: set[str] = set()


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Readies the session for functions that run in Python workers: bounded batches, and this package on every executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        top = os.path.dirname(os.path.dirname(os.path.abspath(quotewell.__file__)))
        package = os.path.join(tempfile.mkdtemp(prefix="quotewell-code-"), "quotewell.zip")
        with zipfile.ZipFile(package, "w") as out:
            for path in Path(top, "quotewell").rglob("*.py"):
                out.write(path, path.relative_to(top))
        context.addPyFile(package)
        _SHIPPED.add(context.applicationId)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes df below the shared folder and reads it back: later plans start at
    the files, whatever becomes of the executors that made them."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame) -> Column:
    """The whole row as one struct named doc, so that no helper column can clash with the table's own."""
    return F.struct(*[col(c) for c in docs.columns]).alias("doc")


def unpacked(df: DataFrame, docs: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of docs again, some of them replaced."""
    return df.select(*[(replaced[c] if c in replaced else F.col("doc").getField(c)).alias(c) for c in docs.columns])


def key_pair(*parts: Column) -> list[Column]:
    """128 bits of hash over the given columns, as two longs k1 and k2."""
    return [F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit("second"), *parts).alias("k2")]
