"""Loads arrived files by a manifest instead of a stream's checkpoint.

A load first writes down which files it takes under which run id, then loads
them into partitions of that run, then notes the run as done. Whatever is lost
in between, the next load finishes the noted runs with the files they name,
overwriting their own partitions, before it takes new files. So a file counts
once, and no file is left out, however often a load is cut off; nothing but the
tables and the manifest has to survive.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.sources.readers import feed_of_file, normalize
from quotewell.sources.schemas import FEEDS
from quotewell.sources.sinks import DAY, read_if_exists

MAX_FILES = 1000
_FILES = "path string, length long, modified long, feed string, run_id string"


def arrived(spark: SparkSession, root: str, days: Sequence[str], fmt: str = "new") -> DataFrame:
    """path, length, modified, feed of the files of these day folders; feed is
    null for names of no feed. Spark lists the folders; no file is opened."""
    listed = spark.read.format("binaryFile").load([f"{root}/{day}/*" for day in days])
    return listed.select("path", "length", F.unix_millis("modificationTime").alias("modified"), feed_of_file(F.col("path"), fmt).alias("feed"))


def taken(spark: SparkSession, manifest: str) -> DataFrame:
    """Every file some run took: path, length, modified, feed, run_id."""
    files = read_if_exists(spark, f"{manifest}/files")
    return spark.createDataFrame([], _FILES) if files is None else files


def done(spark: SparkSession, manifest: str) -> DataFrame:
    """run_id of every run whose rows are complete."""
    runs = read_if_exists(spark, f"{manifest}/done")
    return spark.createDataFrame([], "run_id string") if runs is None else runs


def _note(df: DataFrame, path: str) -> None:
    """One file, which is there whole or not at all."""
    df.coalesce(1).write.mode("append").parquet(path)


def begin(files: DataFrame, manifest: str, max_files: int = MAX_FILES) -> str | None:
    """Notes the next files (path, length, modified, feed), in order of their
    paths, as one run. None if no file is new. A file counts as taken by its
    path: files do not change once their day is ready (see ``changed``)."""
    spark = files.sparkSession
    fresh = files.join(taken(spark, manifest).select("path"), "path", "left_anti").orderBy("path").limit(max_files)
    rows = fresh.select("path", "length", "modified", "feed").collect()  # max_files at most
    if not rows:
        return None
    run = uuid.uuid4().hex
    _note(spark.createDataFrame([(*r, run) for r in rows], _FILES), f"{manifest}/files")
    return run


def load(spark: SparkSession, run: str, manifest: str, target: str, fmt: str = "new", sep: str = "\t") -> None:
    """The files of a run into its own sub-partitions; a repeated load leaves the same rows."""
    files = taken(spark, manifest).where(F.col("run_id") == run).select("path", "feed").collect()  # MAX_FILES at most
    feed = files[0].feed
    raw = spark.read.csv([f.path for f in files], schema=FEEDS[fmt][feed], sep=sep)
    rows = normalize(raw, feed, fmt).withColumn("run_id", F.lit(run)).hint("rebalance", F.col(DAY))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, "run_id").parquet(target)


def finish(spark: SparkSession, run: str, manifest: str) -> None:
    _note(spark.createDataFrame([(run,)], "run_id string"), f"{manifest}/done")


def load_arrivals(spark: SparkSession, root: str, days: Sequence[str], targets: Mapping[str, str], manifest: str, fmt: str = "new",
                  sep: str = "\t", max_files: int = MAX_FILES) -> list[str]:
    """Loads every file of the day folders that no run has taken, each feed into
    its table, after finishing the runs that were cut off. Each file is read by
    its own feed alone, since names are looked at before files are opened.
    Returns the runs finished here."""
    runs = []

    def complete(run: str, feed: str) -> None:
        load(spark, run, manifest, targets[feed], fmt, sep)
        finish(spark, run, manifest)
        runs.append(run)

    open_runs = taken(spark, manifest).select("run_id", "feed").distinct().join(done(spark, manifest), "run_id", "left_anti")
    for r in open_runs.collect():  # one a load that was cut off
        complete(r.run_id, r.feed)
    listed = arrived(spark, root, days, fmt) if days else None
    for feed in targets if days else ():
        while run := begin(listed.where(F.col("feed") == feed), manifest, max_files):
            complete(run, feed)
    return runs


def changed(files: DataFrame, manifest: str) -> DataFrame:
    """Files (path, length, modified, feed) that are not what they were when they were taken. They are not loaded again."""
    was = taken(files.sparkSession, manifest).select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    return files.join(was, "path").where((F.col("length") != F.col("_length")) | (F.col("modified") != F.col("_modified"))).select(*files.columns)


def loaded(spark: SparkSession, target: str, manifest: str) -> DataFrame:
    """The rows of finished runs: a run being loaded is not seen."""
    return spark.read.parquet(target).join(done(spark, manifest).distinct(), "run_id", "left_semi")
