"""File-arrival ingest: days whose marker has arrived are loaded once, into the
day partitions of the feed tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.sources.files import matching_paths
from quotewell.sources.readers import feed_of_file, normalize
from quotewell.sources.schemas import FEEDS

# What is in the names of a feed's files, so that each feed reads
# no others (a name may still turn out to be of another feed; the route decides).
NAMES = {
    "new": {"snap": ["snap_spot"], "snap_level": ["snap_level"], "index": ["index"], "order": ["order"], "trade": ["trade"]},
    "old": {"snap": ["snap_spot", "snapshot"], "snap_level": ["snap_level", "snapshotdw"], "index": ["index"], "order": ["order"], "trade": ["trade"]},
}


def name_pattern(feed: str, fmt: str) -> str:
    """A glob for the file names of a feed; the old format spells them in any letter case."""
    def spelled(word: str) -> str:
        return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) if fmt == "old" else word

    words = [f"*{spelled(w)}*" for w in NAMES[fmt][feed]]
    return words[0] if len(words) == 1 else "{" + ",".join(words) + "}"


def ready_days(spark: SparkSession, root: str, marker: str = "ok") -> list[str]:
    """Day folders below ``root`` that hold the (usually empty) marker file. One
    entry per day."""
    found = matching_paths(spark, f"{root}/*/{marker}")
    return sorted({path.rstrip("/").split("/")[-2] for path in found})


def ingest_available(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    checkpoint: str,
    write_batch: Callable[[DataFrame, int], None],
    source: str = "csv",
    options: Mapping[str, str] | None = None,
    max_files: int = 1000,
) -> None:
    """Loads every file not seen before, in batches of at most ``max_files``
    files, and stops. The checkpoint remembers what was loaded."""
    stream = (
        spark.readStream.format(source).schema(schema).options(**(options or {}))
        .option("maxFilesPerTrigger", max_files).load(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def refused_files(spark: SparkSession, root: str, days: Sequence[str], fmt: str = "new", marker: str = "ok") -> DataFrame:
    """The files of these days that belong to no feed: path. One row per file;
    names that Spark itself passes over (_SUCCESS and the like) do not count."""
    paths = [p for day in days for p in matching_paths(spark, f"{root}/{day}/*") if not fnmatch(p.rsplit("/", 1)[-1], marker) and p.rsplit("/", 1)[-1][0] not in "_."]
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    return listed.where(feed_of_file(F.col("path"), fmt).isNull())


def append_by_batch(target: str, partition: str = "trade_date") -> Callable[[DataFrame, int], None]:
    """A batch writer that is safe to repeat: each batch owns one sub-partition
    (day, batch id) and overwrites it, so a replayed batch adds nothing twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id)).hint("rebalance", F.col(partition))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition, "batch_id").parquet(target)
        )

    return write


def ingest_feeds(spark: SparkSession, root: str, targets: Mapping[str, str], checkpoint: str,
                 fmt: str = "new", marker: str = "ok", sep: str = "\t",
                 feeds: Sequence[str] | None = None) -> list[str]:
    """Routes the files of all ready days by name into the feed tables. Returns
    the days looked at; days without a marker wait for a later run."""
    days = ready_days(spark, root, marker)
    if not days:
        return days
    for feed in feeds or FEEDS[fmt]:
        store = append_by_batch(targets[feed])

        def route(batch: DataFrame, batch_id: int, feed=feed, store=store) -> None:
            mine = batch.where(feed_of_file(F.col("source_file"), fmt) == feed)
            store(normalize(mine, feed, fmt), batch_id)

        ingest_available(
            spark, f"{root}/{{{','.join(days)}}}/*", FEEDS[fmt][feed], f"{checkpoint}/{feed}", route,
            options={"sep": sep, "pathGlobFilter": name_pattern(feed, fmt)},
        )
    return days
