"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime re-planning does the join work here: joins carry no hints, so Spark
# broadcasts a side only when its measured size is under
# spark.sql.autoBroadcastJoinThreshold and otherwise runs a sort-merge join
# whose oversized partitions AQE splits. "force" lets it split even where the
# split costs one more exchange.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods above 8,000 bytecodes. Wide publish rows
    # produce larger ones when fused into one stage; below this limit Spark
    # generates each operator on its own instead and the JVM compiles them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# What one task sorts or aggregates follows the bytes it is given, so shuffles
# begin with many partitions, of which Spark joins small ones up to a size, and
# files are read in small pieces. A task then holds as much of a large table as
# of a small one. Values the cluster names itself stay.
TASK_SIZES = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "16m",
    # Folders are listed by at most so many tasks, not by one each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "100",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


def sized(spark: SparkSession) -> SparkSession:
    """The session with tasks of bounded size."""
    for key, value in TASK_SIZES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


_OWN: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir where the cluster
    names one. Where it is unset, local masters (tests) get one temp folder for
    each application, which goes when Python ends."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    application = spark.sparkContext.applicationId
    if application not in _OWN:
        _OWN[application] = tempfile.TemporaryDirectory(prefix="quotewell-")
    return _OWN[application].name


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared one."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
