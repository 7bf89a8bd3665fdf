"""What one task is given does not grow with the table."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from quotewell.session import TASK_SIZES, sized


@pytest.fixture
def plain(spark):
    names = [*TASK_SIZES, "spark.sql.shuffle.partitions"]
    before = {k: spark.conf.get(k, None) for k in names}
    for k in TASK_SIZES:
        spark.conf.unset(k)
    yield spark
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_partitions_follow_the_bytes_not_a_fixed_number(plain, tmp_path):
    plain.conf.set("spark.sql.shuffle.partitions", "2")
    lines = plain.range(400).select((F.col("id") * 8).alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(2.0).alias("l_quantity"), F.lit(1.0).alias("l_extendedprice"), F.lit(0.5).alias("l_discount"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    assert queries()["trade_money"](plain, str(tmp_path)).count() == 400
    rows = plain.range(400_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    dealt = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("part", F.spark_partition_id())
    assert dealt.select("part").distinct().count() > 2


def test_values_of_the_cluster_stay(plain):
    plain.conf.set("spark.sql.files.maxPartitionBytes", "3m")
    sized(plain)
    assert plain.conf.get("spark.sql.files.maxPartitionBytes") == "3m"
    assert plain.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"


def test_the_sh_file_is_made_once_for_all_rules(plain, tmp_path):
    at = F.lit("2020-01-02 00:00:00").cast("timestamp_ntz")
    orders = plain.range(8).select(
        F.col("id").alias("o_orderkey"), F.lit(3).cast("bigint").alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        (F.col("id") * 100.0).alias("o_totalprice"), at.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"))
    lines = plain.range(8).select(
        F.col("id").alias("l_orderkey"), F.lit(3).cast("bigint").alias("l_partkey"), F.lit(1).cast("bigint").alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.lit(9.0).alias("l_quantity"), F.lit(70.0).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"),
        F.lit("A").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), at.alias("l_shipdate"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    report = queries()["rule_report_sh"](plain, str(tmp_path))
    assert "o_orderkey" not in report._jdf.queryExecution().optimizedPlan().toString()  # nine times before
    assert {r.rule: r.n for r in report.collect()}["rows:snap"] == 8


def test_many_folders_are_listed_by_few_tasks(plain, tmp_path):
    path = str(tmp_path / "by")
    plain.range(0, 150, 1, 1).withColumn("securityid", F.col("id")).write.partitionBy("securityid").parquet(path)
    context = plain.sparkContext
    context.setJobGroup("listing", "")
    sized(plain).read.schema("id long, securityid long").parquet(path).inputFiles()
    seen = context.statusTracker()
    stages = [s for j in seen.getJobIdsForGroup("listing") for s in seen.getJobInfo(j).stageIds]
    context.setLocalProperty("spark.jobGroup.id", None)
    assert max(seen.getStageInfo(s).numTasks for s in stages) == 100  # a task a folder before
