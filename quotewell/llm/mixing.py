"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotewell.llm.common import packed, read, saved, unpacked

_BITS = 13 * 4  # hex digits of the hash that make the uniform number


def repetition_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, target_chars: float | None = None, source: str = "source", text: str = "text") -> DataFrame:
    """Per source: chars, rate (mean number of copies of each of its documents).

    rate = target_chars * weight share / chars of the source, so that the
    expected characters of a source are its share of the target. Without
    `weights` every source with any text weighs the same; with them a source
    not named weighs 0. Without `target_chars` the target is the table's size. A source
    without any characters has rate 1 if it may take part.
    """
    sizes = docs.groupBy(F.col(f"`{source}`").alias("mix_source")).agg(F.sum(F.coalesce(F.length(f"`{text}`"), F.lit(0)).cast("long")).alias("chars"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.when(F.col("chars") > 0, 1.0).otherwise(0.0))
    else:
        named = docs.sparkSession.createDataFrame(list(weights.items()) or [("", 0.0)], "named string, weight double")
        weighed = sizes.join(named, F.col("mix_source") == F.col("named"), "left").drop("named").fillna(0.0, ["weight"])
    weighed = saved(weighed, "source-sizes")
    total = weighed.agg(F.sum("chars"), F.sum("weight")).first()
    target = float(total[0] or 0) if target_chars is None else float(target_chars)
    all_weights = float(total[1] or 0) or 1.0
    rate = F.lit(target) * F.col("weight") / F.lit(all_weights) / F.col("chars")
    empty = F.lit(1.0) if weights is None else F.when(F.col("weight") > 0, 1.0).otherwise(0.0)
    return weighed.select("mix_source", "chars", F.when(F.col("chars") > 0, rate).otherwise(empty).alias("rate"))


def _poisson_table(rates: DataFrame) -> DataFrame:
    """Per source: low and cdf, the distribution function from the count `low` on.

    Covers the mean +- 12 deviations and 40 more counts, beyond which a 52-bit
    uniform number cannot fall. Log weights add up from `low` and are scaled by
    their own sum, so no rate is too large for doubles. The window holds
    24 * sqrt(rate) rows of a source, less than the copies one document gets.
    """
    spread = F.ceil(12 * F.sqrt("rate") + 40)
    low = F.greatest(F.lit(0).cast("long"), F.floor(F.col("rate")) - spread)
    by = W.partitionBy("mix_source")
    so_far = by.orderBy("k").rowsBetween(W.unboundedPreceding, W.currentRow)
    step = F.when(F.col("k") > F.col("low"), F.ln(F.col("rate") / F.col("k"))).otherwise(0.0)
    counts = (
        rates.where(F.col("rate") > 0).withColumn("low", low)
        .withColumn("k", F.explode(F.sequence("low", F.floor(F.col("rate")) + spread)))
        .withColumn("log_weight", F.sum(step).over(so_far))
        .withColumn("weight", F.exp(F.col("log_weight") - F.max("log_weight").over(by)))
        .withColumn("cdf", F.sum("weight").over(so_far) / F.sum("weight").over(by))
    )
    return counts.groupBy("mix_source").agg(
        F.min("low").alias("low"),
        F.transform(F.sort_array(F.collect_list(F.struct("k", "cdf"))), lambda x: x["cdf"]).alias("cdf"),
    )


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, target_chars: float | None = None, seed: int = 0, source: str = "source", text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Repeats every document Poisson(rate of its source) times, in a global random order.

    Returns doc (the whole row), copy (from 1), n_copies, shuffle_key; the rows
    of a partition are sorted by shuffle_key, which also deals them to
    partitions. The count inverts the Poisson distribution at a uniform number
    hashed from seed, id and text: a rerun gives the same copies, wherever tasks
    run. Rows that repeat in full get equal counts; null ids, texts and sources
    take part, a null source is a source of its own. A count of 0 leaves the
    document out, which is what sampling to a weight means. An empty table gives
    an empty result.

    Source sizes are summed with map-side combine. Their table is written out,
    so its join with the documents is planned by its real size: broadcast when
    small, else a sort-merge join that splits hot sources. Text is shuffled
    once, by the shuffle key, which spreads a source of any size evenly.
    """
    table = saved(_poisson_table(repetition_rates(docs, weights, target_chars, source, text)), "poisson")
    key = F.md5(F.concat(
        F.lit(f"{seed}:"), F.coalesce(F.col(f"`{ident}`").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(f"`{text}`"), F.lit("")),
    ).cast("binary"))
    base = docs.select(packed(docs), F.col(f"`{source}`").alias("own_source"), key.alias("key"))
    uniform = F.conv(F.substring("key", 1, _BITS // 4), 16, 10).cast("double") / F.lit(float(2**_BITS))
    drawn = base.join(table, F.col("own_source").eqNullSafe(F.col("mix_source"))).withColumn("uniform", uniform)
    drawn = drawn.withColumn("n_copies", F.col("low") + F.size(F.filter("cdf", lambda c: c <= F.col("uniform"))))
    copies = drawn.where(F.col("n_copies") > 0).select("doc", "key", "n_copies", F.explode(F.sequence(F.lit(1).cast("long"), "n_copies")).alias("copy"))
    copies = copies.select("doc", "copy", "n_copies", F.md5(F.concat("key", F.lit(":"), F.col("copy").cast("string")).cast("binary")).alias("shuffle_key"))
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def mixing_stage(docs: DataFrame) -> DataFrame:
    """The columns of docs, each document as often as its source's rate asks for."""
    return unpacked(mix(docs), docs)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return mix(docs).select(*[F.col("doc").getField(c).alias(c) for c in docs.columns], "copy", "n_copies", "shuffle_key")


OP3_SQL = """
WITH sizes AS (SELECT source, sum(length(coalesce(text, ''))) AS chars FROM documents GROUP BY source),
rates AS (
    SELECT source, CASE WHEN chars > 0 THEN
        (SELECT sum(chars) FROM sizes)::DOUBLE / (SELECT count(*) FROM sizes WHERE chars > 0) / chars ELSE 1.0 END AS rate
    FROM sizes
), counts AS (
    SELECT source, rate, unnest(range(0, (rate + 12 * sqrt(rate) + 60)::BIGINT)) AS k FROM rates
), cdfs AS (
    SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf FROM counts
), tables AS (SELECT source, list(cdf ORDER BY k) AS cdf FROM cdfs GROUP BY source),
keyed AS (SELECT *, md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS doc_key FROM documents),
drawn AS (
    SELECT d.*, len(list_filter(t.cdf, lambda c: c <= ('0x' || substr(doc_key, 1, 13))::BIGINT / 4503599627370496.0)) AS n_copies
    FROM keyed d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, text, lang, source, n_chars, copy, n_copies, md5(doc_key || ':' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM drawn WHERE n_copies > 0)
"""
