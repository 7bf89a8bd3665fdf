import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.llm.mixing import mix, mixing_stage, repetition_rates

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()), *(T.StructField(n, T.StringType()) for n in ("copy", "doc", "key", "rate", "mix_source", "cdf"))])


def table(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 6) for r in rows], SCHEMA).repartition(3)


def copies(rate, doc_id, text, seed=0):
    """Inverts the distribution term by term."""
    key = hashlib.md5(f"{seed}:{'' if doc_id is None else doc_id}:{text or ''}".encode()).hexdigest()
    u, k = int(key[:13], 16) / 2**52, 0
    term = total = math.exp(-rate)
    while total <= u and k < 1000:
        k += 1
        term *= rate / k
        total += term
    return k


ROWS = [(i, "word " * (1 + i % 7), f"s{i % 4 if i % 3 else 0}") for i in range(120)] + [(None, "no id", "s1"), (7, None, "s2"), (8, "", None), (9, "null source", None), (5, "twice", "s3"), (5, "twice", "s3"), (3, "", "blank")]


def test_against_plain(spark):
    df = table(spark, ROWS)
    chars = Counter()
    for _, text, source in ROWS:
        chars[source] += len(text or "")
    share = sum(chars.values()) / sum(v > 0 for v in chars.values())
    want = Counter()
    for doc_id, text, source in ROWS:
        n = copies(share / chars[source] if chars[source] else 1.0, doc_id, text)
        want.update((doc_id, text, source, c) for c in range(1, n + 1))
    got = Counter((r.doc.doc_id, r.doc.text, r.doc.source, r["copy"]) for r in mix(df).collect())
    assert got == want
    out = mixing_stage(df)
    assert out.schema.fieldNames() == df.schema.fieldNames() and out.count() == sum(want.values())


def test_rates_reach_the_weights(spark):
    df = table(spark, [(i, "x" * 100, "big" if i % 10 else "small") for i in range(4000)])
    weights = {"big": 1.0, "small": 3.0, "absent": 5.0}
    rates = {r.mix_source: r.rate for r in repetition_rates(df, {"big": 1.0, "small": 3.0}, 200_000.0).collect()}
    assert rates == {"big": 200_000 / 4 / 360_000, "small": 200_000 * 0.75 / 40_000}
    n = {r.s: r.n for r in mix(df, weights, 450_000.0).groupBy(F.col("doc.source").alias("s")).agg(F.count("*").alias("n")).collect()}
    total = 450_000 / 100 / 4  # the weight of a source without documents goes to none
    assert n["big"] == pytest.approx(total, rel=0.15) and n["small"] == pytest.approx(3 * total, rel=0.15)
    assert mix(df, {"small": 1.0}).where("doc.source = 'big'").count() == 0


def test_large_rates(spark):
    df = table(spark, [(i, "x", "tiny") for i in range(20)])
    n = [r.n_copies for r in mix(df, None, 20 * 3000.0).select("doc.doc_id", "n_copies").distinct().collect()]
    assert len(n) == 20 and all(abs(x - 3000) < 6 * math.sqrt(3000) for x in n)


def test_reruns_and_order(spark):
    df = table(spark, ROWS)
    again = mix(df.repartition(7))
    assert sorted(r.shuffle_key for r in mix(df).collect()) == sorted(r.shuffle_key for r in again.collect())
    for part in again.select("shuffle_key").rdd.glom().collect():
        assert [r.shuffle_key for r in part] == sorted(r.shuffle_key for r in part)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mix(empty).count() == 0 and mixing_stage(empty).columns == SCHEMA.fieldNames()
