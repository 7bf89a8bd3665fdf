"""Queries against their SQL, and the pipeline against a plain version, on the smallest tables."""

import math
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from quotewell.llm.bpe import default_tokenizer
from quotewell.llm.quality import judged
from quotewell.llm.queries import QUERIES, SQL
from tests.llm.test_links import plain as plain_groups
from tests.llm.test_lines import plain as plain_lines
from tests.llm.test_mixing import copies

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = con.execute(SQL[name]).df()
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert sorted(got) == sorted(want)
    by = sorted(want)
    a, b = (x[by].astype(str).sort_values(by).reset_index(drop=True) for x in (got, want))
    assert a.equals(b)


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_pipeline_against_plain(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    # The first stage has its own test against a plain model; here its judgement is taken.
    kept = {r.ident for r in judged(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).where("keep").collect()}
    rows = [r for r in docs.orderBy("doc_id").collect() if r.doc_id in kept]
    texts = [t for _, _, t in plain_lines([r.text for r in rows], 10)]
    _, group = plain_groups(texts)
    rows = [(r, t) for i, (r, t) in enumerate(zip(rows, texts, strict=True)) if group[i] == i]
    chars = Counter()
    for r, t in rows:
        chars[r.source] += len(t)
    share = sum(chars.values()) / sum(v > 0 for v in chars.values())
    library = Tokenizer.from_file(default_tokenizer())
    want = Counter()
    for r, t in rows:
        n = copies(share / chars[r.source] if chars[r.source] else 1.0, r.doc_id, t)
        if n:
            want[r.doc_id, t, r.source, tuple(library.encode(t, add_special_tokens=False).ids)] += n
    out = corpus_pipeline.run(spark, FOLDER)
    got = Counter((r.doc_id, r.text, r.source, tuple(r.token_ids)) for r in out.collect())
    assert got == want
    assert out.where(~F.col("round_trip")).count() == 0 and math.isfinite(share)


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "BPE encoding and decoding"]
