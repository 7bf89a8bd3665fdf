"""Every registered query, and the pipeline, on empty and on odd tables."""

import pytest
from pyspark.sql import types as T

import corpus_pipeline
from quotewell.llm.queries import QUERIES

CLASHING = ["doc", "body", "key", "k1", "node", "keep", "copy", "n", "ident", "root", "file", "kept", "window", "vec", "region"]
EXTRA = [T.StructField(c, T.StringType()) for c in CLASHING]
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *EXTRA,
])
EMBEDDINGS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), *EXTRA])
LABELS = "doc_id long, quality int, toxic int"

PROSE = "a line of ordinary words that says little\nand one more such line of words\n"
ROWS = [
    (1, PROSE, "en", "s", 5), (1, PROSE, "en", "s", 5), (2, None, None, None, None), (3, "", "en", "s", 0), (None, PROSE, "en", None, 1), (None, None, None, None, None),
    (4, " \n\t\n", "de", "t", 3), (5, "word " * 60000, "en", "s", 9), (6, "x" * 200000, "en", "s", 9), (7, "日本語 🙂 \x00 \x1c", "ja", "t", 2),
    (8, "Released under the MIT License.", "en", "t", 1), (9, "<|endoftext|>", "en", "t", 1), *((10 + i, PROSE, "en", "u", 1) for i in range(12)),
]
VECTORS = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (20, None, None), (40, [0.0, 0.0], 1), (None, [1.0, 2.0], 1), (60, [float("nan"), 1.0], 1), (80, [None, 1.0], 1), (3, [2.0, 1.0], 1), (4, [1.0, 2.0], 1)]


def folder(spark, path, documents, vectors, labels):
    pad = ("x",) * len(EXTRA)
    spark.createDataFrame([(*r, *pad) for r in documents], DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(*r, *pad) for r in vectors], EMBEDDINGS).write.parquet(f"{path}/embeddings.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    items = [(i, PROSE, *pad) for i in range(3)] + [(None, None, *pad), (4, "", *pad)] if documents else []
    spark.createDataFrame(items, T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), *EXTRA])).write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("empty"), [], [], [])


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("odd"), ROWS, VECTORS, [(1, 1, 0), (10, 1, None), (None, 1, 0), (4, 0, 0), (5, None, None)])


@pytest.mark.parametrize("name", [*sorted(QUERIES), "pipeline"])
def test_empty_tables(spark, empty, name):
    query = QUERIES.get(name, corpus_pipeline.run)
    assert query(spark, empty).count() == 0


PER_ROW = ["op1_quality", "op4_bpe", "op5_ngram_jaccard", "op8_line_dedup", "op9_language_id", "op10_token_counts", "op11_merkle_manifest", "op13_decontaminate"]


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_document(spark, odd, name):
    found = [r.doc_id for r in QUERIES[name](spark, odd).select("doc_id").collect()]
    assert sorted(map(str, found)) == sorted(str(r[0]) for r in ROWS)


def test_rows_of_the_others(spark, odd):
    assert {r.doc_id for r in QUERIES["op6_license_scan"](spark, odd).collect()} == {8}
    assert sorted(str(r.vec_id) for r in QUERIES["op7_embedding_near_dedup"](spark, odd).collect()) == sorted(str(v[0]) for v in VECTORS)
    assert {r.query_id for r in QUERIES["op2_top_k"](spark, odd).collect()} == {0, 40}
    assert sorted(str(r.vec_id) for r in QUERIES["op12_whitening"](spark, odd).where("component = 1").collect()) == ["0", "0", "3", "4", "40", "None"]
    assert {r.doc_id for r in QUERIES["op13_decontaminate"](spark, odd).where("contaminated").collect()} == {1, None, *range(10, 22)}
    assert set(QUERIES["op3_mixing"](spark, odd).columns) >= {"doc_id", "text", "n_copies"}


def test_stages_keep_the_columns(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, odd).columns == docs.columns, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, odd)
    assert set(docs.columns) <= set(last.columns) and last.count() == len(ROWS)
