from collections import Counter

from pyspark.sql import types as T

from quotewell.llm.lines import line_dedup, line_dedup_stage

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *(T.StructField(n, T.StringType()) for n in ("doc", "body", "key", "pos", "h1", "k1", "kept"))])
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(texts, min_docs, min_chars=1):
    key = lambda line: line.translate(UP).strip(" \t\n\x0b\x0c\r")
    rows = [(t or "").split("\n") for t in texts]
    seen = Counter(k for lines in rows for k in {key(x) for x in lines})
    out = []
    for lines in rows:
        kept = [x for x in lines if not (len(key(x)) >= min_chars and seen[key(x)] >= min_docs)]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def table(spark, texts):
    rows = [(i if i != 2 else None, t, *["x"] * 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


TEXTS = [
    "Common line\nown a\n\n", " common LINE\r\nown b", "COMMON line\t\ncommon line\nx", None, "", "\n\n", "É\né\nown c", "é \nÉ", "É", "a" * 50000 + "\ncommon line\n" + "b\n" * 3000,
    "own a\x1c\nown a", "last line without end",
]


def results(df):
    return sorted((r.n_lines, r.n_dropped, r.kept) for r in df.collect())


def test_against_plain(spark):
    for min_docs in (1, 2, 3, 4, 99):
        assert results(line_dedup(table(spark, TEXTS), min_docs)) == sorted(plain(TEXTS, min_docs)), min_docs
    assert results(line_dedup(table(spark, TEXTS), 2, min_chars=6)) == sorted(plain(TEXTS, 2, 6))


def numbered(spark, rows):
    return spark.createDataFrame([(i, t, *["x"] * 7) for i, t in rows], SCHEMA).repartition(3)


def test_a_document_counts_once_however_many_rows_it_has(spark):
    same = numbered(spark, [(1, "same\nown")] * 10)
    assert results(line_dedup(same, 10)) == [(2, 0, "same\nown")] * 10
    assert results(line_dedup(numbered(spark, [(i, "same") for i in range(10)]), 10)) == [(1, 1, "")] * 10
    # nine documents, one of them with many rows and texts, and rows without an id, which are documents each
    rows = [(i, "same\nx") for i in range(8)] + [(8, "same"), (8, "SAME\ny"), (8, "z")] * 20
    assert sum(r[1] for r in results(line_dedup(numbered(spark, rows), 10))) == 0
    both = results(line_dedup(numbered(spark, [*rows, (None, " same ")]), 10))
    assert sum(r[1] for r in both) == 8 + 40 + 1 and sum(r[2] == "y" for r in both) == 20
    assert sum(r[1] for r in results(line_dedup(numbered(spark, [(None, "q")] * 10 + rows), 10))) == 10


def test_stage_keeps_columns_and_rows(spark):
    df = table(spark, TEXTS)
    out = line_dedup_stage(df, 3)
    assert out.schema.fieldNames() == df.schema.fieldNames() and out.count() == len(TEXTS)
    assert sorted(r.text for r in out.collect()) == sorted(x[2] for x in plain(TEXTS, 3))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert line_dedup(empty).count() == 0 and line_dedup_stage(empty).columns == SCHEMA.fieldNames()
