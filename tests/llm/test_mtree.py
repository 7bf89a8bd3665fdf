import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from quotewell.llm import mtree
from quotewell.llm.mtree import op2_top_k, top_k

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("vec", T.ArrayType(T.LongType())), *(T.StructField(n, T.StringType()) for n in ("node", "ids", "region", "query_id"))])


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [int(x) for x in v], *["x"] * 4) for i, v in rows], SCHEMA).repartition(3)


def plain(rows, asked, k):
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None})
    out = []
    for q, v in sorted({(i, tuple(v)) for i, v in asked if i is not None and v is not None}):
        scores = sorted((-int(np.dot(v, w)), i) for i, w in rows if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return out


def got(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("unit,page,pivots,queries", [(4096, 128, 256, 4096), (20, 4, 5, 7), (1, 1, 3, 100)])
def test_against_plain(spark, monkeypatch, unit, page, pivots, queries):
    for name, value in (("UNIT", unit), ("PAGE", page), ("PIVOTS", pivots), ("QUERIES", queries)):
        monkeypatch.setattr(mtree, name, value)
    random = np.random.default_rng(unit)
    centres = random.integers(-60, 60, (8, 6))
    x = centres[random.integers(0, 8, 250)] + random.integers(-6, 7, (250, 6))
    x[200:240] = x[3]  # copies: ties to the smaller id
    x[240:245] = 0
    rows = [(int(i) * 3, v) for i, v in enumerate(x.tolist())]
    asked = rows[::4]
    assert got(top_k(table(spark, rows), table(spark, asked), 5)) == plain(rows, asked, 5)


def test_edge_cases(spark):
    rows = [(1, [1, 2]), (2, [2, 1]), (3, None), (None, [5, 5]), (4, [1, 2]), (4, [1, 2]), (5, [-1, 0])]
    assert got(top_k(table(spark, rows), table(spark, rows), 20)) == plain(rows, rows, 20)  # fewer than k others
    assert got(top_k(table(spark, rows), table(spark, []), 3)) == []
    assert got(top_k(table(spark, []), table(spark, rows), 3)) == []
    alone = [(9, [1, 1])]
    assert got(top_k(table(spark, alone), table(spark, alone), 3)) == []


def test_vectors_of_unequal_length(spark):
    """Shorter ones end in zeros; an empty one scores 0 with all."""
    rows = [(1, [1, 2, 3]), (2, [2]), (3, []), (4, [0, 5]), (5, [-1, 0, 0]), (6, [-1]), (7, [])]
    even = [(i, v + [0] * (3 - len(v))) for i, v in rows]
    assert got(top_k(table(spark, rows), table(spark, rows), 4)) == plain(even, even, 4)
    assert got(top_k(table(spark, rows[1:3]), table(spark, rows), 4)) == plain(even[1:3], even, 4)
    empty = [(1, []), (2, []), (3, [])]
    assert got(top_k(table(spark, empty), table(spark, empty), 2)) == plain(empty, empty, 2)


def test_query_on_odd_vectors(spark, tmp_path):
    random = np.random.default_rng(8)
    rows = [(i, random.standard_normal(8).astype(np.float32).tolist()) for i in range(100)] + [(100, None), (120, [float("nan")] * 8), (140, [None] * 8), (160, [0.0] * 8), (180, []), (200, [1.5, -2.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    good = [(i, np.floor(64 * np.array([*v, *[0.0] * (8 - len(v))], np.float32).astype(float)).astype(int).tolist()) for i, v in rows if i not in (100, 120, 140)]
    assert got(op2_top_k(spark, str(tmp_path))) == plain(good, [r for r in good if r[0] % 20 == 0], 20)


def test_queries_of_a_block_step_together():
    """Calls follow the pages, not queries times pages; scores beyond doubles stay whole."""
    random = np.random.default_rng(4)
    for scale, spread in ((60, 7), (1 << 30, 1000)):
        x = random.integers(-scale, scale, (4, 6))[random.integers(0, 4, 400)] + random.integers(-spread, spread, (400, 6))
        x = np.unique(x, axis=0)
        ceiling = float((x.astype(float) ** 2).sum(axis=1).max())
        m = mtree._metric(x, ceiling)
        page = mtree._paged(m, 8)
        parts = [np.flatnonzero(page == p) for p in np.unique(page)]
        own = [np.sqrt(((m[at] - m[at[0]]) ** 2).sum(axis=1)) for at in parts]
        tree = pa.table({
            "parent": [m[0].tolist() for _ in parts], "pivot": [m[at[0]].tolist() for at in parts], "radius": [float(d.max()) for d in own],
            "to_parent": [float(np.sqrt(((m[at[0]] - m[0]) ** 2).sum())) for at in parts], "entries": [x[at].ravel().tolist() for at in parts],
            "own": [d.tolist() for d in own], "ids": [[[int(i)] for i in at] for at in parts],
        })
        asked = pa.table({"query_id": pa.array(range(300), pa.int64()), "vec": x[:300].tolist(), "worst": pa.array([None] * 300, pa.int64())})
        calls = []
        sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
        try:
            out = mtree._search(5)(tree, asked)
        finally:
            sys.setprofile(None)
        rows = [(i, v) for i, v in enumerate(x.tolist())]
        scores = x.astype(object) @ x.astype(object).T
        wanted = {(i, j, int(scores[i, j])) for i in range(300) for j in sorted((j for j in range(len(rows)) if j != i), key=lambda j: (-scores[i, j], j))[:5]}
        assert set(zip(*[out.column(c).to_pylist() for c in ("query_id", "vec_id", "score")], strict=True)) == wanted
        assert len(calls) < 40 * len(parts) ** 2 + 400
