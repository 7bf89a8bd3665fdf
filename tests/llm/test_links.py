import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.llm import jaccard, links
from quotewell.llm.itq import plan_tables, tables_for, vector_links
from quotewell.llm.jaccard import jaccard_links, jaccard_stage
from quotewell.llm.links import components


def groups(n, pairs):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)], [(i, (i * 7) % 60) for i in range(60)], [(5, 5), (9, 3)]])
def test_components(spark, edges):
    df = spark.createDataFrame([(a, b) for a, b in edges], "node long, root long")
    want = groups(100, edges)
    assert {r.node: r.root for r in components(df).collect()} == {i: want[i] for e in edges for i in e if e[0] != e[1]}


TEXT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *(T.StructField(n, T.StringType()) for n in ("node", "root", "sketch", "k1", "single", "n"))])


def plain(texts, threshold=0.8):
    """n_links and group of each text, all pairs compared."""
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        n = min(5, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set())
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9]
    n = defaultdict(int)
    for i, j in pairs:
        n[i] += 1
        n[j] += 1
    return [n[i] for i in range(len(sets))], groups(len(sets), pairs)


def corpus(seed=1, families=12, size=9, words=80, edits=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(2000)]
    shared = [rng.choice(vocabulary) for _ in range(15)]
    out = []
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(words)] + shared
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(edits)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            out.append(" ".join(own))
    return out + [None, "", " \n ", "one", "One", "two words", "a b c d", "a b c d e", *["exact copy of a text with enough words"] * 20]


def texts(spark, rows):
    return spark.createDataFrame([(i, t, *["x"] * 6) for i, t in rows], TEXT).repartition(3)


def test_jaccard_against_plain(spark, monkeypatch):
    for small, chunk in ((100, 256), (2, 4)):  # the second splits buckets again and cuts them into tiles
        monkeypatch.setattr(jaccard, "SMALL", small)
        monkeypatch.setattr(links, "CHUNK", chunk)
        rows = list(enumerate(corpus()))
        want_links, want_group = plain([t for _, t in rows])
        got = {r.ident: (r.n_links, r.component_id) for r in jaccard_links(texts(spark, rows)).collect()}
        assert got == {i: (want_links[i], want_group[i]) for i, _ in rows}, small


def test_runs_reach_the_recall():
    assert [jaccard.runs_for(r, 0.8) for r in (0.8, 0.9, 0.99, jaccard.RECALL)] == [1, 2, 3, 5]
    assert [jaccard.runs_for(jaccard.RECALL, 0.8, d) for d in (1, 2, 3, 10)] == [5, 7, 9, 20]


def test_recall_where_buckets_split_ten_times(spark, monkeypatch):
    """Pairs of 64-token sketches with 52 tokens in common, among sets that share most buckets with them: every
    bucket of more than two sets is split, down to the last level; the production recall has to hold."""
    monkeypatch.setattr(jaccard, "SMALL", 2)
    monkeypatch.setattr(jaccard, "SIMILAR", 2.0)
    random = np.random.default_rng(4)
    common = random.integers(0, 1 << 30, jaccard.TOKENS)
    rows = []
    for pair in range(250):
        first = np.where(random.random(jaccard.TOKENS) < 0.85, common, random.integers(0, 1 << 30, jaccard.TOKENS))
        other = first.copy()
        other[random.choice(jaccard.TOKENS, 12, replace=False)] = random.integers(1 << 30, 1 << 31, 12)
        rows += [(2 * pair, first.tolist()), (2 * pair + 1, other.tolist())]
    sets = spark.createDataFrame(rows, "node long, sketch array<int>").repartition(4)
    met = jaccard.candidate_buckets(sets, jaccard.RECALL, 0.8).distinct()
    left, right = met.where("node % 2 = 0"), met.select((F.col("node") - 1).alias("node"), "bucket").where("node % 2 = 0")
    assert left.join(right, ["node", "bucket"]).select("node").distinct().count() >= 248


def test_one_large_family(spark):
    rows = list(enumerate(corpus(2, families=1, size=700, words=120, edits=2)))
    want_links, want_group = plain([t for _, t in rows])
    got = {r.ident: (r.n_links, r.component_id) for r in jaccard_links(texts(spark, rows)).collect()}
    assert got == {i: (want_links[i], want_group[i]) for i, _ in rows}


def test_jaccard_stage(spark):
    rows = list(enumerate(corpus(3, families=5, size=4)))
    df = texts(spark, rows)
    _, group = plain([t for _, t in rows])
    out = jaccard_stage(df)
    assert out.schema.fieldNames() == df.schema.fieldNames()
    assert sorted(r.doc_id for r in out.collect()) == [i for i, g in enumerate(group) if i == g]
    odd = texts(spark, [(None, "some text of five words"), (7, "some text of five words"), (7, "some text of five words"), (7, "quite another one with words"), (None, None), (None, None), (8, "")])
    assert sorted((str(r.doc_id), str(r.text)) for r in jaccard_stage(odd).collect()) == [("7", "quite another one with words"), ("7", "some text of five words"), ("8", ""), ("None", "None"), ("None", "None")]


def test_jaccard_empty(spark):
    for df in (texts(spark, []), texts(spark, [(1, None)]), texts(spark, [(1, "only one text of some words")])):
        assert [(r.n_links, r.component_id) for r in jaccard_links(df).collect()] == [(0, r.doc_id) for r in df.collect()]
        assert jaccard_stage(df).count() == df.count()


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), *(T.StructField(n, T.StringType()) for n in ("node", "vec", "bucket", "ident"))])


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], *["x"] * 4) for i, v in rows], VECTORS).repartition(3)


def near(n, width, groups_of, noise, seed):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // groups_of + 1, width))
    return (base[np.arange(n) // groups_of] + noise * rng.standard_normal((n, width))).astype(np.float32)


@pytest.mark.parametrize("width,noise", [(16, 0.15), (64, 0.2), (100, 0.05), (3, 0.3)])
def test_vectors_against_plain(spark, width, noise):
    x = near(900, width, 6, noise, width)
    x[850:] = x[3]  # many copies
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    got = {r.ident: r.n_links for r in vector_links(vectors(spark, list(enumerate(x)))).collect()}
    assert all(got[i] <= linked[i].sum() for i in range(len(x)))
    assert sum(got.values()) >= 0.98 * linked.sum()


def test_vector_components_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(links, "CHUNK", 8)
    x = near(120, 24, 10, 0.02, 4)
    rows = list(enumerate(x)) + [(200, None), (201, [0.0] * 24), (202, [None] * 24), (203, [float("nan"), *[1.0] * 23]), (204, [float("inf"), *[1.0] * 23]), (205, []), (None, x[0]), (7, x[7]), (206, x[0] * 3e30)]
    got = [(r.ident, r.n_links, r.component_id) for r in vector_links(vectors(spark, rows)).collect()]
    assert len(got) == len(rows)
    by_id = {i: (n, c) for i, n, c in got}
    assert all(by_id[i] == (0, i) for i in range(200, 206))
    assert by_id[0] == (12, 0) and by_id[None] == (12, 0) and by_id[206] == (12, 0)
    assert by_id[15] == (9, 10) and by_id[7] == (12, 0) and sum(i == 7 for i, *_ in got) == 2


def test_no_vectors(spark):
    assert vector_links(vectors(spark, [])).count() == 0
    assert [(r.n_links, r.component_id) for r in vector_links(vectors(spark, [(4, None)])).collect()] == [(0, 4)]
    assert [(r.n_links, r.component_id) for r in vector_links(vectors(spark, [(4, [1.0, 2.0])])).collect()] == [(0, 4)]


def test_tables_grow_with_the_number_of_vectors():
    assert tables_for(100, 0.9)[0] == 4 and tables_for(10**9, 0.9)[0] == 24
    assert tables_for(10**9, 0.9)[1] > tables_for(10**6, 0.9)[1] > tables_for(1000, 0.9)[1]


def about_a_direction(n, width, length, seed):
    """n vectors whose mean has the given length, each second one just above a cosine of 0.9 with the one before."""
    rng = np.random.default_rng(seed)
    spread = np.sqrt((1 - length * length) / width)
    x = spread * rng.standard_normal((n, width))
    x[:, 0] += length
    cosine = 1 - 0.099 / (1 - length * length)  # of the parts beside the mean
    x[1::2] = cosine * x[::2] + np.sqrt(1 - cosine * cosine) * spread * rng.standard_normal((n // 2, width))
    x[1::2, 0] += (1 - cosine) * length
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("length", [0.0, 0.8])
def test_recall_whatever_the_mean(length):
    x = about_a_direction(4096, 96, length, 8)
    mean, projection, bits, tables = plan_tables(x[:3000], 10**5, 0.9)
    assert bits and projection.shape[1] == bits * tables < 10**5
    a, b = x[3000::2], x[3001::2]
    near = (a * b).sum(axis=1) >= 0.9
    same = (((a - mean) @ projection >= 0) == ((b - mean) @ projection >= 0)).reshape(len(a), tables, bits)
    assert near.sum() > 200 and same.all(axis=2).any(axis=1)[near].mean() >= 0.985


def test_vectors_about_a_common_direction(spark):
    x = about_a_direction(3000, 64, 0.85, 9).astype(np.float32)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    got = {r.ident: r.n_links for r in vector_links(vectors(spark, list(enumerate(x)))).collect()}
    assert all(got[i] <= linked[i].sum() for i in range(len(x))) and linked.sum() > 1000
    assert sum(got.values()) >= 0.99 * linked.sum()
