import math

import numpy as np
from pyspark.sql import types as T

from quotewell.llm import langid
from quotewell.llm.langid import features, held_out, identify, op9_language_id, train

WORDS = {"en": "the and of that with house water under street".split(), "xx": "quo pra zil vek noor ymba tuch ñol".split(), "yy": "ärü öste üng schöm ßal dräk".split()}


def sentences(n, seed=1):
    random = np.random.default_rng(seed)
    langs = list(WORDS)
    return [(i, " ".join(random.choice(WORDS[langs[i % 3]], 12)) + ".", langs[i % 3]) for i in range(n)]


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), *(T.StructField(n, T.StringType()) for n in ("body", "score", "lang_pred", "ident", "at"))])


def table(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA).repartition(3)


def test_held_out_accuracy(spark):
    rows = sentences(600)
    df = table(spark, rows)
    model = train(df.where(~held_out()))
    found = {r.ident: r for r in identify(df, model).collect()}
    assert all(found[i].lang_pred == lang and 0 < found[i].score <= 1 for i, _, lang in rows)
    assert (model.weights == 0).mean() > 0.5  # sparse


def test_edge_cases(spark):
    rows = sentences(90) + [(1000, None, "en"), (1001, "", "en"), (1002, "123 !?", "en"), (1003, "the house", None), (None, "the water of that street", "xx"), (5, *sentences(6)[5][1:])]
    df = table(spark, rows)
    model = train(df.where("doc_id < 90"))
    found = [(r.ident, r.lang_pred, r.score) for r in identify(df, model).collect()]
    by_id = {i: (p, s) for i, p, s in found}
    assert len(found) == len(rows)
    assert all(by_id[i] == ("und", 0.0) for i in (1000, 1001, 1002))
    assert by_id[1003][0] == by_id[None][0] == "en"
    assert len({x for x in found if x[0] == 5}) == 1  # repeated rows agree


def test_without_anything_to_learn(spark):
    assert train(table(spark, [(1, "text", None), (2, None, "en")])) is None
    assert {(r.lang_pred, r.score) for r in identify(table(spark, sentences(3)), None).collect()} == {("und", 0.0)}
    empty = spark.createDataFrame([], SCHEMA)
    assert train(empty) is None and identify(empty, None).count() == 0
    only = train(table(spark, [r for r in sentences(30) if r[2] == "en"]))
    assert {r.lang_pred for r in identify(table(spark, sentences(6)), only).collect()} == {"en"}


def test_whole_text_counts_alike_in_pieces(monkeypatch):
    text = " ".join(t for _, t, _ in sentences(50)) + "Ä"
    whole = features(text)
    for piece in (2, 3, 7, 100):
        monkeypatch.setattr(langid, "_PIECE", piece)
        assert (features(text) == whole).all(), piece
    assert whole.sum() == 3 * (len(text) + 2) - 3


def test_held_out_matches_crc32(spark):
    import zlib

    df = spark.range(300).withColumnRenamed("id", "doc_id").withColumn("h", held_out())
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in df.collect())


def test_language_is_no_input(spark, tmp_path):
    rows = sentences(300)
    for name, change in (("a", False), ("b", True)):
        changed = [(i, t, "zz" if change and __import__("zlib").crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in rows]
        table(spark, changed).write.parquet(str(tmp_path / name / "documents.parquet"))
    a, b = (sorted(map(tuple, op9_language_id(spark, str(tmp_path / n)).select("doc_id", "held_out", "lang_pred").collect())) for n in "ab")
    assert a == b and {x[2] for x in a} == set(WORDS)


def plain_ftrl(rows, n_langs, labels, size, train_on, epochs=4, alpha=0.5, beta=1.0, l1=1e-2, l2=1e-3):
    """Follow-the-regularised-leader, one weight at a time."""
    z = [[0.0] * n_langs for _ in range(size + 1)]
    n = [[0.0] * n_langs for _ in range(size + 1)]

    def weight(f, k):
        if abs(z[f][k]) <= l1:
            return 0.0
        return -(z[f][k] - math.copysign(l1, z[f][k])) / ((beta + math.sqrt(n[f][k])) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(train_on):
            items = [*zip(*rows[i], strict=True), (size, 1.0)]
            scores = [sum(x * weight(f, k) for f, x in items) for k in range(n_langs)]
            top = max(scores)
            exps = [math.exp(s - top) for s in scores]
            p = [e / sum(exps) for e in exps]
            old = {(f, k): weight(f, k) for f, _ in items for k in range(n_langs)}
            for f, x in items:
                for k in range(n_langs):
                    g = x * (p[k] - (labels[i] == k))
                    sigma = (math.sqrt(n[f][k] + g * g) - math.sqrt(n[f][k])) / alpha
                    z[f][k] += g - sigma * old[f, k]
                    n[f][k] += g * g
    return np.array([[weight(f, k) for k in range(n_langs)] for f in range(size + 1)])


def small_problem(n=60, size=40, seed=4):
    random = np.random.default_rng(seed)
    labels = random.integers(0, 3, n)
    rows = []
    for y in labels:
        at = np.sort(random.choice(size, 8, replace=False))
        x = random.random(8) + (at % 3 == y) * 0.7
        rows.append((at, x / np.sqrt((x * x).sum())))
    return rows, labels, size


def test_weights_against_plain():
    rows, labels, size = small_problem()
    for l1, zeros in ((1e-2, False), (0.3, True)):
        model = langid.fit(rows, ["a", "b", "c"], labels, np.ones(size), l1=l1)
        want = plain_ftrl(rows, 3, labels, size, [i for i in range(len(rows)) if i % 5], l1=l1)
        assert np.allclose(model.weights, want[:-1], atol=1e-10) and np.allclose(model.bias, want[-1], atol=1e-10)
        assert (model.weights == 0).any() == zeros and (model.weights != 0).any()


def test_temperature_against_a_grid():
    rows, labels, size = small_problem(200)
    model = langid.fit(rows, ["a", "b", "c"], labels, np.ones(size))
    held = range(0, len(rows), 5)
    logits = np.array([rows[i][1] @ model.weights[rows[i][0]] + model.bias for i in held])
    rest = 1 / (len(logits) + 2)

    def loss(t):
        z = logits / t
        logs = z - z.max(axis=1, keepdims=True)
        logs = logs - np.log(np.exp(logs).sum(axis=1, keepdims=True))
        own = logs[np.arange(len(logs)), labels[::5]]
        return -((1 - rest) * own + rest * logs.mean(axis=1)).mean()

    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 4001))
    best = grid[np.argmin([loss(t) for t in grid])]
    assert abs(np.log(model.temperature) - np.log(best)) < 0.005


def test_repeats_count_once_and_do_not_fill_the_sample(spark, monkeypatch):
    """Whatever repeats, the same rows are learned from; each reaches the driver once."""
    seen = []
    real = langid.fit
    monkeypatch.setattr(langid, "fit", lambda rows, *a, **k: seen.append(len(rows)) or real(rows, *a, **k))
    rows = sentences(240)
    plain = train(table(spark, rows), rows_per_lang=50)
    more = train(table(spark, rows + [rows[0]] * 3000), rows_per_lang=50)
    assert seen == [150, 150] and (plain.weights != 0).sum() > 0
    assert ((plain.weights != 0) == (more.weights != 0)).mean() > 0.9  # the frequencies differ, the sample does not
