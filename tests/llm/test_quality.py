import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from quotewell.llm import quality
from quotewell.llm.quality import judged, quality_stage, train

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), *(T.StructField(n, T.StringType()) for n in ("ident", "body", "keep", "k1", "doc", "perplexity"))])


def prose(n, seed=1):
    random = np.random.default_rng(seed)
    words = "the of and to in is that it was for on are as with his they at be this from have".split()
    return [" ".join(random.choice(words, 40)).capitalize() + "." for _ in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 6) for r in rows], SCHEMA).repartition(3)


def plain_model(texts):
    """Interpolated modified Kneser-Ney with dictionaries, order by order, over all characters."""
    padded = [["\0"] * 3 + ["0" if c in "0123456789" else c for c in t] for t in texts]
    base = 1 / (len({c for p in padded for c in p[3:]}) + 1)
    counts = [None] * 5
    counts[4] = Counter(tuple(map(ord, p[i : i + 4])) for p in padded for i in range(len(p) - 3))
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    tables = {}
    for k in (1, 2, 3, 4):
        n = Counter(min(v, 5) for v in counts[k].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0
        raw = [1 - 2 * y * n[2] / n[1] if n[1] else 0.5, 2 - 3 * y * n[3] / n[2] if n[2] else 1.0, 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        d = [min(max(x, 0.05), i + 0.95) for i, x in enumerate(raw)]
        total, left = defaultdict(float), defaultdict(float)
        for g, v in counts[k].items():
            total[g[:-1]] += v
            left[g[:-1]] += d[min(v, 3) - 1]
        tables[k] = (counts[k], d, total, left)

    def p(gram):
        if not gram:
            return base
        own, d, total, left = tables[len(gram)]
        lower = p(gram[1:])
        if gram[:-1] not in total:
            return lower
        v = own[gram]
        return (max(v - d[min(v, 3) - 1], 0) if v else 0) / total[gram[:-1]] + left[gram[:-1]] / total[gram[:-1]] * lower

    return p


def halves(g):
    return (g[0] << 21) | g[1], (g[2] << 21) | g[3]


def test_model_against_plain(spark):
    texts = [*prose(30), "Ünïcode — 1234 text 🙂🙃", "", "a", "zz" * 40, "Привет, мир", "日本語の文"]
    model = train(quality._pressed(spark.createDataFrame([(t,) for t in texts], "body string").repartition(3)))
    p = plain_model(texts)
    random = np.random.default_rng(2)
    signs = [0, *map(ord, "the of,.T0zПриво日本語🙂🙃\U0010ffff")]
    asked = {tuple(int(signs[i]) for i in g) for g in random.integers(0, len(signs), (400, 4))}
    asked |= {tuple(map(ord, "the ")), (0, 0, 0, ord("T")), (0, 0, 0, 0), tuple(map(ord, "ривe")), tuple(map(ord, "本語の文"))}
    grams = spark.createDataFrame([halves(g) for g in asked], "hi long, lo long").repartition(3)
    got = {(r.hi, r.lo): r.log for r in quality.log_probabilities(grams, model).collect()}
    assert len(got) == len(asked)
    for g in asked:
        assert got[halves(g)] == pytest.approx(math.log(p(g)), abs=1e-9), g


@pytest.mark.parametrize("chars", [1 << 22, 300])
def test_perplexities_against_plain(spark, monkeypatch, chars):
    """In one batch and in many, copies of rows among them."""
    monkeypatch.setattr(quality, "BATCH_CHARS", chars)
    texts = [*prose(20), "Привет, мир", "日本語", "", None, "x", "🙂" * 30]
    model = train(quality._pressed(spark.createDataFrame([(t,) for t in texts if t is not None], "body string")))
    p = plain_model([t for t in texts if t is not None])
    rows = [(i, t) for i, t in enumerate([*texts, "new 77 text 文", "%" * 50])] + [(0, texts[0])] * 5 + [(1000, texts[1])]
    df = spark.createDataFrame([(i, t, hash((i, t)) >> 8, i) for i, t in rows], "ident long, body string, k1 long, k2 long").repartition(4)
    out = quality.perplexities(df, model).collect()
    assert sorted(r.ident for r in out) == sorted(i for i, _ in rows)
    for r in out:
        text = dict(rows)[r.ident]
        padded = [0, 0, 0, *[ord("0") if c in "0123456789" else ord(c) for c in text or ""]]
        logs = [math.log(max(p(tuple(padded[i : i + 4])), 1e-12)) for i in range(len(padded) - 3)]
        assert r.chars == len(logs) and (r.perplexity is None) == (not logs)
        if logs:
            assert r.perplexity == pytest.approx(math.exp(-sum(logs) / len(logs)), rel=1e-9)


def test_keys_of_very_many_characters():
    chars = np.arange(0x110000, dtype=np.int64)
    keys = quality._Keys(chars)
    assert not keys.exact
    codes = np.random.default_rng(1).integers(0, 0x110000, 5000).astype(np.uint32)
    hi, lo = quality._halves(codes)
    assert (keys.of(codes) == keys.of_halves(hi, lo)).all() and len(np.unique(keys.of(codes))) == len({*zip(hi, lo, strict=True)})
    texts = ["".join(chr(c) for c in range(0x1000, 0xD800)) + "".join(chr(c) for c in range(0x10000, 0x20000))] * 2
    hi, lo, n = quality._counted(texts)
    assert set(n) == {2} and len(n) == len(texts[0])


def test_a_script_beside_a_majority_is_judged_for_itself(spark):
    """Prose and junk of a script that one text in ten is in, over the same letters."""
    random = np.random.default_rng(3)
    words = "это был не на что по как она из так все его было для вот когда даже тут".split()
    russian = lambda n, seed: [" ".join(np.random.default_rng(seed + i).choice(words, 40)) + "." for i in range(n)]
    good = [(i, t, "en") for i, t in enumerate(prose(1500))] + [(5000 + i, t, "ru") for i, t in enumerate(russian(200, 10))]
    new = [(7000 + i, t, "ru") for i, t in enumerate(russian(30, 5000))]
    letters = sorted({c for w in words for c in w})
    junk = [(8000 + i, " ".join("".join(random.choice(letters, 4)) for _ in range(40)), "ru") for i in range(30)]
    keep = {r.ident: r.keep for r in judged(table(spark, good + new + junk), labelled(spark, good)).collect()}
    assert not any(keep[i] for i, *_ in junk) and all(keep[i] for i, *_ in new)


def labelled(spark, rows):
    return spark.createDataFrame([(i, 1, 0) for i, *_ in rows if i is not None], "doc_id long, quality int, toxic int")


def test_junk_goes_and_prose_stays(spark):
    good = [(i, t, "en" if i % 5 else "fr") for i, t in enumerate(prose(400))]
    new = [(1000 + i, t, "en") for i, t in enumerate(prose(60, 9))] + [(1100, "The of.", "en"), (1101, "It", None), (1102, prose(1, 4)[0], None), (1103, prose(1, 5)[0], "rare")]
    junk = [(2000 + i, "".join(chr(33 + (7 * i + j * j) % 90) for j in range(200)), "en") for i in range(20)] + [(2020, "#$% " * 50, None)]
    odd = [(3000, None, "en"), (3001, "", "en"), (None, prose(1, 6)[0], "en"), (3002, "good " * 3, "en"), (3002, "good " * 3, "en"), (3003, " ".join(prose(400, 7)), "en")]
    df = table(spark, good + new + junk + odd)
    found = judged(df, labelled(spark, good)).collect()
    assert len(found) == df.count()
    keep = {r.ident: r.keep for r in found}
    assert [i for i, *_ in good + new if not keep[i]] == []
    assert [i for i, *_ in junk if keep[i]] == []
    assert all(keep[i] for i in (3000, 3001, None, 3003))
    out = quality_stage(df, labelled(spark, good))
    assert out.schema.fieldNames() == df.schema.fieldNames()
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r.ident) for r in found if r.keep)


def test_fence_lies_at_the_trusted_documents(spark):
    good = [(i, t, "en") for i, t in enumerate(prose(400))]
    long = [(1000, " ".join(prose(200, 3)), "en")]
    df = table(spark, good + long)
    held = {r.doc_id for r in df.where(quality._calibrating(df["doc_id"])).collect()} - {1000}
    found = {r.ident: r for r in judged(df, labelled(spark, good)).collect()}
    assert found[1000].keep and found[1000].threshold <= 1.01 * max(found[i].perplexity for i in held)


def test_pieces_of_long_texts(spark, monkeypatch):
    text = " ".join(prose(3))
    whole = np.concatenate([c[3:] for c in quality._pieces(text)])
    monkeypatch.setattr(quality, "_CHARS", 10)
    parts = [c[3:] for c in quality._pieces(text)]
    assert len(parts) > 5 and (np.concatenate(parts) == whole).all()


def test_few_or_no_labels_keep_everything(spark):
    rows = [(i, t, "en") for i, t in enumerate(prose(10))] + [(10, "%$#@!" * 20, "en")]
    df = table(spark, rows)
    assert judged(df, labelled(spark, rows[:3])).where("not keep").count() == 0
    assert judged(df, labelled(spark, [])).where("not keep").count() == 0
    bad = spark.createDataFrame([(1, 0, 0), (2, None, None), (None, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    assert judged(df, bad).where("not keep").count() == 0


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert judged(empty, labelled(spark, [])).count() == 0 and quality_stage(empty, labelled(spark, [])).columns == SCHEMA.fieldNames()
