import random
import re

import pytest

from quotewell.llm.decontaminate import Search, decontaminate, windows_of, words_of

DOCS = "doc_id long, text string, lang string, words string, window string, list string, lists string, item string, items string, spans string"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def plain(docs, items, window=10):
    listed = [(i, tuple(w[a:a + window])) for i, t in items for w in [words(t)] if w for a in range(max(1, len(w) - window + 1))]
    out = []
    for ident, text in docs:
        own, hit, found = words(text), set(), set()
        for item, part in listed:
            for a in range(len(own) - len(part) + 1):
                if tuple(own[a:a + len(part)]) == part:
                    hit |= set(range(a, a + len(part)))
                    found.add("" if item is None else str(item))
        out.append((ident, len(own), len(hit), len(found), sorted(found)))
    return sorted(map(str, out))


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, *["x"] * 8) for i, t in docs], DOCS).repartition(3),
        spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, window string, list string").repartition(2),
    )


def found(df):
    return sorted(str(tuple(r)) for r in df.select("ident", "n_words", "n_hit", "n_items", "items").collect())


LONG = " ".join(f"w{i}" for i in range(40))
ITEMS = [(1, LONG), (2, "Five little words stand HERE"), (3, "one"), (4, None), (5, "... !!"), (6, LONG), (7, " ".join(f"w{i}" for i in range(20, 45))), (None, "née é日本 \U0001f642x"), (8, "a b a b a b a b a b a b"), (1, "tail of one")]
TEXTS = [
    None, "", "?", LONG.upper(), "x " + LONG.replace(" ", ", ") + " y", " ".join(f"w{i}" for i in range(9)), " ".join(f"w{i}" for i in range(10)), "five little words; stand-here", "one two one", "NÉE é日本\x00\U0001f642x", "née É日本 \U0001f642x",
    "née é日本 \U0001f642X", "a b " * 30, "b a " * 4, "tail of one", " ".join(f"w{i}" for i in range(30, 45)) + " z " + LONG, "word " * 50000 + LONG + " word" * 50000, "x" * 300000, "W0_w1 w2",
]


def test_against_plain(spark):
    docs = [(i % 16 if i != 2 else None, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3])] * 2
    want = plain(docs, ITEMS)
    for block_bytes in (32 << 20, 400):  # one block, and many
        assert found(decontaminate(*tables(spark, docs, ITEMS), block_bytes=block_bytes)) == want
    assert found(decontaminate(*tables(spark, docs, ITEMS), window=3)) == plain(docs, ITEMS, 3)


def test_random_texts(spark):
    pick = random.Random(3)
    text = lambda n: " ".join(pick.choice("abc") for _ in range(n))
    items = [(i, text(pick.choice([1, 2, 4, 7, 8, 30]) + 4)) for i in range(12)]
    docs = [(i, text(pick.randrange(200))) for i in range(60)]
    for window in (5, 7):
        assert found(decontaminate(*tables(spark, docs, items), window=window)) == plain(docs, items, window)


def test_spans_and_a_window_of_many_items(spark):
    docs, items = tables(spark, [(1, "q " + LONG + " q " + LONG)], [(i, LONG) for i in range(500)])
    row = decontaminate(docs, items).first()
    assert [(s.first, s.stop) for s in row.spans] == [(1, 41), (42, 82)]
    assert row.n_items == 500 and row["items"] == sorted(map(str, range(500))) and row.n_hit == 80


def test_windows_and_shifts(spark):
    _, items = tables(spark, [], [(1, LONG), (2, "a b"), (3, "")])
    out = windows_of(items.selectExpr("cast(item_id as string) as item", "text")).collect()
    assert len(out) == 32 and (b"a b", "2") in {(bytes(r.window), r["item"]) for r in out}
    size, shift, buckets = Search([(b"a b c d e", 1), (b"c d x y z", 2)]).tables[5]
    assert (size, shift[(b"a", b"b")], shift[(b"c", b"d")], shift[(b"d", b"e")], (b"z", b"a") in shift) == (2, 3, 1, 0, False)
    assert list(buckets) == [(b"d", b"e"), (b"y", b"z")] and words_of("Ab,É\x7fÉ_9".encode()) == [b"ab", "É".encode(), "É".encode(), b"9"]


@pytest.mark.parametrize("docs,items", [([], [(1, LONG)]), ([(1, LONG), (None, None)], [])])
def test_empty_tables(spark, docs, items):
    assert found(decontaminate(*tables(spark, docs, items))) == plain(docs, items)
