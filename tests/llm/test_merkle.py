from hashlib import sha256
from itertools import groupby
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from quotewell.llm.merkle import COLUMNS, butterfly, manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, block string, pos string, leaf string, node string, sides string, root string, name string, changed string, nth string"


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def sides(tree, at, fanout):
    for nodes in tree[:-1]:
        first = at // fanout * fanout
        yield "".join(nodes[first:at]), "".join(nodes[at + 1:first + fanout])
        at //= fanout


def plain(rows, fanout, tampered=lambda row: row):
    key = lambda r: (r[2] is not None, (r[2] or "").encode())
    trees = []
    for _, group in groupby(sorted(rows, key=key), key=key):
        group = sorted(group, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((group, levels([leaf(r) for r in group], fanout)))
    top = levels([t[-1][0] for _, t in trees], fanout)
    out = []
    for place, (group, tree) in enumerate(trees):
        for at, row in enumerate(group):
            path = [*sides(tree, at, fanout), *sides(top, place, fanout)]
            node = leaf(tampered(row))
            for before, after in path:
                node = h(before + node + after)
            out.append((row[0], leaf(row), tree[-1][0], top[-1][0], h("".join(a + b for a, b in path)), node, node == top[-1][0]))
    return sorted(map(str, out))


def table(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 10) for r in rows], SCHEMA).repartition(3)


def found(df):
    return sorted(str(tuple(r)) for r in df.select("ident", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


ODD = [
    (1, "s", "en", 3, "abc"), (1, "s", "en", 3, "abc"), (1, "s", "en", 3, "abd"), (None, None, None, None, None), (None, None, None, None, None), (2, "", "", 0, ""), (3, "-", "é", 1, "日本"),
    (4, "s", "z", -1, "x" * 100000), (5, "s", "\U0001f642", 2**63 - 1, "1:a"), (6, "s", "￿", 5, None), (None, "s", "en", 1, "q"),
]


@pytest.mark.parametrize("fanout,block", [(2, 4096), (2, 2), (2, 4), (3, 3), (5, 25)])
def test_against_plain(spark, fanout, block):
    rows = ODD + [(100 + i, "s", "en" if i % 10 else "de", i, f"text {i}") for i in range(83)]
    assert found(manifest(table(spark, rows), fanout=fanout, block=block)) == plain(rows, fanout)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 33])
def test_ragged_trees(spark, n):
    rows = [(i, "s", "en", i, "t") for i in range(n)]
    assert found(manifest(table(spark, rows), block=2)) == plain(rows, 2)


def test_many_trees(spark):
    rows = [(i, "s", f"l{i % 37}", i, "t") for i in range(90)]
    assert found(manifest(table(spark, rows), block=4)) == plain(rows, 2)


def test_tampering_is_noticed(spark):
    rows = ODD[:4] + [(i, "s", "en", i if i % 5 else None, "t") for i in range(10, 60)]

    def hit(row):
        return row[0] is not None and crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None

    more = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    out = manifest(table(spark, rows), tampered={"n_chars": more}, block=8)
    assert found(out) == plain(rows, 2, lambda r: (*r[:3], r[3] + 1, r[4]) if hit(r) else r)
    assert out.where(~F.col("verified")).count() == sum(map(hit, rows)) > 0


def test_groups_of_the_exchange_are_no_larger_than_fanout(spark):
    blocks = spark.range(11).select(F.lit("t").alias("tree"), F.col("id").alias("block"), F.sha2(F.col("id").cast("string"), 256).alias("node"))
    out = butterfly(blocks, 3).orderBy("block").collect()
    tree = levels([h(str(i)) for i in range(11)], 3)
    assert [r.block for r in out] == list(range(11)) and {r.node for r in out} == {tree[-1][0]}
    assert [[(s.before, s.after) for s in r.sides] for r in out] == [list(sides(tree, i, 3)) for i in range(11)]


def test_empty_table(spark):
    assert manifest(spark.createDataFrame([], SCHEMA)).count() == 0 and COLUMNS == ("doc_id", "source", "lang", "n_chars", "text")
