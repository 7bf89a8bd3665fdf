"""Merkle manifest of a table: subtree roots by butterfly exchange, a proof and its check for every row."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from hashlib import sha256
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.llm.common import col, read, saved, small_batches
from quotewell.operators.copies import with_row_number

FANOUT = 2
BLOCK = 4096  # leaves of a block at most: what one task holds of a tree at a time
BATCH = 4096
SIDES = "array<struct<before:string,after:string>>"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sealed(value: Column) -> Column:
    """`-` for null, else the number of bytes, `:`, and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[sealed(v) for v in values]), 256)


def _hash(text: bytes) -> bytes:
    return sha256(text).hexdigest().encode()


def block_levels(fanout: int, block: int = BLOCK) -> int:
    """Levels above the leaves of a whole block: one at least, else the most whose leaves do not exceed `block`."""
    levels = 1
    while fanout ** (levels + 1) <= block:
        levels += 1
    return levels


def tree_levels(leaves: list[bytes], fanout: int, height: int | None = None) -> list[list[bytes]]:
    """The nodes of every level, leaves first. Up to one node, or exactly `height` levels above the leaves."""
    out = [leaves]
    while len(out) <= height if height is not None else len(out[-1]) > 1:
        below = out[-1]
        out.append([_hash(b"".join(below[i:i + fanout])) for i in range(0, len(below), fanout)])
    return out


def siblings(levels: list[list[bytes]], at: int, fanout: int) -> list[tuple[bytes, bytes]]:
    """Per level, the run's nodes before and after the one above leaf `at`, each side joined."""
    out = []
    for nodes in levels[:-1]:
        first = at - at % fanout
        out.append((b"".join(nodes[first:at]), b"".join(nodes[at + 1:first + fanout])))
        at //= fanout
    return out


def folded(leaf: bytes, sides: list[tuple[bytes, bytes]]) -> bytes:
    for before, after in sides:
        leaf = _hash(before + leaf + after)
    return leaf


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of one (tree, block) after the other; they arrive in order."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
    for key, group in groupby(rows, key=lambda r: r[:2]):
        yield key, list(group)


def _in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, BATCH)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)


def _local(group: list[tuple], block: int, fanout: int, levels: int) -> list[list[bytes]]:
    """The levels of a block. A tree of one block ends where one node is left; further blocks have all levels of a whole one."""
    return tree_levels([r[3].encode() for r in group], fanout, levels if block else None)


def _ordered(rows: DataFrame) -> DataFrame:
    """One block after the other in each task, a block being its leaves and a header at most."""
    small_batches(rows.sparkSession, BATCH)
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def placed(rows: DataFrame, nth: str, leaves: int) -> DataFrame:
    """pos and block (of so many leaves) of rows numbered from 1."""
    pos = F.col(nth) - 1
    return rows.select("*", pos.alias("pos"), F.floor(pos / F.lit(leaves)).cast("long").alias("block")).drop(nth)


def block_roots(rows: DataFrame, fanout: int, levels: int) -> DataFrame:
    """tree, block, node: the root of every block of (tree, block, pos, leaf)."""
    schema = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("node", pa.string())])

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((tree, block, _local(group, block, fanout, levels)[-1][0].decode()) for (tree, block), group in _blocks(batches))
        yield from _in_batches(found, schema)

    return _ordered(rows.select("tree", "block", "pos", "leaf")).mapInArrow(roots, "tree string, block long, node string")


def butterfly(blocks: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """tree, block, node (now the tree's root), sides (per level above the blocks, what stands before and after) for blocks (tree, block, node).

    In round r the partitions whose numbers differ in digit r alone (base
    `fanout`) are a group: they swap the roots of the subtrees they stand for,
    and each hashes the parent itself. After as many rounds as the largest tree
    has digits every partition holds the root of its tree and, without a way
    down, its whole upper proof. Trees are filled up with partitions without a
    node (fewer than fanout times the real ones); where the right edge of a tree
    is ragged these carry its nodes to those who need them, so no group is
    larger than fanout. Every round is written out.
    """
    sizes = saved(blocks.groupBy(F.col("tree").alias("name")).agg((F.max("block") + 1).alias("size")), "sizes")
    most, rounds = sizes.agg(F.max("size")).first()[0] or 1, 0
    while fanout**rounds < most:
        rounds += 1
    digits = sum((F.when(F.col("size") > fanout**r, 1).otherwise(0) for r in range(rounds)), F.lit(0))
    sizes = sizes.select("name", "size", digits.alias("digits"))
    whole = F.pow(F.lit(fanout), F.col("digits")).cast("long")
    fill = sizes.where(whole > F.col("size")).select(
        F.col("name").alias("tree"), F.explode(F.sequence("size", whole - 1)).alias("block"), F.lit(None).cast("string").alias("node"), "digits", F.lit(False).alias("real")
    )
    first = blocks.join(sizes, F.col("tree").eqNullSafe(F.col("name"))).select("tree", "block", "node", "digits", F.lit(True).alias("real"))
    state = saved(first.unionByName(fill).select("*", F.array().cast(SIDES).alias("sides")), "round")
    for r in range(rounds):
        digit = F.expr(f"block div {fanout**r}L % {fanout}L").alias("digit")
        member = F.struct(digit, "block", "node", "sides", "digits", "real")
        groups = state.where(F.col("digits") > r).groupBy("tree", (F.col("block") - digit * F.lit(fanout**r)).alias("group")).agg(F.collect_list(member).alias("all"))
        each = groups.select("tree", F.filter(F.array_sort("all"), lambda m: m["node"].isNotNull()).alias("with"), F.explode("all").alias("own"))

        def joined(test: Callable[[Column], Column]) -> Column:
            return F.array_join(F.transform(F.filter("with", test), lambda m: m["node"]), "")

        side = F.struct(joined(lambda m: m["digit"] < F.col("own.digit")).alias("before"), joined(lambda m: m["digit"] > F.col("own.digit")).alias("after"))
        swapped = each.select(
            "tree", "own.block", F.when(F.size("with") > 0, F.sha2(F.array_join(F.col("with.node"), ""), 256)).alias("node"), "own.digits", "own.real",
            F.concat("own.sides", F.array(side)).alias("sides"),
        )
        state = saved(swapped.unionByName(state.where(F.col("digits") <= r)), "round")
    return state.where("real").select("tree", "block", "node", "sides")


def _with_headers(rows: DataFrame, headers: DataFrame, *columns: str) -> DataFrame:
    """Every block's rows behind one row (pos -1) with what holds for all of them."""
    both = rows.unionByName(headers.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
    return _ordered(both.select("tree", "block", "pos", "leaf", "node", "sides", *columns))


def _proved(batches: Iterator[pa.RecordBatch], fanout: int, levels: int) -> Iterator[tuple[tuple, tuple, list[tuple[bytes, bytes]]]]:
    """Row, header and sides (up to the top) of every row of `_with_headers`."""
    for (_, block), (header, *group) in _blocks(batches):
        above = [(s["before"].encode(), s["after"].encode()) for s in header[5]]
        local = _local(group, block, fanout, levels)
        for at, row in enumerate(group):
            yield row, header, siblings(local, at, fanout) + above


def _tree(rows: DataFrame, fanout: int, levels: int) -> DataFrame:
    return saved(butterfly(saved(block_roots(rows, fanout, levels), "blocks"), fanout), "upper")


def manifest(
    docs: DataFrame, tree: str = "lang", ident: str = "doc_id", columns: Sequence[str] = COLUMNS,
    tampered: Mapping[str, Column] | None = None, fanout: int = FANOUT, block: int = BLOCK,
) -> DataFrame:
    """A leaf, its tree's root, the root of all trees, and the proof of every row of docs, checked.

    A leaf is the hash of a row's columns. The leaves of a tree (the rows of one
    value of `tree`, as text, null being one) ascend by ident, nulls first, rows
    of one ident by leaf; every `fanout` consecutive nodes become their hash
    until one is left. The roots of the trees, nulls first and then by the bytes
    of their names, make the top tree alike. `tampered` replaces columns by
    others that the check then uses: folded_root and verified show whether the
    root notices. Rows that repeat are leaves each; an empty table gives an
    empty result.

    Returns ident, leaf, subroot, root, proof (hashes of siblings joined, from
    the leaf up), proof_sha256, folded_root, verified.

    Places are numbered by range, so one tree may hold most rows; a task holds
    one block of at most `block` leaves (a power of fanout) at a time. Above the blocks: see `butterfly`.
    """
    levels = block_levels(fanout, block)
    leaf = leaf_hash(*[col(c) for c in columns])
    changed = leaf_hash(*[(tampered or {}).get(c, col(c)) for c in columns])
    leaves = docs.select(col(tree).cast("string").alias("tree"), col(ident).alias("ident"), leaf.alias("leaf"), F.when(changed != leaf, changed).alias("changed"))
    rows = saved(placed(with_row_number(leaves, ["tree"], ["ident", "leaf"], "nth"), "nth", fanout**levels), "leaves")
    upper = _tree(rows, fanout, levels)
    names = upper.where("block = 0").select(F.col("tree").alias("name"), F.col("node").alias("leaf"))
    names = placed(with_row_number(names, [], ["name"], "nth"), "nth", fanout**levels).withColumn("tree", F.lit("top"))
    top = saved(names, "subroots")
    named = _with_headers(top, _tree(top, fanout, levels), "name")

    def of_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((row[6], header[4], [{"before": a.decode(), "after": b.decode()} for a, b in sides]) for row, header, sides in _proved(batches, fanout, levels))
        yield from _in_batches(rows, pa.schema([("name", pa.string()), ("root", pa.string()), ("top", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))]))

    tops = saved(named.mapInArrow(of_trees, f"name string, root string, top {SIDES}"), "tops")
    headers = upper.join(tops, F.col("tree").eqNullSafe(F.col("name"))).select("tree", "block", "node", F.concat("sides", "top").alias("sides"), "root")
    kind = rows.select("ident").limit(0).toArrow().schema.field(0).type
    texts = ("leaf", "subroot", "root", "proof", "folded_root")

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (row[6], row[3], header[4], header[8], b"".join(a + b for a, b in sides).decode(), folded((row[7] or row[3]).encode(), sides).decode())
            for row, header, sides in _proved(batches, fanout, levels)
        )
        yield from _in_batches(rows, pa.schema([("ident", kind), *((t, pa.string()) for t in texts)]))

    out = _with_headers(rows, headers, "ident", "changed", "root").mapInArrow(of_rows, f"ident {rows.schema['ident'].dataType.simpleString()}, " + ", ".join(f"{t} string" for t in texts))
    return out.withColumn("proof_sha256", F.sha2("proof", 256)).withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_chars grows by 1 where 7 divides the CRC-32 of the id; the greatest long, which has no successor, becomes null."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    more = F.when(hit, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))
    return manifest(read(spark, sf_dir, "documents"), tampered={"n_chars": more}).select(
        F.col("ident").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


_SEALED = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(cast({0} AS varchar)) || ':' || cast({0} AS varchar) END"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_SEALED.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# Trees: every level from the one below, all trees at a time; the top tree is the one named by flag 1.
OP11_SQL = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, {_leaf_sql("(n_chars + 1)")} AS changed,
           list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id AS varchar), ''), lambda c: ascii(c)::bigint)),
               lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))) AS crc
    FROM documents
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot, count(*) OVER (PARTITION BY lang) AS size FROM docs
), nodes(lang, lvl, spot, size, h) AS (
    SELECT lang, 0, spot, size, leaf FROM leaves
    UNION ALL
    SELECT lang, lvl + 1, spot // 2, (size + 1) // 2, sha256(string_agg(h, '' ORDER BY spot)) FROM nodes WHERE size > 1 GROUP BY lang, lvl, size, spot // 2
), subroots AS (
    SELECT lang, h AS subroot, lvl AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS spot, count(*) OVER () AS size FROM nodes WHERE size = 1
), upper_nodes(lvl, spot, size, h) AS (
    SELECT 0, spot, size, subroot FROM subroots
    UNION ALL
    SELECT lvl + 1, spot // 2, (size + 1) // 2, sha256(string_agg(h, '' ORDER BY spot)) FROM upper_nodes WHERE size > 1 GROUP BY lvl, size, spot // 2
), steps AS (
    SELECT l.doc_id, l.spot AS own, l.lang, s.lvl, (l.spot >> s.lvl) & 1 AS side, n.h AS other
    FROM leaves l JOIN (SELECT DISTINCT lang, lvl, size FROM nodes WHERE size > 1) s ON l.lang IS NOT DISTINCT FROM s.lang
    LEFT JOIN nodes n ON n.lang IS NOT DISTINCT FROM l.lang AND n.lvl = s.lvl AND n.spot = xor(l.spot >> s.lvl, 1)
    UNION ALL
    SELECT l.doc_id, l.spot, l.lang, r.height + s.lvl, (r.spot >> s.lvl) & 1, n.h
    FROM leaves l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang, (SELECT DISTINCT lvl FROM upper_nodes WHERE size > 1) s
    LEFT JOIN upper_nodes n ON n.lvl = s.lvl AND n.spot = xor(r.spot >> s.lvl, 1)
), proofs AS (
    SELECT lang, own, list((side, other) ORDER BY lvl) AS sides, coalesce(string_agg(other, '' ORDER BY lvl), '') AS joined FROM steps GROUP BY lang, own
), fold(lang, own, lvl, h, sides) AS (
    SELECT l.lang, l.spot, 0, CASE WHEN xor(crc, 4294967295) % 7 = 0 AND changed <> leaf THEN changed ELSE leaf END, p.sides
    FROM leaves l LEFT JOIN proofs p ON l.lang IS NOT DISTINCT FROM p.lang AND l.spot = p.own
    UNION ALL
    SELECT lang, own, lvl + 1, sha256(CASE WHEN sides[lvl + 1][1] = 1 THEN coalesce(sides[lvl + 1][2], '') || h ELSE h || coalesce(sides[lvl + 1][2], '') END), sides
    FROM fold WHERE lvl < len(sides)
)
SELECT l.doc_id, l.leaf, r.subroot, u.h AS root, sha256(coalesce(p.joined, '')) AS proof_sha256, f.h AS folded_root, f.h = u.h AS verified
FROM leaves l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang JOIN (SELECT h FROM upper_nodes WHERE size = 1) u ON true
LEFT JOIN proofs p ON l.lang IS NOT DISTINCT FROM p.lang AND l.spot = p.own
JOIN fold f ON l.lang IS NOT DISTINCT FROM f.lang AND l.spot = f.own AND f.lvl = coalesce(len(f.sides), 0)
"""
