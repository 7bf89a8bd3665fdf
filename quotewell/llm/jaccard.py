"""N-gram Jaccard join by chosen paths: split sets on sampled shared tokens, compare small buckets, repeat."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.llm.common import col, key_pair, packed, read, saved, small_batches, unpacked
from quotewell.llm.itq import with_components
from quotewell.llm.links import distinct_buckets, links, tile_plan

WORDS = 5
TOKENS = 64  # minhash tokens that stand for a set
RECALL = 0.9998  # of pairs right at the threshold
SMALL = 100  # buckets of at most so many sets are compared
SIMILAR = 0.7  # a bucket that keeps this share of its parent holds similar sets and is compared, too
DEPTH = 10
_KEEP_WORDS = 1 << 19


class _Hashes(dict):
    """Hashes of words, a bounded number of them remembered per worker."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _KEEP_WORDS:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


_HASHES = _Hashes()


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Per text the sorted hashes of its runs of WORDS words (lower case, cut at blanks); fewer words than that are one run, none give an empty set."""
    out = []
    for text in texts:
        words = text.lower().split() if text else []
        h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
        n = min(WORDS, len(words))
        if n == 0:
            out.append(h)
            continue
        runs = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            runs = (runs ^ h[i : len(h) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            runs ^= runs >> np.uint64(32)
        out.append(np.unique(runs))
    return out


def _sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of TOKENS minhashes per set that is not empty."""
    random = np.random.default_rng(5)
    factors = random.integers(1, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    terms = random.integers(0, 1 << 63, TOKENS, dtype=np.uint64)
    full = [s for s in sets if len(s)]
    out = np.empty((len(full), TOKENS), np.int32)
    if full:
        every = np.concatenate(full)
        starts = np.concatenate(([0], np.cumsum([len(s) for s in full])[:-1]))
        for i in range(TOKENS):
            mixed = (every * factors[i] + terms[i]) >> np.uint64(32)
            out[:, i] = np.minimum.reduceat(mixed, starts).astype(np.uint32).view(np.int32)
    return out


def _sketched(rows: DataFrame) -> DataFrame:
    """rows with node (64-bit hash of the set; null for a text without words) and sketch in place of body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("body").to_pylist())
            sketches, rest = iter(_sketches(sets)), [c for c in batch.schema.names if c != "body"]
            nodes = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(nodes, pa.int64()), pa.array([next(sketches) if len(s) else None for s in sets], pa.list_(pa.int32()))],
                names=[*rest, "node", "sketch"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "body")
    return rows.mapInArrow(run, f"{fields}, node long, sketch array<int>")


def _children(path: Column, sketch: Column) -> Column:
    """The buckets one level below: one sampled token always, a second one at every fourth path, 1 / 0.8 on average."""

    def child(salt: int) -> Column:
        place = F.pmod(F.xxhash64(path, F.lit(salt)), F.lit(TOKENS)).cast("int")
        return F.xxhash64(path, place, sketch[place])

    more = F.pmod(F.xxhash64(path, F.lit("more")), F.lit(4)) == 0
    return F.when(more, F.array_distinct(F.array(child(1), child(2)))).otherwise(F.array(child(1)))


def meets(depth: int, threshold: float) -> float:
    """How likely a pair at the threshold has met in a run after `depth` splits:
    it takes a path with the threshold's probability, or one of two paths at
    every fourth node, and then has to go on from there."""
    out = 1.0
    for _ in range(depth):
        out = 0.75 * threshold * out + 0.25 * (1 - (1 - threshold * out) ** 2)
    return out


def runs_for(recall: float, threshold: float, depth: int = 1) -> int:
    """Runs until a pair at the threshold has met with this probability."""
    return ceil(log(1 - recall) / log(1 - meets(depth, threshold)))


def _split(sets: DataFrame, level: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """The buckets of the runs that start at `level` (node, path, size), and node, depth: how often a set was split, where more than once."""
    done: list[DataFrame] = []
    deep: list[DataFrame] = []
    for depth in range(1, DEPTH + 1):
        down = level.join(sets, "node").select("node", F.col("size").alias("parent"), F.explode(_children(F.col("path"), F.col("sketch"))).alias("path"))
        rows = saved(down, "paths")
        sizes = saved(rows.groupBy("path").agg(F.count("*").alias("size")).where("size > 1"), "path-sizes")
        rows = saved(rows.join(sizes, "path"), "split")
        stop = (F.col("size") <= SMALL) | F.coalesce(F.col("size") >= SIMILAR * F.col("parent"), F.lit(False)) | F.lit(depth == DEPTH)
        done.append(rows.where(stop).select("node", F.col("path").alias("bucket")))
        level = rows.where(~stop).select("node", "path", "size")
        if not level.limit(1).count():
            break
        deep.append(level.select("node", F.lit(depth + 1).alias("depth")))
    return done, deep


def candidate_buckets(sets: DataFrame, recall: float, threshold: float) -> DataFrame:
    """node, bucket: the buckets of all runs in which sets (node, sketch) are to be compared.

    Runs go down together, one level per round. A bucket of one set is done.
    One of at most SMALL sets, or that keeps SIMILAR of its parent's sets, is
    compared; the others are split again. What is left at DEPTH is compared, too:
    links() cuts buckets of any size into tiles.

    Every split loses some pairs, so a set that was split often takes part in
    more runs: as many as the recall asks for at its depth. A pair shares a
    bucket for no more splits than either set has seen, so both are in those.
    """
    nothing = F.lit(None).cast("long").alias("size")
    have, done = runs_for(recall, threshold), []
    starts = sets.select("node", F.explode(F.sequence(F.lit(0), F.lit(have - 1))).alias("run"))
    depths: DataFrame | None = None
    while True:
        level = starts.select("node", F.xxhash64(F.lit("run"), "run").alias("path"), nothing)
        buckets, deep = _split(sets, level)
        done += buckets
        if not deep:
            break
        for rows in deep[1:]:
            deep[0] = deep[0].union(rows)
        seen = deep[0].groupBy("node").agg(F.max("depth").alias("depth"), F.lit(have).alias("have"))
        if depths is not None:
            seen = depths.union(seen).groupBy("node").agg(F.max("depth").alias("depth"), F.max("have").alias("have"))
        asked = F.element_at(F.array(*[F.lit(runs_for(recall, threshold, d)) for d in range(1, DEPTH + 1)]), F.col("depth"))
        seen = saved(seen.select("node", "depth", "have", asked.alias("asked")), "depths")
        more = seen.where("asked > have")
        if not more.limit(1).count():
            break
        starts = more.select("node", F.explode(F.sequence(F.col("have"), F.col("asked") - 1)).alias("run"))
        depths = seen.select("node", "depth", F.greatest("have", "asked").alias("have"))
    out = done[0]
    for rows in done[1:]:
        out = out.union(rows)
    return out


def jaccard_links(docs: DataFrame, threshold: float = 0.8, recall: float = RECALL, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """ident, k1, k2 (hash of id and text), n_links, component_id (least id reachable by links), root (the component), one row per row of docs.

    A link is a Jaccard similarity >= threshold of the sets of five-word runs,
    checked exactly; n_links counts the other documents linked directly, copies
    included. Texts with equal sets are one node with a weight, never expanded.
    Texts without words (null, empty, blank) link with nothing. Null ids link
    but do not name a component unless all of its ids are null.

    Runs are repeated until `recall` is reached: five at 0.8, as a pair meets in
    the first bucket of a run with 0.84. Sets in crowded buckets, which are split
    further, take part in more runs: 7 after two splits, 20 after ten.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(col(ident).alias("ident"), col(text).alias("body")).select("ident", *key_pair(F.col("ident"), F.col("body")), "body")
    found = saved(_sketched(rows), "sketches")
    with_words = found.where("node is not null")
    classes = with_words.groupBy("node").agg(F.count("*").alias("weight"), F.min("ident").alias("least"), F.min(F.struct("k1", "k2")).alias("rep"))
    nodes = saved(classes, "set-classes")
    # The sketch of a class is that of its representative: a join on the row, which no class crowds.
    rep = nodes.select("node", "rep.k1", "rep.k2")
    sets = saved(found.select("k1", "k2", "sketch").join(rep, ["k1", "k2"]).dropDuplicates(["node"]).select("node", "sketch"), "set-sketches")
    members = distinct_buckets(candidate_buckets(sets, recall, threshold))
    needed = saved(tile_plan(members).join(nodes.select("node", "weight", "rep.*"), "node"), "needed")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shingle_sets(batch.column("body").to_pylist())
            rest = [c for c in batch.schema.names if c != "body"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], names=[*rest, "runs"])

    def linked(table: pa.Table) -> np.ndarray:
        column = table.column("runs").combine_chunks()
        sizes = np.diff(column.offsets.to_numpy())
        _, place, n = np.unique(column.flatten().to_numpy(), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        shared = n[place] > 1  # runs of words that only one set has do not meet
        columns = np.cumsum(n > 1) - 1
        both = np.zeros((len(sizes), len(sizes)))
        owner, place = owner[shared], columns[place[shared]]
        for at in range(0, int((n > 1).sum()), 1 << 14):  # some columns at a time keep the matrix small
            own = (place >= at) & (place < at + (1 << 14))
            matrix = np.zeros((len(sizes), min(1 << 14, int((n > 1).sum()) - at)), np.float32)
            matrix[owner[own], place[own] - at] = 1
            both += matrix @ matrix.T
        return both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9

    # What is compared grows with the documents, so it is never broadcast. Rows
    # that repeat go while the texts are still dealt by their keys, and sets are
    # made from them right before they are dealt by tile.
    texts = rows.select("k1", "k2", "body").join(needed.hint("merge"), ["k1", "k2"]).dropDuplicates(["k1", "k2"]).drop("k1", "k2")
    schema = T.StructType([*(f for f in texts.schema.fields if f.name != "body"), T.StructField("runs", T.ArrayType(T.LongType()))])
    hits = links(texts.mapInArrow(shingled, schema), linked)
    return with_components(found.select("ident", "k1", "k2", "node"), nodes, hits)


def jaccard_stage(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """The rows of docs with one document of each group of linked ones: that of the least id, of rows alike in id and text one.

    Documents without words all stay.
    """
    groups = saved(jaccard_links(docs, text=text, ident=ident), "groups")
    first = F.min(F.struct(F.col("ident").isNull().alias("null_id"), "ident", "k1", "k2")).alias("first")
    keepers = groups.where("root is not null").groupBy("root").agg(first).select("first.k1", "first.k2", F.lit(True).alias("single"))
    wordless = groups.where("root is null").select("k1", "k2", F.lit(False).alias("single")).distinct()
    kept = saved(keepers.union(wordless), "keepers")
    rows = docs.select(packed(docs), *key_pair(col(ident), col(text))).join(kept, ["k1", "k2"])
    same = W.partitionBy("k1", "k2").orderBy(F.xxhash64("doc"))
    return unpacked(rows.withColumn("n", F.row_number().over(same)).where("n = 1 or not single"), docs)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_links(read(spark, sf_dir, "documents")).select(
        F.col("ident").alias("doc_id"), F.col("component_id").alias("class_id"), "n_links", F.col("ident").eqNullSafe(F.col("component_id")).alias("kept")
    )
