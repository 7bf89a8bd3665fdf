"""Near-duplicate vectors: balanced binary codes by iterative quantisation, multi-index Hamming tables, exact rerank."""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.llm.common import col, read, saved, small_batches
from quotewell.llm.links import components, distinct_buckets, links, tile_plan

SAMPLE = 4096  # vectors the rotations are fitted on
BITS = 64  # of one rotation, at most
ROUNDS = 30
EXPECTED = 64  # vectors of unrelated content that share a table entry with a vector, about
RECALL = 0.995  # measured on pairs at the threshold
PROBE = 4  # rotations the bits of a key are chosen by
ENOUGH = 200  # with fewer pairs of the sample at the threshold only those made for it are measured


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors of length 1 as rows; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(column)), lengths), np.concatenate([np.arange(n) for n in lengths] or [np.empty(0, int)]).astype(int)] = values
    return _unit(out)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), 1e-300)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def finite(vector: str) -> Column:
    """Not null, and all components finite numbers."""
    return F.coalesce(F.forall(col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def usable(vector: str) -> Column:
    """Finite and neither empty nor zero."""
    return finite(vector) & F.exists(col(vector), lambda x: x != 0)


def fit_rotations(x: np.ndarray, n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """mean and n projections side by side: principal directions, turned so that signs lose least (iterative quantisation), each from another start."""
    mean = x.mean(axis=0)
    centred = x - mean
    _, vectors = np.linalg.eigh(centred.T @ centred)
    top = vectors[:, ::-1][:, :BITS]
    v, out = centred @ top, []
    random = np.random.default_rng(seed)
    for _ in range(n):
        turn, _ = np.linalg.qr(random.standard_normal((top.shape[1], top.shape[1])))
        for _ in range(ROUNDS):
            u, _, w = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
            turn = (u @ w).T
        out.append(top @ turn)
    return mean, np.concatenate(out, axis=1)


def tables_for(n: int, threshold: float) -> tuple[int, int]:
    """Bits of a table's key, at most, and number of tables for n vectors whose mean is zero.

    A bit of two such vectors at the threshold differs with probability angle / pi; plan_tables() measures it.
    """
    bits = max(4, round(log2(max(n, 2) / EXPECTED)))
    meet = (1 - acos(threshold) / pi) ** bits
    return bits, ceil(log(1 - RECALL) / log(1 - meet))


def pairs_at(x: np.ndarray, threshold: float, seed: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs at the threshold to measure recall on, kind by kind, as two matrices of their vectors.

    The second vector of a pair is spread about the mean as the rows are, or lies
    in any direction from the first. The rows' own pairs up to 0.02 above the
    threshold come third, if there are ENOUGH. Where unrelated rows are linked
    already, the pairs of the first kind are unrelated.
    """
    random = np.random.default_rng(seed)
    mean = x.mean(axis=0)
    own = x - mean
    other = own[random.permutation(len(x))]
    low, high = np.zeros((len(x), 1)), np.ones((len(x), 1))
    for _ in range(40):
        mid = (low + high) / 2
        linked = (x * _unit(mean + mid * own + np.sqrt(1 - mid * mid) * other)).sum(axis=1, keepdims=True) >= threshold
        low, high = np.where(linked, low, mid), np.where(linked, mid, high)
    away = random.standard_normal(x.shape)
    away = _unit(away - (away * x).sum(axis=1, keepdims=True) * x)
    kinds = [(x, _unit(mean + high * own + np.sqrt(1 - high * high) * other)), (x, threshold * x + np.sqrt(max(1 - threshold * threshold, 0)) * away)]
    found, step = [], 512
    for at in range(0, len(x), step):
        cosines = x[at : at + step] @ x.T
        i, j = np.nonzero((cosines >= threshold) & (cosines < threshold + 0.02))
        found.append(np.stack([i + at, j])[:, i + at < j])
    i, j = np.concatenate(found, axis=1)
    if len(i) >= ENOUGH:
        chosen = random.permutation(len(i))[:SAMPLE]
        kinds.append((x[i[chosen]], x[j[chosen]]))
    return kinds


def plan_tables(x: np.ndarray, n: int, threshold: float) -> tuple[np.ndarray, np.ndarray, int, int]:
    """mean, projections, bits of a key and number of tables for n vectors like those of the sample x.

    How often a bit of two vectors at the threshold agrees depends on the rows:
    the more their mean has of their length, the less it does. It is measured
    on pairs_at(); the bits that make the fewest comparisons are taken, and
    tables are added until every kind of pairs meets with RECALL. Where tables
    would take as much as comparing all vectors, there is one table without
    bits and all are compared.
    """
    kinds = pairs_at(x, threshold)
    size = min(BITS, x.shape[1])
    mean, projection = fit_rotations(x, PROBE)

    def agreeing(turn: np.ndarray) -> list[np.ndarray]:
        return [((a - mean) @ turn >= 0) == ((b - mean) @ turn >= 0) for a, b in kinds]

    def most(bits: int) -> int:
        return int(n / (EXPECTED + n / 2**bits))

    shares = [same.mean(axis=1) for same in agreeing(projection)]
    plans = []
    for bits in range(4, tables_for(n, threshold)[0] + 1):
        low, high = 0, most(bits) + 1
        while high - low > 1:
            mid = (low + high) // 2
            enough = all((1 - (1 - p**bits) ** mid).mean() >= RECALL for p in shares)
            low, high = (low, mid) if enough else (mid, high)
        if high <= most(bits):
            plans.append((high * (EXPECTED + n / 2**bits), bits, high))
    if plans:
        _, bits, tables = min(plans)
        while tables <= most(bits):
            mean, projection = fit_rotations(x, ceil(bits * tables / size))
            projection = projection[:, : bits * tables]
            if all(_meet(same, bits) >= RECALL for same in agreeing(projection)):
                return mean, projection, bits, tables
            tables += max(1, tables // 8)
    return mean, projection[:, :0], 0, 1


def _meet(same: np.ndarray, bits: int) -> float:
    """Share of pairs that agree in all bits of a table, given whether they agree in each bit."""
    return float(same.reshape(len(same), -1, bits).all(axis=2).any(axis=1).mean())


def vector_links(vectors: DataFrame, threshold: float = 0.9, vector: str = "embedding", ident: str = "vec_id") -> DataFrame:
    """ident, n_links, component_id (least ident reachable by links, its own included), one row per row of vectors.

    Links are pairs of cosine >= threshold, computed in double precision from
    the original vectors; pairs are looked for among vectors whose codes agree
    in one of the tables, as many as plan_tables() finds to be needed. Vectors that are null, empty or zero, or hold null or
    non-finite components, link with nothing. A vector shorter than the longest
    counts as ending in zeros. Equal vectors are one node with a weight, so a
    vector of any number of copies is compared once. Null ids link but do not
    name a component unless all of its ids are null.
    """
    spark = vectors.sparkSession
    small_batches(spark, 4096)
    rows = vectors.select(col(ident).alias("ident"), F.when(usable(vector), col(vector)).alias("vec"))
    found = saved(rows.withColumn("node", F.when(F.col("vec").isNotNull(), F.xxhash64("vec"))), "vectors")
    nodes = saved(found.where("node is not null").groupBy("node").agg(F.count("*").alias("weight"), F.min("ident").alias("least"), F.first("vec").alias("vec")), "vector-classes")
    n, width = nodes.agg(F.count("*"), F.max(F.size("vec"))).first()
    if n:
        sample = nodes.select("vec").orderBy(F.xxhash64(F.lit("sample"), "node")).limit(SAMPLE).toArrow()
        mean, projection, bits, tables = plan_tables(_matrix(sample.column("vec"), width), n, threshold)
        shared = spark.sparkContext.broadcast((mean, projection))

        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centre, turn = shared.value
            for batch in batches:
                signs = (_matrix(batch.column("vec"), width) - centre) @ turn >= 0
                values = signs.reshape(len(signs), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))
                numbers = values + (np.arange(tables, dtype=np.int64) << bits)
                offsets = np.arange(0, numbers.size + 1, tables, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers.ravel()))], names=["node", "buckets"])

        members = nodes.select("node", "vec").mapInArrow(keys, "node long, buckets array<long>").select("node", F.explode("buckets").alias("bucket"))

        def linked(table: pa.Table) -> np.ndarray:
            x = _matrix(table.column("vec"), width)
            return x @ x.T >= threshold

        hits = links(nodes.select("node", "weight", "vec").join(tile_plan(distinct_buckets(members)), "node"), linked)
    else:
        hits = spark.createDataFrame([], "node long, root long, links long")
    return with_components(found, nodes, hits)


def with_components(found: DataFrame, nodes: DataFrame, hits: DataFrame) -> DataFrame:
    """n_links, component_id and root (the component's least node) of every row of found (ident, node, ...) from the links of its node."""
    roots = components(hits)
    sums = hits.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "weight", "least").join(roots, "node", "left").join(sums, "node", "left")
    known = saved(known.select("node", "weight", "least", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "nodes")
    names = saved(known.groupBy("root").agg(F.min("least").alias("name")), "names")
    known = saved(known.join(names, "root").select("node", "root", "name", (F.col("links") + F.col("weight") - 1).alias("n_links")), "named")
    return found.join(known, "node", "left").select(
        *[c for c in found.columns if c not in ("node", "vec")], F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("node").isNull(), F.col("ident")).otherwise(F.col("name")).alias("component_id"), "root",
    )


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links(read(spark, sf_dir, "embeddings")).select(
        F.col("ident").alias("vec_id"), "n_links", F.col("component_id").cast("long").alias("component_id"), F.col("ident").eqNullSafe(F.col("component_id")).alias("kept")
    )
