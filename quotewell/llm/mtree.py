"""Exact top-k by inner product: best-first search in an M-tree of paged metric nodes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotewell.llm.common import col, read, saved, small_batches
from quotewell.llm.itq import finite

PIVOTS = 256  # routing objects below the root, at most
UNIT = 4096  # entries of a subtree, about; a task holds one
PAGE = 128  # entries of a leaf page, about
QUERIES = 4096  # queries a task searches a subtree for, about
_EPS = 1e-7  # bounds are compared with this relative slack; scores themselves are exact integers


def _metric(x: np.ndarray, ceiling: float) -> np.ndarray:
    """Vectors on the sphere of the greatest length: one more component fills each up to it.

    From a query whose last component is 0, the squared distance is
    |q|^2 + ceiling - 2 * inner product: the nearest have the highest scores.
    """
    x = x.astype(np.float64)
    return np.concatenate((x, np.sqrt(np.maximum(ceiling - (x * x).sum(axis=1), 0))[:, None]), axis=1)


def _rows(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def _paged(x: np.ndarray, n: int) -> np.ndarray:
    """A page for each row: n routing objects, each the row farthest from those before; rows go to the nearest."""
    at = 0
    near, page = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
    for i in range(n):
        d = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        page[d < near] = i
        near = np.minimum(near, d)
        at = int(near.argmax())
        if near[at] == 0:
            break
    return page


def build(classes: DataFrame, ceiling: float) -> tuple[DataFrame, DataFrame]:
    """The tree over classes (node, vec, ids): pages and subtrees.

    Objects go to the nearest of at most PIVOTS routing objects, which a fixed
    sample by hash supplies and every task can hold. What gathers at one of them
    is dealt by hash to as many subtrees as it takes, so that a task builds, and
    later searches, about UNIT entries however crowded a place is.

    pages: region, part (the subtree), parent (its routing object), pivot, radius (covering),
    to_parent (distance of pivot and parent), entries, own (distance of each
    entry to the pivot), ids. regions: region, parent, radius (covering all its
    subtrees), last (number of its last subtree).
    """
    spark = classes.sparkSession
    n = classes.count()
    sample = classes.orderBy(F.xxhash64(F.lit("pivot"), "node")).limit(max(1, min(PIVOTS, ceil(n / UNIT) * 4))).select("vec").toArrow()
    shared = spark.sparkContext.broadcast(_metric(_rows(sample.column("vec")), ceiling))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = _metric(_rows(pa.chunked_array([batch.column("vec")])), ceiling)
                yield batch.append_column("region", pa.array(_distances(x, shared.value).argmin(axis=1).astype(np.int32)))

    placed = saved(classes.mapInArrow(place, "node long, vec array<long>, ids array<long>, region int"), "placed")
    parts = saved(placed.groupBy("region").agg(F.ceil(F.count("*") / UNIT).alias("parts")), "region-parts")
    dealt = placed.join(F.broadcast(parts), "region").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))

    def page(table: pa.Table) -> pa.Table:
        x = _rows(table.column("vec"))
        m = _metric(x, ceiling)
        region, part = table.column("region")[0].as_py(), table.column("part")[0].as_py()
        parent = shared.value[region]
        pages, ids, out = _paged(m, ceil(len(m) / PAGE)), table.column("ids").combine_chunks(), []
        for p in np.unique(pages):
            at = np.flatnonzero(pages == p)
            pivot = m[at[0]]
            own = np.sqrt(((m[at] - pivot) ** 2).sum(axis=1))
            out.append((region, part, parent.tolist(), pivot.tolist(), float(own.max()), float(np.sqrt(((pivot - parent) ** 2).sum())), x[at].ravel().tolist(), own.tolist(), ids.take(pa.array(at)).to_pylist()))
        names = ["region", "part", "parent", "pivot", "radius", "to_parent", "entries", "own", "ids"]
        return pa.table(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)), schema=pa.schema([
            ("region", pa.int32()), ("part", pa.int32()), ("parent", pa.list_(pa.float64())), ("pivot", pa.list_(pa.float64())), ("radius", pa.float64()),
            ("to_parent", pa.float64()), ("entries", pa.list_(pa.int64())), ("own", pa.list_(pa.float64())), ("ids", pa.list_(pa.list_(pa.int64())))]))

    kinds = "region int, part int, parent array<double>, pivot array<double>, radius double, to_parent double, entries array<long>, own array<double>, ids array<array<long>>"
    pages = saved(dealt.select("region", "part", "vec", "ids").groupBy("region", "part").applyInArrow(page, kinds), "pages")
    regions = pages.groupBy("region").agg(F.first("parent").alias("parent"), F.max(F.col("to_parent") + F.col("radius")).alias("radius"), F.max("part").alias("last"))
    return pages, saved(regions, "regions")


def _merged(best: list[np.ndarray], found: list[list[np.ndarray]], k: int) -> list[np.ndarray]:
    """query, score, id of the k best answers of each query, ties to the smaller id, ordered by query."""
    query, score, ident = (np.concatenate([b, *parts]) for b, parts in zip(best, zip(*found, strict=True), strict=True))
    order = np.lexsort((ident, -score, query))
    query, score, ident = query[order], score[order], ident[order]
    first = np.r_[True, query[1:] != query[:-1]]
    place = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
    return [x[place < k] for x in (query, score, ident)]


def _search(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The function that searches one subtree for a block of queries.

    Each query takes its pages nearest bound first and ends at the first one
    beyond its limit. All queries take a step together, so that those which are
    at one page meet its entries in one matrix product.
    """

    def run(tree: pa.Table, asked: pa.Table) -> pa.Table:
        best = [np.empty(0, np.int64)] * 3
        queries = asked.column("query_id").to_numpy()
        if len(tree) and len(asked):
            parent, pivots = np.array(tree.column("parent")[0].as_py()), _rows(tree.column("pivot"))
            radius, to_parent = tree.column("radius").to_numpy(), tree.column("to_parent").to_numpy()
            width, ceiling = pivots.shape[1] - 1, float((parent * parent).sum())
            q = _rows(asked.column("vec"))
            target = np.concatenate((q.astype(np.float64), np.zeros((len(q), 1))), axis=1)
            offset = (target * target).sum(axis=1) + ceiling
            # no partial sum of a score exceeds the product of both lengths, up to which doubles hold whole numbers
            kind = np.float64 if offset.max() < 2.0**52 else np.int64
            q = q.astype(kind)
            entries = [np.array(e.values.to_numpy()).reshape(-1, width).astype(kind).T for e in tree.column("entries")]
            own = [e.values.to_numpy() for e in tree.column("own")]
            ids = [(e.values.flatten().to_numpy(), np.diff(e.values.offsets.to_numpy())) for e in tree.column("ids")]
            unknown = np.iinfo(np.int64).min
            least = np.array(asked.column("worst").fill_null(unknown).to_numpy())  # scores that must be reached

            def limit(rows: np.ndarray) -> np.ndarray:
                reach = np.sqrt(np.maximum(offset[rows] - 2.0 * least[rows], 0)) * (1 + _EPS) + _EPS
                return np.where(least[rows] == unknown, np.inf, reach)

            every = np.arange(len(q))
            to_query = np.sqrt(((target - parent) ** 2).sum(axis=1))
            # By the triangle inequality with stored distances, before any distance to a pivot is computed.
            opened = np.abs(to_query[:, None] - to_parent) - radius <= limit(every)[:, None]
            d = np.full(opened.shape, np.inf)
            for p in range(len(pivots)):
                rows = np.flatnonzero(opened[:, p])
                d[rows, p] = np.sqrt(((target[rows] - pivots[p]) ** 2).sum(axis=1))
            bounds = d - radius
            order, active = np.argsort(bounds, axis=1, kind="stable"), every
            for step in range(len(pivots)):
                page = order[active, step]
                go = bounds[active, page] <= limit(active)
                active, page = active[go], page[go]
                found = []
                for p in np.unique(page):
                    rows = active[page == p]
                    reach = limit(rows)
                    near = np.flatnonzero((own[p] >= (d[rows, p] - reach).min()) & (own[p] <= (d[rows, p] + reach).max()))
                    scores = q[rows] @ entries[p][:, near]
                    floor = least[rows].astype(kind)
                    if len(near) > k + 1:  # one of them may be the query itself
                        floor = np.maximum(floor, np.partition(scores, -k - 1, axis=1)[:, -k - 1])
                    row, entry = np.nonzero(scores >= floor[:, None])
                    named, copies = ids[p]
                    n = copies[near[entry]]
                    start = (np.cumsum(copies) - copies)[near[entry]]
                    at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    answer = [np.repeat(rows[row], n), np.repeat(scores[row, entry].astype(np.int64), n), named[at]]
                    other = answer[2] != queries[answer[0]]
                    found.append([x[other] for x in answer])
                if not found:
                    break
                if not any(len(x[0]) for x in found):
                    continue
                best = _merged(best, found, k)
                have = np.bincount(best[0], minlength=len(q))
                full = np.flatnonzero(have >= k)
                least[full] = np.maximum(least[full], best[1][np.cumsum(have)[full] - 1])
        return pa.table({"query_id": pa.array(queries[best[0]], pa.int64()), "vec_id": pa.array(best[2], pa.int64()), "score": pa.array(best[1], pa.int64())})

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, vector: str = "vec", ident: str = "vec_id") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of queries the k rows of vectors with the highest inner product, ties to the smaller id.

    Both have ident (long) and vector (array<long>, no nulls inside); vectors
    shorter than the longest end in zeros, so an empty one scores 0 with all. A
    row never finds its own id. Rows with a null id or vector take no part; a row
    that repeats in full counts once, and rows of one id with different vectors
    are one query (or answer) each, whose answers are ranked together under the
    id. With fewer than k others all are returned.

    Equal vectors are one entry with their k + 1 least ids, beyond which no id
    can be among the answers. Each query first searches the subtree of the
    routing object nearest to it; the k-th score it finds there bounds the
    second round, which visits just the subtrees whose covering radius reaches
    within the bound. Routing objects are at most PIVOTS, a fixed bound.
    """
    spark = vectors.sparkSession
    small_batches(spark, 4096)
    rows = vectors.select(col(ident).alias("vec_id"), col(vector).alias("vec")).where("vec_id is not null and vec is not null")
    asked = queries.select(col(ident).alias("query_id"), col(vector).alias("vec")).where("query_id is not null and vec is not null")
    width = max(1, *[x.agg(F.max(F.size("vec"))).first()[0] or 0 for x in (rows, asked)])
    even = F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vec")))
    rows, asked = (x.withColumn("vec", even).distinct() for x in (rows, asked))
    found = saved(rows.withColumn("node", F.xxhash64("vec")), "vectors")
    asked = saved(asked.withColumn("query", F.xxhash64("query_id", "vec")), "queries")
    ceiling = found.agg(F.max(F.aggregate("vec", F.lit(0).cast("long"), lambda s, x: s + x * x))).first()[0]
    if ceiling is None or asked.limit(1).count() == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    least = W.partitionBy("node").orderBy("vec_id")
    few = found.select("node", "vec_id").withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1).groupBy("node").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = saved(found.dropDuplicates(["node"]).select("node", "vec").join(few, "node").select("node", "vec", "ids"), "vector-classes")
    pages, regions = build(classes, float(ceiling))
    blocks = max(1, ceil(asked.count() / QUERIES))
    table = sorted((r.asDict() for r in regions.collect()), key=lambda r: r["region"])
    shared = spark.sparkContext.broadcast((np.array([r["parent"] for r in table]), np.array([r["radius"] for r in table]), np.array([r["region"] for r in table], np.int32)))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each query the regions, nearest lower bound first, with that bound."""
        parents, radii, numbers = shared.value
        for batch in batches:
            if len(batch):
                q = _rows(pa.chunked_array([batch.column("vec")])).astype(np.float64)
                d = _distances(np.concatenate((q, np.zeros((len(q), 1))), axis=1), parents)
                bounds = np.maximum(d - radii, 0)
                order = np.lexsort((d, bounds), axis=1)
                yield batch.append_column("regions", pa.array(numbers[order].tolist(), pa.list_(pa.int32()))).append_column("bounds", pa.array(np.take_along_axis(bounds, order, 1).tolist(), pa.list_(pa.float64())))

    aimed = saved(asked.mapInArrow(reach, "query_id long, vec array<long>, query long, regions array<int>, bounds array<double>"), "aimed")
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block")

    def searched(where: DataFrame, name: str) -> DataFrame:
        """Subtrees go to the blocks of queries that ask for them, to no others."""
        by = ["region", "part", "block"]
        where = saved(where.select("query_id", "vec", "worst", *by), f"{name}-asked")
        wanted = saved(pages.join(where.select(*by).distinct(), ["region", "part"]), f"{name}-pages")
        answers = wanted.groupBy(*by).cogroup(where.groupBy(*by)).applyInArrow(_search(k), "query_id long, vec_id long, score long")
        return saved(answers, name)

    home = aimed.select("query_id", "vec", F.col("regions")[0].alias("region"), F.lit(0).alias("part"), F.lit(None).cast("long").alias("worst"), block)
    first = searched(home, "first-answers")
    bound = first.groupBy("query_id").agg(F.min("score").alias("worst"), F.count("*").alias("n")).select("query_id", F.when(F.col("n") >= k, F.col("worst")).alias("worst"))
    squared = F.aggregate("vec", F.lit(0).cast("long"), lambda s, x: s + x * x) + F.lit(float(ceiling)) - 2 * F.col("worst")
    limit = F.when(F.col("worst").isNotNull(), F.sqrt(F.greatest(squared, F.lit(0.0))) * (1 + _EPS) + _EPS)
    reached = aimed.join(saved(bound, "bounds"), "query_id", "left").withColumn("limit", limit).select(
        "query_id", "vec", "worst", "limit", block, F.explode(F.arrays_zip("regions", "bounds")).alias("r")
    ).where(F.col("limit").isNull() | (F.col("r.bounds") <= F.col("limit")))
    first_region = home.select("query_id", F.col("region").alias("home"))
    rest = reached.select("query_id", "vec", "worst", "block", F.col("r.regions").alias("region")).join(F.broadcast(regions.select("region", "last")), "region")
    rest = rest.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("last")))).join(first_region, "query_id").where((F.col("region") != F.col("home")) | (F.col("part") > 0))
    answers = first.union(searched(rest, "more-answers"))
    ranked = answers.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("long"))
    vectors = read(spark, sf_dir, "embeddings").where(finite("embedding")).select("vec_id", whole.alias("vec"))
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))
