"""Links between members of shared buckets, and the components they form.

A node is a class of equal items; its weight is their number. Nodes come with
the buckets they fell into; nodes that share a bucket are compared, and only
sums and spanning edges leave a task, never pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.llm.common import saved, small_batches

CHUNK = 256  # nodes of a large bucket that meet those of another chunk in one tile
GROUP_ROWS = 512  # rows of small buckets handled together


def distinct_buckets(members: DataFrame) -> DataFrame:
    """members (node, bucket) without buckets of one node and without those that hold the same nodes as another.

    The same nodes meet only once then, however many hash tables agree on them.
    """
    members = saved(members.select("node", "bucket").distinct(), "members")
    marks = [F.bit_xor(F.xxhash64("node")).alias("m1"), F.bit_xor(F.xxhash64(F.lit("second"), "node")).alias("m2")]
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"), *marks).where("size > 1")
    kept = saved(sizes.groupBy("size", "m1", "m2").agg(F.min("bucket").alias("bucket")).select("bucket", "size"), "buckets")
    return saved(members.join(kept, "bucket"), "bucket-members")


def tile_plan(members: DataFrame) -> DataFrame:
    """node, buckets (in order) and tiles of every node: the comparisons it takes part in.

    members: node, bucket, size (from distinct_buckets). A bucket of more than
    CHUNK nodes is cut into chunks by hash and every pair of chunks is one tile,
    so no task holds a whole bucket. home names the group of tiles that is
    handled together: a tile of a large bucket alone, small buckets in groups.
    """
    chunks = F.ceil(F.col("size") / CHUNK)
    own = F.pmod(F.xxhash64("node", "bucket"), chunks)
    groups = F.lit(max(1, members.where(F.col("size") <= CHUNK).count() // GROUP_ROWS))
    home = F.when(F.col("size") > CHUNK, F.xxhash64("bucket", "a", "b")).otherwise(F.pmod(F.xxhash64("bucket"), groups))
    tiles = (
        members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
        .withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))
        .select("node", F.struct(home.alias("home"), "bucket", "a", "b", "own").alias("tile"))
    )
    return tiles.groupBy("node").agg(
        F.array_sort(F.collect_set("tile.bucket")).alias("buckets"), F.collect_list("tile").alias("tiles")
    )


def links(rows: DataFrame, linked: Callable[[pa.Table], np.ndarray]) -> DataFrame:
    """node, root, links: for each tile a node is compared in and has links in, the least node it hangs together with there, and the summed weight of its partners.

    rows: one per node with weight, buckets and tiles (from tile_plan), and what
    linked(table) needs, which gives the symmetric matrix of links of the nodes
    in a table of such rows. A pair that shares several buckets counts only in
    the one with the least number. What rows carry is dealt once, by tile.
    """
    small_batches(rows.sparkSession)
    rows = rows.select(*[c for c in rows.columns if c != "tiles"], F.explode("tiles").alias("tile")).select("*", "tile.*").drop("tile")

    def compare(table: pa.Table) -> pa.Table:
        order = table.select(["bucket", "a", "b", "node"]).append_column("at", pa.array(np.arange(len(table)))).sort_by([("bucket", "ascending"), ("a", "ascending"), ("b", "ascending"), ("node", "ascending")])
        table = table.take(order.column("at"))
        bucket, a, b, own = (table.column(c).to_numpy() for c in ("bucket", "a", "b", "own"))
        node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        change = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)) + 1
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for start, stop in zip([0, *change], [*change, len(table)], strict=True):
            if stop - start < 2:
                continue
            tile = table.slice(start, stop - start)
            matrix = np.triu(linked(tile), 1)
            if a[start] != b[start]:
                side = own[start:stop]
                matrix &= side[:, None] != side[None, :]
            x, y = np.nonzero(matrix)
            if not len(x):
                continue
            shared = [frozenset(v) for v in tile.column("buckets").to_pylist()]
            first = np.fromiter((min(shared[i] & shared[j]) == bucket[start] for i, j in zip(x, y, strict=True)), bool, len(x))
            x, y = x[first], y[first]
            if not len(x):
                continue
            sums = np.zeros(stop - start, np.int64)
            np.add.at(sums, x, weight[start + y])
            np.add.at(sums, y, weight[start + x])
            root = np.arange(stop - start)  # places are in node order, so the least place is the least node
            while True:
                low = root.copy()
                np.minimum.at(low, x, root[y])
                np.minimum.at(low, y, root[x])
                low = np.minimum(low, low[low])
                if (low == root).all():
                    break
                root = low
            have = np.flatnonzero(sums)
            out.append((node[start + have], node[start + root[have]], sums[have]))
        parts = [np.concatenate([o[i] for o in out]) if out else np.empty(0, np.int64) for i in range(3)]
        return pa.table({"node": pa.array(parts[0], pa.int64()), "root": pa.array(parts[1], pa.int64()), "links": pa.array(parts[2], pa.int64())})

    return saved(rows.groupBy("home").applyInArrow(compare, "node long, root long, links long"), "links")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node it is connected with) for all nodes of the edges (node, root).

    Every node takes the least label among its neighbours, then the label of its
    label, until nothing changes. Each round is written out.
    """
    both = saved(edges.select("node", "root").union(edges.select(F.col("root").alias("node"), F.col("node").alias("root"))).where("node <> root").distinct(), "edges")
    labels = saved(both.groupBy("node").agg(F.min("root").alias("low")).select("node", F.least("node", "low").alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("root"), F.col("root").alias("label")), "root").groupBy("node").agg(F.min("label").alias("low"))
        near = saved(near, "near")
        lower = saved(labels.join(near, "node").select("node", F.least("root", "low").alias("root"), F.col("root").alias("was")), "lower")
        jumped = lower.join(lower.select(F.col("node").alias("root"), F.col("root").alias("label")), "root").select("node", F.col("label").alias("root"), "was")
        jumped = saved(jumped, "labels")
        if not jumped.where("root <> was").limit(1).count():
            return jumped.select("node", "root")
        labels = jumped.select("node", "root")
