"""Embedding whitening: exact covariance from bit planes packed across rows, then principal components of unit variance."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.llm.common import col, read, saved, small_batches
from quotewell.llm.itq import finite

SCALE = 256
COMPONENTS = 4
BATCH = 4096  # vectors handed to a worker at once
CELLS = 1 << 21  # bits unpacked at once, eight bytes each
LIMB = 62  # products are summed as two numbers, the low one of so many bits


def quantised(vector: str, width: int, scale: int = SCALE) -> Column:
    """floor(scale * entry) as longs, filled up with zeros to `width` entries. Beyond the range of long it is the nearest long."""
    x = F.transform(col(vector), lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    return F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(x))).alias("x")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _ranges(fit: DataFrame, width: int) -> tuple[int, list[int], list[int], list[int]]:
    """Number of vectors, and least entry, greatest entry and sum of each dimension."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high, total = 0, np.full(width, np.iinfo(np.int64).max), np.full(width, np.iinfo(np.int64).min), np.zeros(width, object)
        for batch in batches:
            x = _matrix(batch["x"], width)
            if len(x):
                n, low, high = n + len(x), np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
                total += (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(width)), pa.array(np.full(width, n)), pa.array(low), pa.array(high), pa.array([Decimal(int(v)) for v in total], pa.decimal128(38)),
            ], ["dim", "n", "low", "high", "total"])

    rows = (
        fit.mapInArrow(per_task, "dim long, n long, low long, high long, total decimal(38,0)").groupBy("dim")
        .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total")).orderBy("dim").collect()
    )  # one row a dimension
    return (rows[0].n if rows else 0), [r.low for r in rows], [r.high for r in rows], [int(r.total) for r in rows]


def scatter_of(x: np.ndarray, low: np.ndarray, bits: list[int], kind: type) -> np.ndarray:
    """Sum over the rows of x of u_i * u_j, u = x - low, exact: the upper triangle.

    Each bit of each dimension is one plane: a bit a row, packed into words. The
    product of two dimensions is the sum over their planes a and b of
    2^(a + b) times the number of rows that have both bits.
    """
    dims = len(bits)
    shifts = np.concatenate([np.arange(k) for k in bits]).astype(np.uint64)
    owner, starts = np.repeat(np.arange(dims), bits), np.concatenate([[0], np.cumsum(bits)[:-1]])
    weight = np.array([1 << int(s) for s in shifts], object).astype(kind)
    out = np.zeros((dims, dims), kind)
    step = max(64, CELLS // len(shifts) // 64 * 64)
    for first in range(0, len(x), step):
        u = (x[first:first + step].astype(np.uint64) - low.astype(np.uint64))
        flags = (u[:, owner] >> shifts) & np.uint64(1)
        flags = np.pad(flags.astype(bool), ((0, -len(u) % 64), (0, 0)))
        planes = np.ascontiguousarray(np.packbits(flags, axis=0).T).view(np.uint64)
        for p, dim in enumerate(owner):
            begin = starts[dim]
            both = np.bitwise_count(planes[p] & planes[begin:]).sum(axis=1, dtype=np.int64).astype(kind)
            out[dim, dim:] += weight[p] * np.add.reduceat(both * weight[begin:], starts[dim:] - begin)
    return out


def _scatter(fit: DataFrame, width: int, n: int, low: list[int], high: list[int]) -> list[list[int]]:
    bits = [max(1, int(b - a).bit_length()) for a, b in zip(low, high, strict=True)]
    kind = np.int64 if n << (2 * max(bits)) < 1 << 62 else object
    base = np.array(low, np.int64)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((width, width), kind), False
        for batch in batches:
            total, seen = total + scatter_of(_matrix(batch["x"], width), base, bits, kind), True
        if seen:
            i, j = np.triu_indices(width)
            values = [int(v) for v in total[i, j]]
            parts = [pa.array([Decimal(v) for v in limb], pa.decimal128(38)) for limb in ([v >> LIMB for v in values], [v & ((1 << LIMB) - 1) for v in values])]
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *parts], ["i", "j", "high", "low"])

    rows = fit.mapInArrow(per_task, "i long, j long, high decimal(38,0), low decimal(38,0)").groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    out = [[0] * width for _ in range(width)]
    for r in rows.toLocalIterator():  # dimensions squared, whatever the number of vectors
        out[r.i][r.j] = out[r.j][r.i] = (int(r.high) << LIMB) + int(r.low)
    return out


class Model:
    """Mean and principal components of the fit list. eigen falls; scale is 0 where a component has no variance."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, components: int):
        values, vectors = np.linalg.eigh(covariance)
        top = np.argsort(-values, kind="stable")[:components]
        self.n, self.sums, self.mean = n, sums, np.array([s / n for s in sums])
        self.eigen, vectors = np.maximum(values[top], 0), vectors[:, top]
        self.axes = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(top))] < 0, -1.0, 1.0)
        real = self.eigen > len(sums) * np.finfo(float).eps * max(self.eigen, default=0)
        self.scale = np.where(real, 1 / np.sqrt(np.where(real, self.eigen, 1)), 0)
        trace = float(np.trace(covariance))
        self.explained = [float(e / trace) if trace > 0 else None for e in self.eigen]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.float64) - self.mean) @ self.axes * self.scale

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - sum)^2, exact."""
        size = max([abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))])
        kind = np.int64 if len(self.sums) * size * max(size, *map(abs, self.sums)) < 1 << 62 else object
        x, sums = x.astype(kind), np.array(self.sums, object).astype(kind)
        squares, products, rest = (x * x).sum(axis=1), (x * sums).sum(axis=1), sum(s * s for s in self.sums)
        return [self.n * self.n * int(q) - 2 * self.n * int(c) + rest for q, c in zip(squares, products, strict=True)]


def fit_model(fit: DataFrame, width: int, components: int = COMPONENTS) -> Model | None:
    """The model of the vectors x of fit, None if there are none. Sums of integers are exact and centred before they become floating point."""
    n, low, high, sums = _ranges(fit, width)
    if not n:
        return None
    products, shifted = _scatter(fit, width, n, low, high), [s - n * a for s, a in zip(sums, low, strict=True)]
    covariance = np.array([[(n * products[i][j] - shifted[i] * shifted[j]) / (n * n) for j in range(width)] for i in range(width)])
    return Model(n, sums, covariance, components)


def identity_error(fit: DataFrame, width: int, model: Model) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity; None without a component of positive variance."""
    real = np.flatnonzero(model.scale)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(real), len(real)))
        for batch in batches:
            w = model.whiten(_matrix(batch["x"], width))[:, real]
            total += w.T @ w
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "v"])

    rows = fit.mapInArrow(per_task, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # components squared
    return max((abs(r.v / model.n - (r.i == r.j)) for r in rows), default=None)


OUT = "ident {}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, vector: str = "embedding", ident: str = "vec_id") -> DataFrame:
    """Coordinates of every vector along the leading principal components, each divided by its standard deviation.

    An entry c counts as floor(scale * c), a long. Rows whose vector is null or
    holds null or non-finite entries are left out; shorter vectors end in zeros;
    a table of empty vectors has no components and gives no rows, nor does an
    empty one. The model is fitted on each distinct vector once, however often
    it is repeated; repeated rows give rows each.

    Returns ident, component (from 1, by falling variance; fewer where there are
    fewer dimensions), n (distinct vectors), deviation (sum over dimensions of
    (n x - sum)^2, exact; null beyond 38 digits), whitened (null along a
    component without variance), explained (its share of all variance; null if
    there is none), identity_error.

    Distinct vectors are one aggregation with map-side combine. Sums and products
    leave a task as one row a pair of dimensions; the driver gets the totals,
    dimensions squared, and runs eigh on them.
    """
    spark = vectors.sparkSession
    good = vectors.where(finite(vector))
    kind = vectors.select(col(ident)).schema[0].dataType.simpleString()
    width = good.agg(F.max(F.size(col(vector)))).first()[0] or 0
    nothing = spark.createDataFrame([], OUT.format(kind))
    if not width:
        return nothing
    small_batches(spark, BATCH)
    rows = good.select(col(ident).alias("ident"), quantised(vector, width, scale))
    fit = saved(rows.select("x").distinct(), "fit")
    model = fit_model(fit, width, components)
    if model is None:
        return nothing
    error, n = identity_error(fit, width, model), model.n
    flat = [not s for s in model.scale]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["x"], width)
            whole = [Decimal(v) if v < 10**38 else None for v in model.deviations(x)]
            found = [[None if f else v for f, v in zip(flat, row, strict=True)] for row in model.whiten(x).tolist()]
            yield pa.RecordBatch.from_arrays([batch["ident"], pa.array(whole, pa.decimal128(38)), pa.array(found, pa.list_(pa.float64()))], ["ident", "deviation", "found"])

    shares = F.array(*[F.lit(e).cast("double") for e in model.explained])
    out = rows.mapInArrow(project, f"ident {kind}, deviation decimal(38,0), found array<double>").select("ident", "deviation", F.posexplode("found").alias("at", "whitened"))
    return out.select(
        "ident", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """deviation is null where it does not fit a long (from about 10^7 distinct vectors of 64 dimensions and length 1 on)."""
    return whiten(read(spark, sf_dir, "embeddings")).select(
        F.col("ident").alias("vec_id"), "component", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "whitened", "explained", "identity_error"
    )
