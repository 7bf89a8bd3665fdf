from fractions import Fraction
from math import floor, isclose, isfinite

import numpy as np
import pytest

from quotewell.llm.whitening import scatter_of, whiten

SCHEMA = "vec_id long, embedding array<double>, label int, x string, ident string, found string, at string, dim string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, *["z"] * 5) for i, v in rows], SCHEMA).repartition(3)


def plain(rows, components=4, scale=256):
    """id, deviation per row, covariance (exact), and the fit list."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and isfinite(c) for c in v)]
    width = max((len(v) for _, v in good), default=0)
    xs = [(i, tuple(floor(scale * c) for c in [*v, *[0.0] * (width - len(v))])) for i, v in good]
    fit = sorted({x for _, x in xs})
    n, sums = len(fit), [sum(x[d] for x in fit) for d in range(width)]
    mean = [Fraction(s, n) for s in sums]
    cov = [[sum((x[a] - mean[a]) * (x[b] - mean[b]) for x in fit) / n for b in range(width)] for a in range(width)]
    dev = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))) for i, x in xs]
    return xs, fit, dev, np.array([[float(c) for c in row] for row in cov]), np.array([float(m) for m in mean])


def check(spark, rows, components=4):
    xs, fit, dev, cov, mean = plain(rows)
    got = whiten(table(spark, rows), components).collect()
    top = min(components, len(mean))
    assert len(got) == len(xs) * top and {r.n for r in got} == {len(fit)}
    assert sorted((str(r.ident), int(r.deviation)) for r in got if r.component == 1) == sorted((str(i), d) for i, d in dev)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    for k in range(top):
        mine = sorted((str(r.ident), r.whitened) for r in got if r.component == k + 1)
        assert all(isclose(r.explained, values[k] / np.trace(cov), rel_tol=1e-9) for r in got if r.component == k + 1)
        want = sorted((str(i), float((np.array(x, float) - mean) @ vectors[:, k] / np.sqrt(values[k]))) for i, x in xs)
        flipped = sorted((i, -w) for i, w in want)
        assert any(np.allclose([w for _, w in mine], [w for _, w in side], atol=1e-7) for side in (want, flipped))
    assert {r.identity_error for r in got} and all(r.identity_error < 1e-8 for r in got)


def test_against_plain(spark):
    random = np.random.default_rng(1)
    base = random.standard_normal((300, 6)) * [5, 3, 2, 1, 0.5, 0.2] + 3
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(400, None), (401, [None, 1.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (None, rows[0][1]), (0, rows[0][1]), (0, rows[1][1]), (404, [1.5]), (405, [])]
    rows += [(1000 + i, rows[5][1]) for i in range(200)]  # a hot vector counts once
    check(spark, rows)


def test_few_dimensions_and_negative_entries(spark):
    check(spark, [(i, [-float(i * i), i / 7]) for i in range(30)])


def test_great_entries_stay_exact(spark):
    check(spark, [(0, [1e12, -1e12]), (1, [1e12 + 3, 2.0]), (2, [5.0, 1e9]), (3, [-1e10, 7.0])])


def test_beyond_longs(spark):
    got = whiten(table(spark, [(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [0.0, 3.0])])).collect()
    assert len(got) == 6 and {r.n for r in got} == {3} and {r.identity_error < 1e-4 for r in got} == {True}


@pytest.mark.parametrize("rows,rest", [([], 0), ([(1, None), (2, [float("nan")])], 0), ([(1, []), (2, [])], 0), ([(1, [1.0, 2.0])], 2), ([(1, [1.0, 2.0]), (2, [1.0, 2.0])], 4)])
def test_tables_without_variance(spark, rows, rest):
    got = whiten(table(spark, rows)).collect()
    assert len(got) == rest and all((r.whitened, r.explained, r.identity_error, r.deviation) == (None, None, None, 0) for r in got)


def test_scatter_is_exact():
    random = np.random.default_rng(2)
    for low, high, kind in ((-300, 300, np.int64), (0, 1, np.int64), (-2**62, 2**62, object)):
        x = random.integers(low, high, (197, 5), endpoint=True)
        x[:, 3] = x[0, 3]
        base = x.min(axis=0)
        u = x.astype(object) - base.astype(object)
        got = scatter_of(x, base, [max(1, int(v).bit_length()) for v in u.max(axis=0)], kind)
        assert (np.triu(u.T.dot(u)) == got).all()
