"""Operator 12 against numpy's eigenvectors and Python's integers."""

import math
import random

import numpy as np
import pytest

from sluice.llm.whitening import polar_factor, split, top_eigenvectors, whitened

SCHEMA = "vec_id bigint, embedding array<float>, id string, x binary, n string, component string"


def frame(spark, vectors, slices=3):
    rows = [(*(v if isinstance(v, tuple) else (i, v)), "x", None, "x", "x") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(slices) if rows else spark.createDataFrame([], SCHEMA)


def symmetric(seed, n, eigenvalues=None):
    r = np.random.default_rng(seed)
    q, _ = np.linalg.qr(r.normal(size=(n, n)))
    e = r.normal(size=n) if eigenvalues is None else np.array(eigenvalues, float)
    return (q * e) @ q.T


@pytest.mark.parametrize("n", [1, 2, 5, 40, 64])
def test_polar_factor_is_the_sign(n):
    a = symmetric(n, n)
    u = polar_factor(a)
    e, v = np.linalg.eigh(a)
    assert np.abs(u - (v * np.sign(e)) @ v.T).max() < 1e-12 / np.abs(e).min()
    assert np.abs(u @ u - np.eye(n)).max() < 1e-12


def test_polar_factor_of_nearly_singular_matrices():
    a = symmetric(3, 12, [1, -1, 1e-14, -1e-14, 0.5, 0.3, -0.2, 1e-8, -1e-8, 2, -2, 1e-3])
    u = polar_factor(a)
    assert np.abs(u @ u - np.eye(12)).max() < 1e-10


@pytest.mark.parametrize("seed", range(12))
def test_splits_are_invariant_subspaces(seed):
    a = symmetric(seed, 3 + 5 * seed)
    above, below = split(a)
    mean = np.trace(a) / len(a)
    assert np.abs(above.T @ a @ below).max() < 1e-12 * max(1, np.linalg.norm(a))
    assert (np.linalg.eigvalsh(above.T @ a @ above) > mean).all() and (np.linalg.eigvalsh(below.T @ a @ below) < mean).all()


@pytest.mark.parametrize(
    "eigenvalues",
    [None, [3, 2, 1], [2, 2, 2, 2], [1e6, 1, 1e-6, 0, 0], [5, 5, 1, 1, 0], list(range(64)), [0.1] * 63 + [9], [0, 0, 0]],
)
def test_eigenpairs_equal_numpy(eigenvalues):
    n = 64 if eigenvalues is None else len(eigenvalues)
    a = symmetric(n, n, eigenvalues)
    wanted = min(4, n)
    values, vectors = top_eigenvectors(a, wanted)
    scale = max(1.0, np.linalg.norm(a))
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:wanted]).max() < 1e-12 * scale
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * scale
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-12


def brute(vectors, scale=256, components=4):
    kept = []
    for i, v in enumerate(vectors):
        ident, v = v if isinstance(v, tuple) else (i, v)
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            kept.append((ident, tuple(math.floor(scale * float(np.float32(c))) for c in v)))
    fit = sorted({x for _, x in kept})
    n, d = len(fit), len(fit[0])
    sums = [sum(col) for col in zip(*fit)]
    y = np.array([[c - s / n for c, s in zip(x, sums)] for x in fit])
    v = y.T @ y / n
    e, vec = np.linalg.eigh(v)
    e, vec = e[::-1][:components], vec[:, ::-1][:, :components]
    out = {}
    for ident, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        w = np.array([c - s / n for c, s in zip(x, sums)]) @ vec / np.sqrt(e)
        for k in range(len(e)):
            out.setdefault((ident, k + 1), []).append((n, deviation, w[k], e[k] / np.trace(v)))
    return out


def embeddings(seed, n, d):
    r = random.Random(seed)
    return [[r.gauss(0, 1 / (1 + k)) + 0.3 for k in range(d)] for _ in range(n)]


@pytest.mark.parametrize("n, d", [(60, 6), (200, 64), (30, 2)])
def test_whitening_equals_numpy(spark, n, d):
    nan, inf = float("nan"), float("inf")
    data = embeddings(n, n, d)
    data += [None, [nan] * d, [0.0] * (d - 1) + [inf], [None] * d, (5, data[5]), (5, data[5]), (None, data[6])]
    got = whitened(frame(spark, data))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows, want = got.collect(), brute(data)
    assert len(rows) == sum(map(len, want.values())) and {r.n for r in rows} == {n}
    sign = {}
    for r in rows:
        size, deviation, value, explained = want[r.vec_id, r.component][0]
        assert (r.n, r.deviation) == (size, deviation) and abs(r.explained / explained - 1) < 1e-9
        if abs(value) > 1e-6:
            sign.setdefault(r.component, math.copysign(1, value * r.whitened))
        assert abs(r.whitened - sign.get(r.component, 1) * value) < 1e-8
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_few_vectors_and_flat_directions(spark):
    assert whitened(frame(spark, [])).collect() == []
    assert whitened(frame(spark, [None, []])).collect() == []
    assert whitened(frame(spark, [[1.0, 2.0]] * 5)).collect() == []
    line = whitened(frame(spark, [[float(i), 2.0 * i, 1.0] for i in range(10)])).collect()
    assert len(line) == 10 and {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12


def test_different_lengths_fail(spark):
    with pytest.raises(Exception, match="different lengths"):
        whitened(frame(spark, [[1.0, 2.0], [1.0], [3.0, 1.0]], slices=1)).collect()


def test_large_entries(spark):
    data = [[float((i * 37 % 11) << 22), float(i << 20), 1.0] for i in range(40)]
    got = whitened(frame(spark, data), deviation_text=True).collect()
    want = brute(data)
    for r in got:
        deviation = want[r.vec_id, r.component][0][1]
        assert r.deviation_text == str(deviation) and r.deviation == (deviation if deviation < 1 << 63 else None)
    assert any(r.deviation is None for r in got)
