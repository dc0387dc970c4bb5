"""Operator 11 against plain integer arithmetic, vector by vector."""

import hashlib
import math
import random

import numpy as np
import pytest

from sluice.llm.bitplanes import cluster_vectors, dot_products, nearest, pack_planes, planes_of, unpack_planes

SCHEMA = "vec_id bigint, embedding array<double>, id string, planes string, cluster string, n int"


def frame(spark, vectors, first=0, slices=3):
    rows = [(*(v if isinstance(v, tuple) else (i, v)), "x", "x", "x", 1) for i, v in enumerate(vectors, first)]
    return spark.createDataFrame(rows, SCHEMA).repartition(slices) if rows else spark.createDataFrame([], SCHEMA)


def brute(vectors, k, rounds, width, scale, seed):
    """Lists of integers; distances and means by Python's own integers."""
    kept = []
    for i, v in enumerate(vectors):
        ident, v = v if isinstance(v, tuple) else (i, v)
        if v is None or len(v) != width or any(c is None or not math.isfinite(c) for c in v):
            continue
        name = hashlib.sha256(f"{seed}:{'null' if ident is None else ident}".encode()).hexdigest()
        kept.append((name, ident, [math.floor(scale * c) for c in v]))
    centroids = [x for _, _, x in sorted(kept, key=lambda r: r[0])[:k]]

    def assign():
        out = []
        for _, _, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        near = assign()
        for c in range(len(centroids)):
            own = [x for (_, _, x), (n, _) in zip(kept, near) if n == c]
            if own:
                centroids[c] = [sum(col) // len(own) for col in zip(*own)]
    near = assign()
    total = sum(d for _, d in near)
    out = []
    for (_, ident, _), (c, d) in zip(kept, near):
        digest = hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
        out.append((ident, c, d, sum(e for m, e in near if m == c), total, digest))
    return out


def test_planes_hold_integers():
    r = np.random.default_rng(1)
    for top in (1, 2, 300, 1 << 26):
        x = r.integers(-top, top, (50, 64))
        x[0], x[1], x[2] = 0, -top, top - 1
        packed = pack_planes(x)
        assert len({len(p) for p in packed}) > 1 or top == 1
        for rows, planes in planes_of(packed, 1):
            assert (unpack_planes(planes, 64) == x[rows]).all()


def test_dot_products_and_distances_are_exact():
    r = np.random.default_rng(2)
    for width in (64, 100):
        x, c = r.integers(-(1 << 26), 1 << 26, (30, width)), r.integers(-(1 << 20), 1 << 20, (7, width))
        for rows, planes in planes_of(pack_planes(x), -(-width // 64)):
            for crows, cplanes in planes_of(pack_planes(c), -(-width // 64)):
                want = [[sum(int(a) * int(b) for a, b in zip(x[i], c[j])) for j in crows] for i in rows]
                assert dot_products(planes, cplanes).tolist() == want
            cluster, distance = nearest(planes, c, width)
            want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x[i], y)) for y in c] for i in rows]
            assert distance.tolist() == [min(w) for w in want] and cluster.tolist() == [w.index(min(w)) for w in want]


def vectors(seed, n, width):
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(width)] for _ in range(5)]
    return [[c + r.gauss(0, 0.2) for c in r.choice(centres)] for _ in range(n)]


@pytest.mark.parametrize("k, rounds, n", [(6, 4, 120), (40, 2, 25), (3, 0, 40), (1, 2, 10)])
def test_equals_plain_integers(spark, k, rounds, n):
    data = vectors(k, n, 64)
    nan, inf = float("nan"), float("inf")
    data += [None, [], [0.0] * 63, [0.0] * 65, [nan] * 64, [0.0] * 63 + [inf], [0.0] * 63 + [None]]
    data += [(3, data[3]), (3, data[3]), (None, data[4]), [0.0] * 64, [-0.0] * 64]
    got = cluster_vectors(frame(spark, data), k=k, rounds=rounds)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(data, k, rounds, 64, 256, 2), key=repr)


def test_other_widths_and_a_hot_cluster(spark):
    data = [[1.0] * 70] * 300 + vectors(9, 30, 70)
    got = cluster_vectors(frame(spark, data), k=5, rounds=3, width=70, scale=16, seed=7)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(data, 5, 3, 70, 16, 7), key=repr)


def test_empty_and_too_large(spark):
    assert cluster_vectors(frame(spark, [])).collect() == []
    assert cluster_vectors(frame(spark, [None, [1.0]])).collect() == []
    with pytest.raises(Exception, match="fit a long"):
        cluster_vectors(frame(spark, [[1e12] * 64])).collect()
