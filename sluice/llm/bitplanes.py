"""Centroid clustering by bit planes (operator 11).

A component becomes the integer ``floor(scale * x)``.  Of a vector's integers in two's
complement, plane ``b`` holds bit ``b`` of 64 components in one 64-bit word; the last
plane has the weight ``-2**b``.  The dot product of two vectors is the sum over their
planes of weight times weight times the number of bits set in both, so that distances
``|x|^2 - 2 x.c + |c|^2`` are exact integers.  A vector keeps as many planes as its
largest component needs.

The planes are written once to the shared folder and every round reads them: a task
assigns its vectors to the nearest centroid and sums them by centroid; the shuffle
carries one row per task and centroid, and only the centroids (``k`` rows) come to the
driver and go out again.  A centroid that attracts most vectors is summed in every task
like any other.

Results for edge cases: rows whose vector is null, not of ``width`` components, or holds
null, NaN or an infinity are left out; repeated rows count as often as they come, equal
hashes (repeated ids) are ordered by the vector; with fewer vectors than ``k`` each is a
centroid of its own at first; a null id counts as the text ``null`` in the hash that picks
the first centroids; no vectors give no rows; a component of 2**27 or more fails the job,
as distances might not fit a long; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from sluice.llm.common import arrow_map, id_field, staged

LARGEST = 1 << 27
GROUP = 4096  # vectors compared at once


def dense_vectors(column: pa.Array, width: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows whose vector has ``width`` (or any) components, all finite, and
    their components one after the other as doubles."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
    held = np.maximum(lengths, 0)
    ends = np.cumsum(held)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    keep = (lengths >= 0) & (bad[ends] == bad[ends - held])
    if width is not None:
        keep &= lengths == width
    return np.flatnonzero(keep), values[np.repeat(keep, held)]


def pack_planes(x: np.ndarray) -> list[bytes]:
    """Each row of integers as its planes, lowest first, ``width / 64`` words a plane."""
    n, width = x.shape
    top = np.maximum(x.max(1, initial=0), -1 - x.min(1, initial=0))
    # bits of the largest magnitude, and the sign's
    planes = np.frexp(top.astype(np.float64))[1].astype(np.int64) + 1
    out: list[bytes] = [b""] * n
    for p in np.unique(planes).tolist():
        rows = np.flatnonzero(planes == p)
        bits = (x[rows][:, None, :] >> np.arange(p)[None, :, None] & 1).astype(np.uint8)
        bits = np.pad(bits, ((0, 0), (0, 0), (0, -width % 64)))
        words = np.packbits(bits, axis=2, bitorder="little")
        data, size = words.tobytes(), p * words.shape[2]
        for i, r in enumerate(rows.tolist()):
            out[r] = data[i * size : (i + 1) * size]
    return out


def plane_weights(planes: int) -> np.ndarray:
    """``1, 2, 4, ...`` and the negative weight of the last plane."""
    w = np.int64(1) << np.arange(planes, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def planes_of(packed: list[bytes], words: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Packed rows by their number of planes: places and words ``(rows, planes, words)``."""
    sizes = np.fromiter(map(len, packed), np.int64, len(packed))
    groups = []
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        data = np.frombuffer(b"".join([packed[r] for r in rows.tolist()]), np.uint64)
        groups.append((rows, data.reshape(len(rows), -1, words)))
    return groups


def unpack_planes(planes: np.ndarray, width: int) -> np.ndarray:
    """The integers again."""
    n, p, _ = planes.shape
    bits = np.unpackbits(planes.view(np.uint8).reshape(n, p, -1), axis=2, bitorder="little")[:, :, :width]
    return np.einsum("npw,p->nw", bits.astype(np.int64), plane_weights(p))


def dot_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact dot products of all left with all right vectors, from their planes: the bits
    that a left and a right plane share, counted and weighted by both planes."""
    out = np.zeros((len(left), len(right)), np.int64)
    lw, rw = plane_weights(left.shape[1]), plane_weights(right.shape[1])
    for a in range(left.shape[1]):
        for b in range(right.shape[1]):
            shared = left[:, None, a, :] & right[None, :, b, :]
            out += lw[a] * rw[b] * np.bitwise_count(shared).sum(axis=2, dtype=np.int64)
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (of equally near ones the first), and the
    squared distance."""
    words = planes.shape[2]
    # every centroid in as many planes as the widest needs
    bits = int(np.frexp(float(max(centroids.max(initial=0), -1 - centroids.min(initial=0))))[1]) + 1
    spread = (centroids[:, None, :] >> np.arange(bits)[None, :, None] & 1).astype(np.uint8)
    spread = np.pad(spread, ((0, 0), (0, 0), (0, -width % 64)))
    packed = np.packbits(spread, axis=2, bitorder="little").view(np.uint64).reshape(len(centroids), bits, words)
    norms = (centroids * centroids).sum(1)
    cluster, distance = np.empty(len(planes), np.int32), np.empty(len(planes), np.int64)
    for at in range(0, len(planes), GROUP):
        part = planes[at : at + GROUP]
        own = np.zeros(len(part), np.int64)  # |x|^2 by the same counts
        w = plane_weights(part.shape[1])
        for a in range(part.shape[1]):
            for b in range(part.shape[1]):
                own += w[a] * w[b] * np.bitwise_count(part[:, a] & part[:, b]).sum(axis=1, dtype=np.int64)
        d = own[:, None] + norms[None, :] - 2 * dot_products(part, packed)
        best = d.argmin(1)
        cluster[at : at + GROUP], distance[at : at + GROUP] = best, d[np.arange(len(part)), best]
    return cluster, distance


def packed_vectors(df: DataFrame, id_col: str, vector_col: str, width: int, scale: int, seed: int) -> DataFrame:
    """Id, planes and the hash that picks the first centroids, of the vectors kept."""
    schema = StructType(
        [id_field(df, id_col, "id"), StructField("planes", BinaryType()), StructField("pick", StringType())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = dense_vectors(batch.column("vector"), width)
            if not len(rows):
                continue
            x = np.floor(values.reshape(len(rows), width) * scale)
            if np.abs(x).max() >= LARGEST:
                raise ValueError(f"components of {LARGEST} / {scale} or more: distances might not fit a long")
            ids = batch.column("id").take(pa.array(rows))
            named = ["null" if i is None else str(i) for i in ids.to_pylist()]
            pick = [hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() for i in named]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(pack_planes(x.astype(np.int64)), pa.binary()), pa.array(pick)], names=["id", "planes", "pick"]
            )

    return df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).transform(arrow_map, run, schema)


def centroid_sums(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Number of vectors and sums of components of every centroid that is nearest to some."""
    k, width = centroids.shape
    schema = "cluster int, n long, sums array<long>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            for _, planes in planes_of(batch.column("planes").to_pylist(), -(-width // 64)):
                cluster, _ = nearest(planes, centroids, width)
                count += np.bincount(cluster, minlength=k)
                order = np.argsort(cluster, kind="stable")
                present, first = np.unique(cluster[order], return_index=True)
                sums[present] += np.add.reduceat(unpack_planes(planes, width)[order], first, axis=0)
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array(count[met]), pa.array(list(sums[met]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    parts = packed.select("planes").transform(arrow_map, run, schema)
    total = [F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(width)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *total)


def cluster_vectors(
    df: DataFrame,
    k: int = 40,
    rounds: int = 5,
    width: int = 64,
    scale: int = 256,
    seed: int = 2,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector kept: its id, ``cluster``, squared ``distance``, that summed over
    the cluster (``cluster_inertia``) and over all (``inertia``), and ``centroid_sha256``."""
    spark: SparkSession = df.sparkSession
    words = -(-width // 64)
    packed = staged(spark, packed_vectors(df, id_col, vector_col, width, scale, seed), "planes")

    first = packed.orderBy("pick", "planes").limit(k).select("planes").collect()  # k rows
    centroids = np.zeros((len(first), width), np.int64)
    for rows, planes in planes_of([bytes(r.planes) for r in first], words):
        centroids[rows] = unpack_planes(planes, width)
    for _ in range(rounds if len(first) else 0):
        new = centroids.copy()
        for r in centroid_sums(packed, centroids).collect():  # at most k rows
            new[r.cluster] = np.array([r[f"s{d}"] for d in range(width)], np.int64) // r.n
        centroids = new

    schema = StructType([id_field(df, id_col), StructField("cluster", IntegerType()), StructField("distance", LongType())])

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            cluster, distance = np.empty(n, np.int32), np.empty(n, np.int64)
            for rows, planes in planes_of(batch.column("planes").to_pylist(), words):
                cluster[rows], distance[rows] = nearest(planes, centroids, width)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cluster), pa.array(distance)], names=[id_col, "cluster", "distance"]
            )

    assigned = staged(spark, packed.select("id", "planes").transform(arrow_map, assign, schema), "clusters")
    inertia = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of_cluster = spark.createDataFrame(
        [(c, inertia[c], sum(inertia.values()), names[c]) for c in sorted(inertia)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # k rows at most
    return assigned.join(F.broadcast(of_cluster), "cluster").select(id_col, "cluster", "distance", *of_cluster.columns[1:])
