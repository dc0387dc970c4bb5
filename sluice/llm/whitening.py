"""Embedding whitening by QDWH spectral divide and conquer (operator 12).

An entry ``c`` becomes the integer ``x = floor(scale * c)``.  Spark gathers the distinct
vectors (the fit list, partially aggregated before the shuffle), their exact sums, and
the covariance of the vectors centred before multiplying, summed task by task.  The
eigenvectors of that ``d x d`` matrix come from polar decompositions: the polar factor
of ``A - s I``, reached by the dynamically weighted Halley iteration in QR form, is the
matrix sign, and ``(U + I) / 2`` projects on the eigenvectors above the shift ``s``.
With ``s`` the mean of the eigenvalues both parts are non-empty unless all are equal;
the bases of both split the matrix in two, and so on down to single vectors.  Only the
parts that hold wanted components are split.  The components go out to all tasks, which
whiten every row.

Results for edge cases: rows whose vector is null or holds null, NaN or an infinity are
left out; repeated rows are whitened each but fitted once; an empty table, and vectors
without entries, give no rows; vectors of different lengths fail the job; components
whose eigenvalue is zero but for rounding are left out, as there is no whitening along
them (one distinct vector gives no rows); an entry of 2**53 or more fails the job; a
``deviation`` beyond a long is null (also given as ``deviation_text`` on request); ids
may be null; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from sluice.llm.bitplanes import dense_vectors
from sluice.llm.common import arrow_map, id_field, staged

EPS = float(np.finfo(float).eps)


# ---------------------------------------------------------------- the matrix part
def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of ``a`` (its sign, if ``a`` is symmetric), by QDWH."""
    n = len(a)
    size = np.abs(a).sum(0).max()  # at least the largest singular value, as ``a`` is symmetric
    x, low, eye = a / size, EPS / n, np.eye(n)
    for _ in range(40):
        l2 = low * low
        d = (4 * (1 - l2) / (l2 * l2)) ** (1 / 3)
        p = math.sqrt(1 + d)
        wa = p + math.sqrt(8 - 4 * d + 8 * (2 - l2) / (l2 * p)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([math.sqrt(wc) * x, eye]))
        new = wb / wc * x + (wa - wb / wc) / math.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        step, x = np.linalg.norm(new - x), new
        if step <= (10 * EPS) ** (1 / 3) and abs(1 - low) <= 10 * EPS:
            break
    return x


def _orthonormal(columns: np.ndarray, rank: int) -> np.ndarray:
    """An orthonormal basis of the span of the columns of a projector."""
    order = np.argsort(-np.linalg.norm(columns, axis=0), kind="stable")
    q, _ = np.linalg.qr(columns[:, order[: min(len(columns), rank + 8)]])
    # the leading directions of the span: what the projector keeps of q
    u = columns @ q
    left, r = np.linalg.qr(u)
    keep = np.argsort(-np.linalg.norm(r, axis=1), kind="stable")[:rank]
    return left[:, keep]


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below the mean eigenvalue; None if all
    eigenvalues are equal but for rounding."""
    n = len(a)
    shift = float(np.trace(a)) / n
    centred = a - shift * np.eye(n)
    if np.linalg.norm(centred) <= 4 * n * EPS * max(np.linalg.norm(a), np.finfo(float).tiny):
        return None
    sign = polar_factor(centred)
    rank = round((np.trace(sign) + n) / 2)
    if not 0 < rank < n:
        return None
    projector = (sign + np.eye(n)) / 2
    best = None
    for _ in range(3):
        start = projector if best is None else projector @ best
        above = _orthonormal(start, rank)
        above, _ = np.linalg.qr(projector @ above)
        whole, _ = np.linalg.qr(np.hstack([above, (np.eye(n) - above @ above.T)]))
        best = whole
        low = whole[:, rank:]
        if np.linalg.norm(low.T @ a @ whole[:, :rank]) <= 20 * n * EPS * np.linalg.norm(a):
            break
    return best[:, :rank], best[:, rank:]


def top_eigenvectors(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors as columns."""
    a = (a + a.T) / 2
    found: list[np.ndarray] = []
    parts = [np.eye(len(a))]  # bases, the one with the largest eigenvalues last
    while parts and len(found) < wanted:
        basis = parts.pop()
        if basis.shape[1] == 1:
            found.append(basis[:, 0])
            continue
        inner = basis.T @ a @ basis
        two = split((inner + inner.T) / 2)
        if two is None:  # one eigenvalue: any basis of the space will do
            found += list(basis.T)
            continue
        parts += [basis @ two[1], basis @ two[0]]
    vectors = np.array(found[:wanted]).reshape(-1, len(a)).T
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    values = np.einsum("dk,de,ek->k", vectors, a, vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# ---------------------------------------------------------------- the table part
def _integers(values: np.ndarray, scale: int) -> np.ndarray:
    x = np.floor(values * scale)
    if len(x) and np.abs(x).max() >= 2.0**53:
        raise ValueError(f"entries of 2**53 / {scale} or more are not supported")
    return x.astype(np.int64)


def _rows(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the rows kept, the ends of their vectors, and all their integers."""
    rows, values = dense_vectors(column, None)
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[rows]
    return rows, np.cumsum(lengths), _integers(values, scale)


def _packed(x: np.ndarray) -> bytes:
    """A vector as the smallest integers that hold it; the width is told by the first byte."""
    top = int(max(x.max(initial=0), -1 - x.min(initial=0)))
    kind = 1 if top < 1 << 15 else 2 if top < 1 << 31 else 3
    return bytes([kind]) + x.astype(f"<i{1 << kind}").tobytes()


def _unpacked(column: pa.Array) -> np.ndarray:
    rows = [np.frombuffer(b, f"<i{1 << b[0]}", offset=1) for b in column.to_pylist()]
    if len({len(r) for r in rows}) > 1:
        raise ValueError("the vectors have different lengths")
    return np.array(rows, np.int64).reshape(len(rows), -1)


def distinct_vectors(df: DataFrame, vector_col: str, scale: int) -> DataFrame:
    """The fit list: every distinct vector of integers once, packed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, ends, x = _rows(batch.column("vector"), scale)
            packed = {_packed(part) for part in np.split(x, ends[:-1])} if len(ends) else ()
            yield pa.RecordBatch.from_arrays([pa.array(list(packed), pa.binary())], names=["x"])

    return df.select(F.col(vector_col).alias("vector")).transform(arrow_map, run, "x binary").distinct()


def summed(fit: DataFrame, make) -> list[np.ndarray]:
    """``make(x)`` (a flat array of doubles or exact integers) summed over all batches
    of the fit list: one row per task meets the driver, which adds them up in order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            if batch.num_rows:
                x = _unpacked(batch.column("x"))
                got = make(x)
                if total is not None and total.shape != got.shape:
                    raise ValueError("the vectors have different lengths")
                total, n = got if total is None else total + got, n + len(x)
        if total is not None:
            whole = total.dtype == object
            part = pa.array([str(v) if whole else repr(float(v)) for v in total])
            place = pa.array(np.arange(len(total)), pa.int32())
            yield pa.RecordBatch.from_arrays([place, part, pa.array(np.full(len(total), n))], names=["place", "part", "n"])

    return fit.transform(arrow_map, run, "place int, part string, n long")


def moments(fit: DataFrame) -> tuple[int, list[int]]:
    """Number and exact sums per dimension of the fit list."""
    def make(x: np.ndarray) -> np.ndarray:
        small = len(x) * int(np.abs(x).max(initial=0)) < 1 << 62
        return x.sum(0).astype(object) if small else x.astype(object).sum(0)

    parts = summed(fit, make)
    got = (
        parts.groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("place").collect()
    )  # one row per dimension
    if len({r.n for r in got}) > 1:
        raise ValueError("the vectors have different lengths")
    return (int(got[0].n) if got else 0), [int(r.s) for r in got]


def covariance(fit: DataFrame, n: int, centre: np.ndarray, project: np.ndarray | None = None) -> np.ndarray:
    """Covariance (divisor n) of the vectors, centred before multiplying; of their
    projections with ``project``."""
    d = len(centre) if project is None else project.shape[1]

    def make(x: np.ndarray) -> np.ndarray:
        y = x - centre
        y = y if project is None else y @ project
        return (y.T @ y).ravel()

    parts = summed(fit, make).groupBy("place").agg(F.sum(F.col("part").cast("double")).alias("s"))
    out = np.zeros(d * d)
    for r in parts.collect():  # d * d numbers
        out[r.place] = r.s
    return out.reshape(d, d) / n


def whitened(
    df: DataFrame,
    components: int = 4,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    deviation_text: bool = False,
) -> DataFrame:
    """One row per row kept and component: ``vec_id``, ``component`` (from 1), ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    spark: SparkSession = df.sparkSession
    fields = [
        id_field(df, id_col),
        StructField("component", IntegerType()),
        StructField("n", LongType()),
        StructField("deviation", LongType()),
        StructField("whitened", DoubleType()),
        StructField("explained", DoubleType()),
        StructField("identity_error", DoubleType()),
    ]
    fields += [StructField("deviation_text", StringType())] if deviation_text else []
    schema = StructType(fields)
    fit = staged(spark, distinct_vectors(df, vector_col, scale), "fit-list")
    n, sums = moments(fit)
    if not sums:
        return spark.createDataFrame([], schema)
    centre = np.array([s / n for s in sums])  # of whole numbers: rounded once
    v = covariance(fit, n, centre)
    values, vectors = top_eigenvectors(v, min(components, len(sums)))
    real = values > len(sums) * EPS * np.trace(v)
    values, vectors = values[real], vectors[:, real]
    if not len(values):
        return spark.createDataFrame([], schema)
    project = vectors / np.sqrt(values)
    error = float(np.abs(covariance(fit, n, centre, project) - np.eye(len(values))).max())
    explained = values / np.trace(v)
    k, d = len(values), len(sums)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array(sums, object)
        largest = max(map(abs, sums))
        for batch in batches:
            rows, ends, x = _rows(batch.column("vector"), scale)
            if not len(rows):
                continue
            x = x.reshape(len(rows), d)
            bound = n * int(np.abs(x).max()) + largest
            if d * bound * bound < 1 << 63:  # plain 64-bit integers hold it
                y = n * x - np.array(sums, np.int64)
                deviation = (y * y).sum(1).tolist()
            else:
                y = n * x.astype(object) - exact
                deviation = (y * y).sum(1).tolist()
            w = (x - centre) @ project
            columns = [
                batch.column("id").take(pa.array(np.repeat(rows, k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(len(rows) * k, n)),
                pa.array([s if s < 1 << 63 else None for s in deviation for _ in range(k)], pa.int64()),
                pa.array(w.ravel()),
                pa.array(np.tile(explained, len(rows))),
                pa.array(np.full(len(rows) * k, error)),
            ]
            if deviation_text:
                columns.append(pa.array([str(s) for s in deviation for _ in range(k)]))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).transform(arrow_map, run, schema)
