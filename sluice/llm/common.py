"""Helpers shared by the operators: word splitting, bounded memos, staged tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sluice.session import delete_at_exit, scratch_path

# Characters that are not part of a word, byte by byte: everything in ASCII but
# digits and letters becomes a blank, A-Z becomes a-z, bytes of longer UTF-8
# characters stay.
_ALNUM = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def blank_words(data: bytes) -> list[bytes]:
    """Lower-cases A-Z and splits at ASCII white space (``[^\\x20\\x09-\\x0D]+``)."""
    return data.lower().split()


def alnum_words(data: bytes) -> list[bytes]:
    """Lower-cases A-Z and takes runs of digits, letters and non-ASCII characters."""
    return data.translate(_ALNUM).split()


class Memo(dict):
    """``memo[key]`` computes and keeps ``fn(key)``; emptied at ``limit`` entries
    so that a worker's memory stays bounded however long it lives."""

    def __init__(self, fn: Callable, limit: int = 400_000):
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.fn(key)
        return value


_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(32)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> _S)


_P = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
_BLOCK = 1 << 18  # bytes hashed at once; longer texts go block by block
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = _powers(_P, _BLOCK), _powers(pow(_P, -1, 1 << 64), _BLOCK)


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of ``blank_words(data)``, in order: a polynomial over each word's
    bytes from one running sum, then mixed with the word's length."""
    data = data.lower()
    if len(data) <= _BLOCK:
        return _block_hashes(data)
    out, at = [], 0
    while at < len(data):
        end = at + _BLOCK
        if end < len(data):
            cut = max(data.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
            if cut < 0:  # a word longer than a block
                stop = re.search(rb"[\x09-\x0d\x20]", data[end:])
                end = end + stop.start() if stop else len(data)
                head, _, word = _rsplit(data[at:end])
                out += [_block_hashes(head), mix64(np.array([xxhash.xxh3_64_intdigest(word)], np.uint64))]
                at = end
                continue
            end = cut + 1
        out.append(_block_hashes(data[at:end]))
        at = end
    return np.concatenate(out)


def _rsplit(data: bytes) -> tuple[bytes, bytes, bytes]:
    """What stands before the last word, nothing, and the last word."""
    word = data.split()[-1]
    at = data.rfind(word)
    return data[:at], b"", word


def _block_hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    edge = np.ones(len(raw) + 2, np.int8)
    edge[1:-1] = _BLANK[raw]
    step = np.diff(edge)
    starts, ends = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _POW[: len(raw)], out=total[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mix64((total[ends] - total[starts]) * _INV[np.minimum(starts, _BLOCK - 1)] + lengths)


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` word hashes, in order."""
    m = len(h) - n + 1
    if m <= 0:
        return h[:0]
    out = h[:m]
    for k in range(1, n):
        out = mix64(out) + h[k : k + m]
    return mix64(out)


def text_input(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, as UTF-8 bytes."""
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))


def id_field(df: DataFrame, id_col: str, name: str | None = None) -> StructField:
    return StructField(name or id_col, df.schema[id_col].dataType, True)


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list[bytes | None]], dict[str, pa.Array]]],
    fields: list[StructField],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``df``: the id and what ``make()(texts)`` returns for the
    batch (null texts are passed as ``None``).  No shuffle; a lost executor's
    tasks are simply run again."""
    schema = StructType([id_field(df, id_col), *fields])
    names = [f.name for f in fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            got = fn(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(got[n] for n in names)], names=[id_col, *names]
            )

    return text_input(df, id_col, text_col).transform(arrow_map, run, schema)


BATCH_BYTES = "8m"


def arrow_map(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` in batches of a bounded size, so that a worker
    holds few texts at a time however long they are; memory that Arrow keeps for
    later is given back at the end of each task."""
    spark = df.sparkSession
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") != BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def tidy(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(tidy, schema)


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` below the shared checkpoint folder and reads it back: cuts the
    lineage with files that outlive executors.  They go when the application ends."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    delete_at_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def unstage(spark: SparkSession, df: DataFrame) -> None:
    """Removes the files of a frame that ``staged`` returned, once what was made of it is
    written itself."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.staged_path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def power_of_two(n: int) -> int:
    return 1 << max(0, int(n - 1).bit_length())
