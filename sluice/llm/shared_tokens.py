"""Which tokens of a class's set do others hold too?  Asked by whole blocks of classes.

A block holds many classes.  It asks for its distinct tokens, sorted and cut by hash
range, and every range answers one byte a token in the order of the question; so no name
of a class travels, and a token costs as much however many ranges there are.  Of a token
the question holds the ``CODE_BITS`` bits after those that name its range.  Tokens that
agree in them are counted as one, which can only call a token shared that is not (below
one in a hundred at two million tokens a range): it then stays in the one set that has
it, where it meets nothing.

An answer is 0 for tokens that one class (or one component) holds, else the number of
holders in eighths of powers of two.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm.common import arrow_map, mix64

U64, U32, I64 = np.dtype("<u8"), np.dtype("<u4"), np.dtype("<i8")
CODE_BITS = 28


class Sets(NamedTuple):
    """A block's classes: their tokens one class after the other, and how many each has;
    ``comps`` names each class's component where classes of one count once."""

    keys: np.ndarray
    lens: np.ndarray
    comps: np.ndarray | None = None


def squeeze(values: np.ndarray) -> bytes:
    """Unsigned integers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def expand(data: bytes, dtype: np.dtype) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.empty(0, dtype)
    raw = np.frombuffer(pa.decompress(data[8:], n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(dtype).reshape(-1)


def _codes(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The leading bits that tell a token's range and, in it, the token."""
    return keys >> np.uint64(max(0, 64 - CODE_BITS - (buckets.bit_length() - 1)))


# ------------------------------------------------------------------ questions
REQUEST = "bucket int, block bigint, codes binary, holders binary, who binary, names binary"
_REQUEST_TYPES = pa.schema([
    ("bucket", pa.int32()), ("block", pa.int64()),
    *((c, pa.binary()) for c in ("codes", "holders", "who", "names")),
])


def _question(block: int, sets: Sets, buckets: int) -> pa.RecordBatch:
    codes = _codes(sets.keys, buckets)
    if sets.comps is not None:
        owner = np.repeat(sets.comps, sets.lens)
        order = np.argsort(codes, kind="stable")
        codes, owner = codes[order], owner[order]
        starts = np.flatnonzero(np.diff(codes, prepend=codes[:1] + np.uint64(1)))
        low, high = np.minimum.reduceat(owner, starts), np.maximum.reduceat(owner, starts)
        codes, holders = codes[starts], np.diff(np.append(starts, len(codes)))
    else:
        codes, holders = np.unique(codes, return_counts=True)
    bucket = (codes >> np.uint64(CODE_BITS)).astype(np.int64) if buckets > 1 else np.zeros(len(codes), np.int64)
    within = (codes & np.uint64((1 << CODE_BITS) - 1)).astype(U32)
    holders = np.minimum(holders, 255).astype(np.uint8)
    edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1), len(codes)]
    out: dict[str, list] = {n: [] for n in _REQUEST_TYPES.names}
    for lo, hi in zip(edges, edges[1:]):
        out["bucket"].append(int(bucket[lo]))
        out["block"].append(block)
        out["codes"].append(squeeze(np.diff(within[lo:hi], prepend=U32.type(0))))
        out["holders"].append(squeeze(holders[lo:hi]))
        if sets.comps is not None:  # 0 where classes of several components hold the token
            names, which = np.unique(low[lo:hi], return_inverse=True)
            which = np.where(low[lo:hi] == high[lo:hi], which.reshape(-1) + 1, 0)
            out["who"].append(squeeze(which.astype(U32)))
            out["names"].append(squeeze(names.astype(I64)))
        else:
            out["who"].append(None)
            out["names"].append(None)
    return pa.RecordBatch.from_pydict(out, schema=_REQUEST_TYPES)


def _ask(sets_of: Callable[[dict], Sets], buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sets = sets_of(row)
                if len(sets.keys):
                    yield _question(row["block"], sets, buckets)

    return run


# ------------------------------------------------------------------ answers
REPLY = "block bigint, bucket int, codes binary"


def _answer(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    asked = [np.cumsum(expand(r["codes"], U32), dtype=U32) for r in rows]
    distinct, where = np.unique(np.concatenate(asked), return_inverse=True)
    where = where.reshape(-1)
    holders = np.concatenate([expand(r["holders"], np.uint8) for r in rows])
    total = np.bincount(where, weights=holders, minlength=len(distinct))
    shared = total > 1
    if rows[0]["who"] is not None:
        low = np.full(len(distinct), np.iinfo(np.int64).max)
        high = np.full(len(distinct), np.iinfo(np.int64).min)
        mixed = np.zeros(len(distinct), bool)
        at = 0
        for r, codes in zip(rows, asked):
            who, names = expand(r["who"], U32).astype(np.int64), expand(r["names"], I64)
            here = where[at : at + len(codes)]  # distinct within one question
            at += len(codes)
            one = who > 0
            comp = names[who[one] - 1]
            low[here[one]] = np.minimum(low[here[one]], comp)
            high[here[one]] = np.maximum(high[here[one]], comp)
            mixed[here[~one]] = True
        shared = mixed | (low < high)
    answer = np.where(shared, np.minimum(255, 8 * np.log2(np.maximum(total, 2))), 0).astype(np.uint8)[where]
    ends = np.cumsum([len(c) for c in asked])
    return pa.table({
        "block": pa.array([r["block"] for r in rows], pa.int64()),
        "bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
        "codes": pa.array([squeeze(answer[e - len(c) : e]) for e, c in zip(ends, asked)], pa.binary()),
    })


def answers(blocks: DataFrame, sets_of: Callable[[dict], Sets], buckets: int) -> DataFrame:
    """(block, bucket, codes) for every question of the ``blocks``."""
    asked = blocks.transform(arrow_map, _ask(sets_of, buckets), REQUEST)
    return asked.groupBy("bucket").applyInArrow(_answer, REPLY)


def holders_of(sets: Sets, replies: list[tuple[int, bytes]], buckets: int) -> np.ndarray:
    """The answers to a block's tokens, in the order of ``sets.keys``."""
    if not len(sets.keys):
        return np.empty(0, np.uint8)
    told = np.concatenate([expand(data, np.uint8) for _, data in sorted(replies)])
    return told[np.unique(_codes(sets.keys, buckets), return_inverse=True)[1].reshape(-1)]


def rarest_first(sets: Sets, holders: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Which classes have at least ``least`` shared tokens, and these tokens of each such
    class: rarest first, ties by a hash, the same order for all classes."""
    owner = np.repeat(np.arange(len(sets.lens)), sets.lens)
    keep = holders > 0
    shared = np.bincount(owner[keep], minlength=len(sets.lens))
    good = shared >= least
    keep &= good[owner]
    keys, owner, holders = sets.keys[keep], owner[keep], holders[keep]
    keys = keys[np.lexsort((mix64(keys), holders, owner))]
    ends = np.cumsum(shared[good])
    return good, [keys[e - s : e].tobytes() for s, e in zip(shared[good], ends)]
