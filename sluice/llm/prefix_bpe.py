"""Byte-level BPE encoding and decoding by prefix dynamic programming (operator 5).

For every byte prefix of a piece there is exactly one token that ends its
encoding.  ``PrefixTable`` stores it: the last token ``t`` of prefix ``i`` is the
one reachable token that ends there and is compatible with the stored last token
of the prefix before it, where two tokens are compatible if merging their joined
bytes gives just these two again.  The encoding of any prefix is read off by
walking back through the stored tokens, so appends are exact and cost only the new
bytes, and an edit needs re-encoding only from the edited place on.

Texts are first cut by the tokenizer's pattern; each match is encoded separately.
A match that is itself a token is that token, as in the library.  The matches of a
batch that were not met before fill their tables together: step ``i`` finds the last
token of the ``i``-th prefix of all of them in numpy arrays.  What recurs between blanks
is remembered with its ids, bounded by bytes.

Results for edge cases: null and empty texts have no tokens and decode to nothing;
repeated rows give repeated rows; an empty table gives an empty table; ids may be
null; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Sequence
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField

from sluice.llm.common import mix64, map_texts
from sluice.llm.flat import Lexicon, PairTable, spell

MEMO_BYTES = 128 << 20
TOGETHER = 128  # bytes up to which pieces fill their tables together
CHUNK = 1 << 15  # pieces filled at once

# Patterns whose blanks only stand alone and first in a match, so that
# texts may be cut before a blank between two other characters.
CUT_AT_BLANKS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_bytes(data: bytes, ranks: dict[bytes, int], until: int = 1) -> list[int]:
    """Byte-pair merging of one short piece: joins the leftmost pair of lowest rank
    until no joined pair is a token, or ``until`` parts are left."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > until:
        best, at = None, 0
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


_BASE = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_UNDO = [np.uint64(pow(pow(_BASE, -1, 1 << 64), k, 1 << 64)) for k in range(TOGETHER + 1)]
_STEP = [np.uint64(pow(_BASE, k, 1 << 64)) for k in range(TOGETHER + 1)]


def _spelling_keys(words: Sequence[bytes]) -> np.ndarray:
    """Keys of short byte strings: a polynomial of their bytes, as 63 bits."""
    with np.errstate(over="ignore"):
        return np.array([int(sum(int(_BYTE[c]) * int(_STEP[k]) for k, c in enumerate(w)) % (1 << 64)) >> 1 for w in words], np.int64)


class Vocabulary:
    """Ranks of a byte-level BPE with its tables of reachable tokens and of pairs."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"single bytes without a token: {missing[:5]}")
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pattern, self.cut = regex.compile(pattern), pattern in CUT_AT_BLANKS
        size = max(ranks.values()) + 1
        # the two tokens whose merge made a token; -1 for bytes
        self.left, self.right = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self.usable: dict[bytes, int] = {}  # tokens that merging can end with
        pairs = {}
        for b, i in ranks.items():
            if len(b) > 1:
                two = merge_bytes(b, ranks, 2)
                if len(two) != 2:
                    continue
                self.left[i], self.right[i] = two
                for k in range(1, len(b)):
                    x, y = ranks.get(b[:k]), ranks.get(b[k:])
                    if x is not None and y is not None:
                        pairs[x << 24 | y] = i
            self.usable[b] = i
        # tokens that no merging reaches also join others
        for b, i in ranks.items():
            if b not in self.usable:
                for k in range(1, len(b)):
                    x, y = ranks.get(b[:k]), ranks.get(b[k:])
                    if x is not None and y is not None:
                        pairs[x << 24 | y] = i
        self.joined = PairTable(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32))
        short = [b for b in self.usable if len(b) <= TOGETHER]
        self.tokens = PairTable(_spelling_keys(short), np.array([self.usable[b] for b in short], np.int32))
        self.sizes = sorted({len(b) for b in short}, reverse=True)
        self.width = np.zeros(size, np.int64)
        for i, b in self.bytes_of.items():
            self.width[i] = len(b)
        self.decimal = [b"%d," % i for i in range(size)]
        self.spelling = [self.bytes_of.get(i, b"") for i in range(size)]

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the joined bytes of two tokens gives the two again: undoes,
        latest first, the merges that made them, and asks each time whether the two
        parts that touch the seam would have been joined before the merge just undone."""
        ok = np.ones(len(left), bool)
        at = np.arange(len(left))
        left, right = left.astype(np.int64), right.astype(np.int64)
        undone = len(self.width) + 256 + np.maximum(left, right)
        while len(at):
            made = self.joined.get(left << 24 | right)
            clash = (made >= 0) & (made < undone)
            ok[at[clash]] = False
            a, b = self.left[left] >= 0, self.left[right] >= 0
            go = ~clash & (a | b)
            at, left, right, a, b = at[go], left[go], right[go], a[go], b[go]
            first = ~b | (a & (left > right))  # of equal ranks the left pair is joined first
            undone = np.where(first, left, right + 1)
            left, right = np.where(first, self.right[left], left), np.where(first, right, self.left[right])
        return ok

    def encode_pieces(self, pieces: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has."""
        spelled = [p.encode("utf-8") for p in pieces]
        counts = np.ones(len(spelled), np.int64)
        alone = np.fromiter((self.ranks.get(b, -1) for b in spelled), np.int64, len(spelled))
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        some: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        low = 0
        for top in (8, 16, 32, 64, TOGETHER):
            rows = np.flatnonzero((alone < 0) & (sizes > low) & (sizes <= top))
            low = top
            for k in range(0, len(rows), CHUNK):
                part = rows[k : k + CHUNK]
                some.append((part, *self._fill([spelled[r] for r in part.tolist()])))
        for r in np.flatnonzero((alone < 0) & (sizes > TOGETHER)).tolist():
            ids = PrefixTable(self, spelled[r]).ids()
            some.append((np.array([r]), np.array(ids, np.int32), np.array([len(ids)])))
        for rows, _, n in some:
            counts[rows] = n
        starts = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        whole = np.flatnonzero(alone >= 0)
        out[starts[whole]] = alone[whole]
        for rows, ids, n in some:
            out[np.repeat(starts[rows] - np.cumsum(n) + n, n) + np.arange(len(ids))] = ids
        return out, counts

    def _fill(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Prefix tables of short pieces, step by step for all of them, read back."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(-size, kind="stable")
        size, sorted_ = size[order], [pieces[i] for i in order.tolist()]
        top = int(size[0])
        data = np.frombuffer(b"".join([p.ljust(top, b"\0") for p in sorted_]), np.uint8).reshape(-1, top)
        last = np.full((top + 1, len(pieces)), -1, np.int32)  # last[i]: the token that ends the prefix of i bytes
        sums = [np.zeros(len(pieces), np.uint64)]
        for end in range(1, top + 1):
            open_ = np.arange(int(np.searchsorted(-size, -end, side="right")))
            sums.append(sums[-1] + _BYTE[data[:, end - 1]] * _STEP[end - 1])
            for n in self.sizes:
                start = end - n
                if start < 0:
                    continue
                key = (sums[end][open_] - sums[start][open_]) * _UNDO[start] >> np.uint64(1)
                token = self.tokens.get(key.astype(np.int64))
                fits = token >= 0
                if start:
                    met = np.flatnonzero(fits)
                    fits[met] = self.compatible(last[start, open_[met]], token[met])
                last[end, open_[fits]] = token[fits]
                open_ = open_[~fits]
                if not len(open_):
                    break
        at, rows, found, counts = size.copy(), np.arange(len(pieces)), [], np.zeros(len(pieces), np.int64)
        while len(rows):
            token = last[at[rows], rows]
            found.append((rows, counts[rows], token))
            counts[rows] += 1
            at[rows] -= self.width[token]
            rows = rows[at[rows] > 0]
        row, back, token = (np.concatenate(x) for x in zip(*found))
        real = np.empty(len(pieces), np.int64)
        real[order] = counts
        starts = np.cumsum(real) - real
        ids = np.empty(len(token), np.int32)
        ids[starts[order[row]] + counts[row] - 1 - back] = token
        if self.decode(ids.tolist()) != b"".join(pieces):  # two spellings with one key
            single = [PrefixTable(self, p).ids() for p in pieces]
            return np.array([i for s in single for i in s], np.int32), np.array([len(s) for s in single])
        return ids, real

    def spelled(self, segments: Sequence[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        """Of each segment its ids, these as decimals with a comma behind, and the bytes
        they decode to."""
        number: dict[str, int] = {}
        put = number.setdefault
        counts, flat = [], []
        for s in segments:
            found = self.pattern.findall(s)
            counts.append(len(found))
            flat += [put(p, len(number)) for p in found]
        ids, each = self.encode_pieces(list(number))
        starts = np.cumsum(each) - each
        where = np.array(flat, np.int64)
        n = each[where]
        ids = ids[np.repeat(starts[where] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(counts)]
        return spell(ids, np.diff(ends, prepend=0), {"decimals": self.decimal, "decoded": self.spelling})

    def segments(self, text: str) -> list[str]:
        return split_segments(text) if self.cut else [text] if text else []

    def encode(self, text: str) -> list[int]:
        return self.encode_pieces(self.pattern.findall(text))[0].tolist() if text else []

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixTable:
    """The last token of every byte prefix of a growing piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data = vocabulary, bytearray()
        self.last: list[int] = []  # last[i]: the token that ends the prefix of i + 1 bytes
        self.pairs: dict[tuple[int, int], bool] = {}
        self.append(data)

    def append(self, more: bytes) -> None:
        """Extends the piece; what was stored stays valid."""
        v, last = self.vocabulary, self.last
        usable, longest = v.usable.get, v.longest
        self.data += more
        base = max(0, len(last) - longest)  # no token reaches further back
        data = bytes(self.data[base:])
        for end in range(len(last) - base + 1, len(data) + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = usable(data[start:end])
                if token is not None and (base + start == 0 or self._fits(last[base + start - 1], token)):
                    last.append(token)
                    break

    def _fits(self, left: int, right: int) -> bool:
        fits = self.pairs.get((left, right))
        if fits is None:
            fits = self.pairs[left, right] = bool(self.vocabulary.compatible(np.array([left]), np.array([right]))[0])
        return fits

    def truncate(self, size: int) -> None:
        """Back to the first ``size`` bytes."""
        del self.data[size:], self.last[size:]

    def edit(self, start: int, stop: int, new: bytes) -> None:
        """Replaces ``data[start:stop]``: only bytes from ``start`` on are encoded again,
        and where the stored tokens after the edit agree again for a longest token's
        length, the rest of the old table is kept."""
        old_last, tail = self.last[stop:], bytes(self.data[stop:])
        longest = self.vocabulary.longest
        self.truncate(start)
        self.append(new)
        same = 0
        for k in range(len(tail)):
            self.append(tail[k : k + 1])
            same = same + 1 if self.last[-1] == old_last[k] else 0
            if same > longest:
                self.data += tail[k + 1 :]
                self.last += old_last[k + 1 :]
                return

    def ids(self, size: int | None = None) -> list[int]:
        """Encoding of the first ``size`` bytes (all by default)."""
        end = len(self.data) if size is None else size
        out, length = [], self.vocabulary.bytes_of
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(length[token])
        return out[::-1]


_SPACE = "\t-\r \x85\xa0  -     　"
_RUN = re.compile(f" (?=[{_SPACE}])(?<=[{_SPACE}] )")
_CUT = re.compile(f"(?<=[^{_SPACE}])(?= [^{_SPACE}])")


def split_segments(text: str) -> list[str]:
    """Cuts a text before single blanks, where no match of a pattern whose blanks
    only stand alone, first in a match, can reach across: before every blank, or, where
    some blank touches other white space on both sides, before those between two
    characters that are no white space."""
    if " " not in text:
        return [text] if text else []
    if _RUN.search(f"\n{text}\n"):
        return _CUT.split(text)
    parts = text.split(" ")
    return [p for p in (parts[0], *[" " + p for p in parts[1:]]) if p]


@cache
def vocabulary(file: str, pattern: str) -> Vocabulary:
    """One per worker process."""
    return Vocabulary(load_ranks(file), pattern)


@cache
def lexicon(file: str, pattern: str, memo_bytes: int = MEMO_BYTES) -> Lexicon:
    """The segments one worker process has met, with what they are encoded to."""
    v = vocabulary(file, pattern)
    return Lexicon(v.segments, v.spelled, memo_bytes, v)


FIELDS = {
    "n_tokens": LongType(),
    "ids_sha256": StringType(),
    "decoded_sha256": StringType(),
    "ids": ArrayType(IntegerType()),
    "decoded": BinaryType(),
}


def codec(file: str, pattern: str, outputs: tuple[str, ...], memo_bytes: int):
    def make():
        words = lexicon(file, pattern, memo_bytes)

        def run(texts: list[bytes | None]) -> dict:
            ids, decimals, decoded = words.coded(
                [(t or b"").decode("utf-8", "replace") for t in texts], "ids", "decimals", "decoded"
            )
            got: dict[str, pa.Array] = {}
            if "n_tokens" in outputs:
                got["n_tokens"] = pa.array([len(i) for i in ids], pa.int64())
            if "ids_sha256" in outputs:  # without the last comma
                got["ids_sha256"] = pa.array([hashlib.sha256(d[:-1]).hexdigest() for d in decimals], pa.string())
            if "decoded_sha256" in outputs:
                got["decoded_sha256"] = pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())
            if "ids" in outputs:
                offsets = pa.array([0, *accumulate(map(len, ids))], pa.int32())
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                got["ids"] = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
            if "decoded" in outputs:
                got["decoded"] = pa.array([d.tobytes() for d in decoded], pa.binary())
            return got

        return run

    return make


def bpe_codec(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    outputs: tuple[str, ...] = ("n_tokens", "ids_sha256", "decoded_sha256"),
    memo_bytes: int = MEMO_BYTES,
) -> DataFrame:
    """The id and the chosen ``outputs`` for every row of ``docs``: token ids and the
    bytes they decode to, or digests of both.  ``ranks_path`` must be readable on
    every executor; ``memo_bytes`` bounds what a worker remembers of the segments met
    so far."""
    unknown = set(outputs) - set(FIELDS)
    if unknown:
        raise ValueError(f"unknown outputs: {sorted(unknown)}")
    fields = [StructField(n, FIELDS[n]) for n in outputs]
    return map_texts(docs, codec(ranks_path, pattern, tuple(outputs), memo_bytes), fields, id_col, text_col)
