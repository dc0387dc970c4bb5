"""SentencePiece BPE encoding and decoding by vectorised merge rounds (operator 13).

The words of a batch lie behind one another in one flat array of symbols.  In each
round every word's smallest pair rank is found (a segmented minimum), all pairs of
that rank are merged at once from the left, and the array is compacted; words without
a pair leave it.  The result is that of merging one pair at a time, best score first
and leftmost first:

* a pair of the smallest rank that overlaps a chosen one to its left is not chosen;
* where a merge brings a pair of the same or a smaller rank into being, that pair comes
  first in the one-at-a-time order, so the later merges of that word wait for the next
  round.

Texts are cut where no piece of the vocabulary reaches across: before the first blank
of a run of blanks, and between two characters that stand side by side in no piece.
Words that recur are remembered, bounded by bytes.  A word that still has pairs after
``MAX_ROUNDS`` rounds (a run of thousands of characters without a cut) is finished by
a heap in the same order, as a round costs its whole length.

Results for edge cases: null and empty texts have only the end id and decode to the
empty text; characters outside the vocabulary become their UTF-8 bytes; U+2581 counts
as a blank, as in the library; repeated rows give repeated rows; an empty table gives
an empty table; ids may be null; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Sequence
from functools import cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from sluice.llm.common import map_texts
from sluice.llm.flat import Lexicon, PairTable, spell

BLANK = "▁"
MAX_ROUNDS = 256
MEMO_BYTES = 96 << 20
_POINTS = 0x110000
_NONE = np.int32(2**31 - 1)  # the rank of what is no piece


def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.int64) << 24) | right


def _probe_text() -> str:
    return f"a Åﬁ́  b{BLANK}Ａ\t c "


class PieceModel:
    """A BPE model of the sentencepiece library, and what is derived from its pieces.

    A symbol is a piece's id or, for a character that is no piece, the number of
    pieces plus its code point."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.n = lib.get_piece_size()
        ids = range(n)
        special = [i for i in ids if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)]
        if any(lib.is_unused(i) for i in ids):
            raise ValueError(f"{path}: unused pieces are not supported")
        if lib.normalize(_probe_text()) != (BLANK + _probe_text()).replace(" ", BLANK):
            raise ValueError(f"{path}: only texts kept as they are, with a blank put before them, are supported")
        self.unknown, self.end = lib.unk_id(), lib.eos_id()
        self.byte_ids = np.full(256, -1, np.int32)
        for i in special:
            if lib.is_byte(i):
                self.byte_ids[int(lib.id_to_piece(i)[3:5], 16)] = i
        hidden = set(special)
        pieces = {lib.id_to_piece(i): i for i in ids if i not in hidden}
        self._check(lib, pieces)

        self.symbol_of = np.arange(n, n + _POINTS, dtype=np.int32)
        for p, i in pieces.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        scores = np.array([lib.get_score(i) for i in ids], np.float32)
        self.rank = np.full(n + 1, _NONE, np.int32)  # the last place serves the index -1
        shown = np.array(sorted(pieces.values()), np.int64)
        self.rank[shown] = np.unique(-scores[shown], return_inverse=True)[1]

        def symbol(p: str) -> int | None:
            return int(self.symbol_of[ord(p)]) if len(p) == 1 else pieces.get(p)

        pairs, joins = [], set()
        for p, i in pieces.items():
            for k in range(1, len(p)):
                left, right = symbol(p[:k]), symbol(p[k:])
                if left is not None and right is not None:
                    pairs.append((left << 24 | right, i))
                joins.add(ord(p[k - 1]) << 24 | ord(p[k]))
        made = np.array(pairs, np.int64).reshape(-1, 2)
        self.pairs = PairTable(made[:, 0], made[:, 1].astype(np.int32))
        beside = np.array(sorted(joins), np.int64)
        self.joins = PairTable(beside, np.ones(len(beside), np.int32))

        # what an id decodes to; control ids decode to nothing
        self.surface = [b""] * n
        for p, i in pieces.items():
            self.surface[i] = p.replace(BLANK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            if i >= 0:
                self.surface[i] = bytes([b])
        self.byte_set = frozenset(int(i) for i in self.byte_ids if i >= 0)
        if self.unknown >= 0:
            self.surface[self.unknown] = " ⁇ ".encode()
        self.decimal = [b"%d " % i for i in ids]

    def _check(self, lib, pieces: dict[str, int]) -> None:
        crossing = [p for p in pieces if BLANK in p.lstrip(BLANK)]
        if crossing:
            raise ValueError(f"pieces that reach across a blank are not supported: {crossing[:3]}")
        if (self.byte_ids < 0).any() and (self.byte_ids >= 0).any():
            raise ValueError("byte pieces are incomplete")

    # ---- words
    def words(self, text: str) -> list[str]:
        """The text's words: each begins with its blanks, of which one is left out (a
        word ``w`` stands for the symbols of a blank and of ``w``)."""
        parts = text.replace(BLANK, " ").split(" ")
        if "" not in parts:
            return parts
        if not text:
            return []
        out, run = [], 0
        for p in parts:
            if p:
                out.append(BLANK * run + p)
                run = 0
            else:
                run += 1
        if run:  # the last of these blanks is the word's own
            out.append(BLANK * (run - 1))
        return out

    def encode_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has."""
        points = np.frombuffer((BLANK + BLANK.join(words)).encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lengths)
        head = np.zeros(len(points), bool)
        head[ends - lengths] = True
        head[1:] |= self.joins.get(_key(points[:-1], points[1:])) < 0
        symbols, at = self.merge(self.symbol_of[points], head)
        ids, counts = self._ids(symbols)
        # symbols never reach over a word's end: count them by where they start
        stops = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(at, ends)]
        return ids, np.diff(stops, prepend=0)

    def _ids(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, characters without a piece as bytes; and ids per symbol."""
        lone = np.flatnonzero(symbols >= self.n)
        counts = np.ones(len(symbols), np.int64)
        if not len(lone):
            return symbols, counts
        spelled = [chr(int(s) - self.n).encode("utf-8", "surrogatepass") for s in symbols[lone]]
        if self.byte_ids[0] < 0:
            out = symbols.copy()
            out[lone] = self.unknown
            return out, counts
        counts[lone] = [len(b) for b in spelled]
        out = np.repeat(symbols, counts)
        start = (np.cumsum(counts) - counts)[lone]
        width = counts[lone]
        within = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
        out[np.repeat(start, width) + within] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        return out, counts

    def merge(self, symbols: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges the words that start where ``head`` is set until no pair remains:
        the symbols left, in order, and the places at which they started."""
        out = np.full(len(symbols), -1, np.int32)
        place = np.arange(len(symbols))
        sym, head = symbols.copy(), head.copy()
        made = self._made(sym, head, np.arange(len(sym)))
        for _ in range(MAX_ROUNDS):
            if not len(sym):
                break
            rank = self.rank[made]
            starts = np.flatnonzero(head)
            least = np.minimum.reduceat(rank, starts)
            word = np.cumsum(head) - 1
            open_ = least != _NONE
            if not open_.all():  # finished words leave
                stay = open_[word]
                out[place[~stay]] = sym[~stay]
                sym, head, place, made, rank = sym[stay], head[stay], place[stay], made[stay], rank[stay]
                if not len(sym):
                    break
                word, least = np.cumsum(head) - 1, least[open_]
            pick = self._picked(sym, head, made, rank, word, least)
            sym[pick] = made[pick]
            keep = np.ones(len(sym), bool)
            keep[pick + 1] = False
            touched = np.zeros(len(sym), bool)
            touched[pick] = True
            sym, head, place, made, touched = sym[keep], head[keep], place[keep], made[keep], touched[keep]
            touched[:-1] |= touched[1:] & ~head[1:]
            new = np.flatnonzero(touched)
            made[new] = self._made(sym, head, new)
        else:
            self._finish(sym, head, place, out)
        at = np.flatnonzero(out >= 0)
        return out[at], at

    def _made(self, sym: np.ndarray, head: np.ndarray, where: np.ndarray) -> np.ndarray:
        """What the symbols at ``where`` and the next ones of their words merge to, or -1."""
        nxt = where + 1
        inside = nxt < len(sym)
        inside[inside] = ~head[nxt[inside]]
        out = np.full(len(where), -1, np.int32)
        at = where[inside]
        out[inside] = self.pairs.get(_key(sym[at], sym[at + 1]))
        return out

    def _picked(self, sym, head, made, rank, word, least) -> np.ndarray:
        """Places of the pairs merged in this round."""
        at = np.flatnonzero(rank == least[word])
        # of pairs that overlap in a row every second one from the left
        first = np.ones(len(at), bool)
        first[1:] = at[1:] != at[:-1] + 1
        run_start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run_start) % 2 == 0]
        of = word[at]
        # does a merge bring a pair that comes before, or level with, this round's?
        right = at + 2
        has = right < len(sym)
        has[has] = ~head[right[has]]
        early = np.zeros(len(at), bool)
        early[has] = self.rank[self.pairs.get(_key(made[at[has]], sym[right[has]]))] <= least[of[has]]
        has = ~head[at]
        before = sym[at - 1]
        beside = np.zeros(len(at), bool)
        beside[1:] = at[:-1] + 2 == at[1:]
        before[1:][beside[1:]] = made[at[:-1][beside[1:]]]
        early[has] |= self.rank[self.pairs.get(_key(before[has], made[at[has]]))] <= least[of[has]]
        if not early.any():
            return at
        seen = np.cumsum(early) - early  # such merges to the left, in any word
        new_word = np.ones(len(at), bool)
        new_word[1:] = of[1:] != of[:-1]
        base = seen[np.maximum.accumulate(np.where(new_word, np.arange(len(at)), 0))]
        return at[seen == base]

    def _finish(self, sym: np.ndarray, head: np.ndarray, place: np.ndarray, out: np.ndarray) -> None:
        """Words of very many rounds, one pair at a time by a heap."""
        bounds = [*np.flatnonzero(head).tolist(), len(sym)]
        made_of, rank = self.pairs.as_dict().get, self.rank.tolist()
        for a, b in zip(bounds, bounds[1:]):
            part = sym[a:b].tolist()
            last = len(part) - 1
            left, right = list(range(-1, last)), list(range(1, last + 2))
            queue: list[tuple[int, int, int, int, int]] = []

            def push(i: int, j: int) -> None:
                pair = part[i] << 24 | part[j]
                made = made_of(pair)
                if made is not None:
                    heapq.heappush(queue, (rank[made], i, j, made, pair))

            for i in range(last):
                push(i, i + 1)
            while queue:
                _, i, j, made, pair = heapq.heappop(queue)
                if part[i] < 0 or right[i] != j or part[i] << 24 | part[j] != pair:
                    continue
                part[i], part[j] = made, -1
                right[i] = right[j]
                if right[i] <= last:
                    left[right[i]] = i
                    push(i, right[i])
                if left[i] >= 0:
                    push(left[i], i)
            out[place[a:b]] = part

    # ---- texts
    def spelled(self, words: Sequence[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        """Of each word its ids, these as decimals with a blank behind, and the bytes they
        decode to."""
        ids, counts = self.encode_words(words)
        return spell(ids, counts, {"decimals": self.decimal, "decoded": self.surface})

    def encode(self, text: str) -> list[int]:
        return self.encode_words(self.words(text))[0].tolist() if text else []

    def decode(self, ids: Iterable[int]) -> str:
        """The library's ``decode(ids)`` for any ids: one leading blank goes, bytes that
        form no character become U+FFFD each."""
        out: list[str] = []
        run = bytearray()
        fresh = True
        for i in [*map(int, ids), -1]:
            if i in self.byte_set:
                run += self.surface[i]
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
                fresh = False
            if i >= 0:
                piece = self.surface[i].decode()
                if fresh and piece:
                    piece = piece[1:] if piece[0] == " " and i != self.unknown else piece
                    fresh = False
                out.append(piece)
        return "".join(out)


def _utf8(data: bytes) -> str:
    """Characters of UTF-8 bytes, each byte that belongs to none as U+FFFD."""
    out, at = [], 0
    while at < len(data):
        b = data[at]
        size = 1 if b < 0x80 else 2 if 0xC2 <= b < 0xE0 else 3 if 0xE0 <= b < 0xF0 else 4 if 0xF0 <= b < 0xF5 else 0
        try:
            out.append(data[at : at + size].decode() if size else "�")
            at += size or 1
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


@cache
def lexicon(path: str, memo_bytes: int = MEMO_BYTES) -> Lexicon:
    """The words one worker process has met, with what they are encoded to."""
    model = PieceModel(path)
    return Lexicon(model.words, model.spelled, memo_bytes, model)


FIELDS = {
    "n_tokens": LongType(),
    "ids_sha256": StringType(),
    "decoded_sha256": StringType(),
    "ids": ArrayType(IntegerType()),
    "decoded": StringType(),
}


def piece_codec(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    outputs: tuple[str, ...] = ("n_tokens", "ids_sha256", "decoded_sha256"),
    memo_bytes: int = MEMO_BYTES,
) -> DataFrame:
    """The id and the chosen ``outputs`` for every row of ``docs``: piece ids (the end
    id last) and the text they decode to, or digests of both.  ``model_path`` must be
    readable on every executor; ``memo_bytes`` bounds what a worker remembers of the
    words met so far."""
    unknown = set(outputs) - set(FIELDS)
    if unknown:
        raise ValueError(f"unknown outputs: {sorted(unknown)}")

    def make():
        words = lexicon(model_path, memo_bytes)
        end = words.model.end

        def run(texts: list[bytes | None]) -> dict:
            plain = [(t or b"").decode("utf-8", "replace") for t in texts]
            ids, decimals, decoded = words.coded(plain, "ids", "decimals", "decoded")
            counts = [len(i) + 1 for i in ids]
            decoded = [d[1:].tobytes() for d in decoded]  # without the blank put before
            got: dict[str, pa.Array] = {}
            if "n_tokens" in outputs:
                got["n_tokens"] = pa.array(counts, pa.int64())
            if "ids_sha256" in outputs:
                last = b"%d" % end
                got["ids_sha256"] = pa.array([hashlib.sha256(d.tobytes() + last).hexdigest() for d in decimals], pa.string())
            if "decoded_sha256" in outputs:
                got["decoded_sha256"] = pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())
            if "ids" in outputs:
                flat = np.concatenate([x for i in ids for x in (i, np.array([end], np.int32))])
                got["ids"] = pa.ListArray.from_arrays(pa.array([0, *accumulate(counts)], pa.int32()), pa.array(flat, pa.int32()))
            if "decoded" in outputs:
                got["decoded"] = pa.array([d.decode() for d in decoded], pa.string())
            return got

        return run

    return map_texts(docs, make, [StructField(n, FIELDS[n]) for n in outputs], id_col, text_col)
