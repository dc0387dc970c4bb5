"""Flat arrays for encoders: a hash table that whole arrays ask at once, rows of any
length in one array, and a bounded lexicon of the parts that texts are made of."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np

_SCATTER = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Integer keys and their values in an open hash table that whole arrays ask at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        left, probe = np.arange(len(keys)), 0
        while len(left):
            slots = (self._home(keys[left]) + probe) & self.mask
            _, first = np.unique(slots, return_index=True)
            first = first[self.keys[slots[first]] == -1]
            self.keys[slots[first]], self.values[slots[first]] = keys[left[first]], values[left[first]]
            left = np.delete(left, first)
            probe += 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SCATTER) >> self.shift).astype(np.int64)

    def as_dict(self) -> dict[int, int]:
        held = self.keys >= 0
        return dict(zip(self.keys[held].tolist(), self.values[held].tolist()))

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values; -1 where a key is not held."""
        slots = self._home(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], np.int32(-1))
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            slots[todo] = (slots[todo] + 1) & self.mask
            found = self.keys[slots[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[slots[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out


class Growing:
    """An array that grows at its end, cut into rows of any length."""

    def __init__(self, kind):
        self.data, self.ends = np.empty(1 << 12, kind), np.zeros(1 << 10, np.int64)
        self.used, self.rows = 0, 0

    def add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        self.data = _room(self.data, self.used + len(values))
        self.ends = _room(self.ends, self.rows + len(lengths) + 1)
        self.data[self.used : self.used + len(values)] = values
        self.ends[self.rows + 1 : self.rows + len(lengths) + 1] = self.used + np.cumsum(lengths)
        self.used, self.rows = self.used + len(values), self.rows + len(lengths)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows one after the other, and their lengths."""
        starts, lengths = self.ends[rows], self.ends[rows + 1] - self.ends[rows]
        where = np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
        where += np.arange(len(where))
        return self.data[where], lengths


def _room(data: np.ndarray, size: int) -> np.ndarray:
    if size <= len(data):
        return data
    out = np.zeros(max(size, 2 * len(data)), data.dtype)
    out[: len(data)] = data
    return out


def spell(
    ids: np.ndarray, counts: np.ndarray, spellings: dict[str, Sequence[bytes]]
) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Rows of ids, and under each further name what these ids spell, all as values one
    after the other and the lengths of the rows."""
    out = {"ids": (ids, counts)}
    for name, spelling in spellings.items():
        got = list(map(spelling.__getitem__, ids.tolist()))
        sizes = np.concatenate([[0], np.cumsum(np.fromiter(map(len, got), np.int64, len(got)))])
        out[name] = (np.frombuffer(b"".join(got), np.uint8), np.diff(sizes[np.cumsum(counts)], prepend=0))
    return out


class Lexicon(dict):
    """The parts of texts met so far, numbered, and what ``encode`` made of each: ids,
    decimals, decoded bytes.  It is emptied between two batches once it holds more than
    ``limit`` bytes, whatever the length of the parts."""

    KINDS = {"ids": np.int32, "decimals": np.uint8, "decoded": np.uint8}

    def __init__(self, split: Callable[[str], list[str]], encode: Callable[[list[str]], dict], limit: int, model=None):
        super().__init__()
        self.split, self.encode, self.limit, self.model = split, encode, limit, model
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.fresh: list[str] = []
        self.parts = {name: Growing(kind) for name, kind in self.KINDS.items()}
        self.letters = 0

    def __missing__(self, part: str) -> int:
        self[part] = number = len(self)
        self.fresh.append(part)
        return number

    def used(self) -> int:
        """Bytes: about 220 a part, and its letters, ids and decimals."""
        return 220 * len(self) + 2 * self.letters + sum(g.data.nbytes + g.ends.nbytes for g in self.parts.values())

    def numbers(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the parts of all texts, and how many each text has; parts that
        are new are encoded, all at once."""
        if self.used() > self.limit:
            self._empty()
        split = [self.split(t) for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        numbers = np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        if self.fresh:
            for name, (values, lengths) in self.encode(self.fresh).items():
                self.parts[name].add(values, lengths)
            self.letters += sum(map(len, self.fresh))
            self.fresh = []
        return numbers, counts

    def coded(self, texts: Sequence[str], *names: str) -> list[list[np.ndarray]]:
        """For each of ``names`` what the texts' parts were encoded to, text by text."""
        numbers, counts = self.numbers(texts)
        ends = np.cumsum(counts)
        out = []
        for name in names:
            flat, sizes = self.parts[name].take(numbers)
            at = np.concatenate([[0], np.cumsum(sizes)])[ends].tolist()
            out.append([flat[a:b] for a, b in zip([0, *at], at)])
        return out
