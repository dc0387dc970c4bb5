"""Token counts with overlap resynchronisation (operator 9).

A text longer than ``chunk_chars`` is cut into chunks that overlap; every chunk is
encoded by itself, with the offsets of its tokens, and the count is that of the chunks'
tokens between the places where neighbours are spliced.  Two neighbours are spliced at a
word that both hold whole, with white space before and after it inside both chunks,
and that both gave the same tokens at the same offsets.  Such a boundary is proven stable
for tokenizers that never let a token reach over white space: what stands before it
cannot change what comes after.  Where the overlap holds no such word it is doubled; once
it would hold the whole left chunk, that one is encoded again with twice its length.

Texts of one chunk need no splice; they are counted by their words, with what the
library gave for a word remembered (encoding them whole takes the library more than
twice the time: 1.5 s per MB against 0.7).

Results for edge cases: null and empty texts have 0 bytes and 0 tokens; repeated
rows give repeated rows; an empty table gives an empty table; ids may be null;
other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField

from sluice.llm.common import Memo, map_texts

_WORD = re.compile(r"[^\t-\r ]+")
# Letters whose lower case is one letter of the same block, then plain punctuation:
# these two parts of a word are encoded independently of each other and of case.
_PLAIN = re.compile(rb"((?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+)([.,!?;:*#%$&]+)")
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class ChunkEncoder:
    """Counts tokens of long texts from overlapping chunks; words met before are
    taken from a bounded memo of what the library gave for them."""

    def __init__(self, path: str, memo_words: int = 500_000):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self._check_separable()
        self.words = Memo(self._word_count, memo_words)
        self.cores = Memo(self._library_count, memo_words)

    def _check_separable(self) -> None:
        """The splice proof needs words to be encoded independently, the memo of
        word cores needs case folding and split punctuation."""
        ids = self._ids
        for a, b in (("Ab, c", "12 é"), ("x<|y", "z|>")):
            for gap in (" ", "\n", "\t \r"):
                if ids(a + gap + b) != ids(a) + ids(b):
                    raise ValueError("tokens of this tokenizer reach over white space")
        self.split_cores = all(
            ids(w + p) == ids(w.lower()) + ids(p) for w in ("Word", "UNTER", "étÉ") for p in (".", ",", "!!", "***", "?;:#%$&")
        )

    def _ids(self, text: str) -> list[int]:
        return self.lib.encode(text, add_special_tokens=False).ids

    def _library_count(self, word: bytes) -> int:
        return len(self._ids(word.decode("utf-8", "replace")))

    def _word_count(self, word: bytes) -> int:
        low = word.translate(_UPPER)
        if self.split_cores and (m := _PLAIN.fullmatch(low)):
            return self.cores[m[1]] + self.cores[m[2]]
        return self.cores[low if self.split_cores and low.isalpha() else word]

    def _tokens(self, text: str, lo: int, hi: int) -> tuple[list[int], list[int], list[int]]:
        """Starts, ends and ids of the tokens of ``text[lo:hi]``, offsets in the text."""
        e = self.lib.encode(text[lo:hi], add_special_tokens=False)
        starts, ends = zip(*e.offsets) if e.ids else ((), ())
        return [lo + a for a in starts], [lo + b for b in ends], e.ids

    @staticmethod
    def splice_point(text: str, left: tuple, right: tuple, lo: int, hi: int) -> int | None:
        """The first word in the overlap ``(lo, hi)`` that the left chunk (which ends at
        ``hi``) and the right one (which starts at ``lo``) hold whole and encode alike."""
        for m in _WORD.finditer(text, lo, hi):
            if m.start() == lo or m.end() == hi:
                continue  # cut by one of the chunks
            parts = []
            for starts, ends, ids in (left, right):
                a, b = bisect_left(starts, m.start()), bisect_left(starts, m.end())
                parts.append((starts[a:b], ends[a:b], ids[a:b]))
            if parts[0] == parts[1]:
                return m.start()
        return None

    def count(self, text: str, chunk_chars: int, overlap_chars: int) -> int:
        size = len(text)
        if size <= chunk_chars:
            return sum(map(self.words.__getitem__, text.encode().split()))
        first, hi, overlap = 0, chunk_chars, overlap_chars  # the left chunk, and its overlap
        left, total, counted = self._tokens(text, first, hi), 0, 0
        while hi < size:
            lo = hi - overlap
            if lo <= first:  # the overlap would hold the whole left chunk
                hi, overlap = min(size, hi + (hi - first)), overlap_chars
                left = self._tokens(text, first, hi)
                continue
            end = min(size, max(lo + chunk_chars, hi + overlap_chars))
            right = self._tokens(text, lo, end)
            cut = self.splice_point(text, left, right, lo, hi)
            if cut is None or cut < counted:  # no stable boundary: widen the overlap
                overlap *= 2
                continue
            total += bisect_left(left[0], cut) - bisect_left(left[0], counted)
            first, hi, overlap, left, counted = lo, end, overlap_chars, right, cut
        return total + len(left[0]) - bisect_left(left[0], counted)


@cache
def encoder(path: str) -> ChunkEncoder:
    """One per worker process."""
    return ChunkEncoder(path)


def counter(path: str, chunk_chars: int, overlap_chars: int, limit: int):
    def make():
        enc = encoder(path)

        def count(texts: list[bytes | None]) -> dict:
            n_bytes, n_tokens = [], []
            for data in texts:
                data = data or b""
                text = data.decode("utf-8", "replace")
                n_bytes.append(len(data))
                n_tokens.append(enc.count(text, chunk_chars, overlap_chars))
            return {
                "n_bytes": pa.array(n_bytes, pa.int64()),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "over_limit": pa.array([n > limit for n in n_tokens], pa.bool_()),
            }

        return count

    return make


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = 1 << 14,
    overlap_chars: int = 256,
    limit: int = 2048,
) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` for every row of ``docs``."""
    if not 0 < overlap_chars < chunk_chars:
        raise ValueError("the overlap must be shorter than a chunk")
    fields = [
        StructField("n_bytes", LongType()),
        StructField("n_tokens", LongType()),
        StructField("over_limit", BooleanType()),
    ]
    return map_texts(docs, counter(tokenizer_path, chunk_chars, overlap_chars, limit), fields, id_col, text_col)
