"""Benchmark decontamination with a generalised suffix automaton (operator 6).

The automaton holds every run of words of the normalised test items.  A document's
words are streamed through it; after each word it gives the longest run ending
there that some item contains.  Where that run reaches ``window`` words, the last
``window`` words are a window of the items found by walking to the state that
stands for exactly these words; items shorter than ``window`` count as one window of
all their words.  Documents only walk through the automaton on stretches of words
that all occur in the items, since any other word leads back to its root.

Items are read to the driver in blocks of at most ``block_words`` words, and one
block's automaton is broadcast at a time: the bound holds however many items there
are.  Documents are never shuffled.

Results for edge cases: null texts, and texts or items without words, have no
words and no hits (``items_sha256`` is then the digest of nothing); an item's null
id reads ``null``; repeated items with the same id count once; repeated documents
give repeated rows; empty tables give empty tables, an empty item table no hits;
clashing names of other columns do not matter, as they are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from sluice.llm.common import alnum_words, arrow_map


class SuffixAutomaton:
    """Generalised suffix automaton over items given as word lists."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}  # word -> number, from 1
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[set[str]] = [set()]  # per state: items with an end there
        self.shortest = window
        whole: dict[int, list[tuple[int, str]]] = {}  # state -> short items that end there
        for item, words in items:
            if not words:
                continue
            self.shortest = min(self.shortest, len(words))
            state, path = 0, []
            for w in words:
                state = self._extend(state, self.words.setdefault(w, len(self.words) + 1))
                path.append(state)
            if len(words) < window:
                whole.setdefault(state, []).append((len(words), item))
            else:
                for s in path[window - 1 :]:
                    self.items[s].add(item)
        self._finish(whole)

    def _extend(self, last: int, c: int) -> int:
        """The state after ``last`` read ``c``; adds what is missing."""
        nxt, link, length = self.next, self.link, self.length
        q = nxt[last].get(c)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        new = self._state(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.items.append(set())
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of ``q`` for its runs of at most ``length[p] + 1`` words."""
        nxt, link = self.next, self.link
        copy = self._state(self.length[p] + 1)
        nxt[copy] = dict(nxt[q])
        link[copy], link[q] = link[q], copy
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        return copy

    def _finish(self, whole: dict[int, list[tuple[int, str]]]) -> None:
        """Hands the items up the suffix links, down to the states whose runs reach the
        window; ``output[s]``: (words, item) of short items that end at ``s``."""
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        for s in reversed(order):
            up = self.link[s]
            if self.length[up] >= self.window:
                self.items[up] |= self.items[s]
        # an item whose end state was split later ends at the state of its own length
        self.output: list[list[tuple[int, str]]] = [[] for _ in self.next]
        for s, found in whole.items():
            for size, item in found:
                t = s
                while self.length[self.link[t]] >= size:
                    t = self.link[t]
                self.output[t].append((size, item))
        for s in order:
            if self.output[self.link[s]]:
                self.output[s] = self.output[s] + self.output[self.link[s]]

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans ``[start, stop)`` of hit words, and the items found."""
        get = self.words.get
        numbers = [get(w, 0) for w in words]
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        n, shortest, start = len(numbers), self.shortest, 0
        while start + shortest <= n:
            try:
                stop = numbers.index(0, start)
            except ValueError:
                stop = n
            if stop - start >= shortest:
                self._walk(numbers, start, stop, spans, found)
            start = stop + 1
        return spans, found

    def _walk(self, numbers: list[int], start: int, stop: int, spans: list, found: set[str]) -> None:
        nxt, link, length, window, output = self.next, self.link, self.length, self.window, self.output
        state, run = 0, 0
        for i in range(start, stop):
            c = numbers[i]
            while state and c not in nxt[state]:
                state = link[state]
                run = length[state]
            if c in nxt[state]:
                state, run = nxt[state][c], run + 1
            reach = 0
            if run >= window:
                s = state
                while length[link[s]] >= window:
                    s = link[s]
                found |= self.items[s]
                reach = window
            for size, item in output[state]:
                if size <= run:
                    found.add(item)
                    reach = max(reach, size)
            if reach:
                lo = i + 1 - reach
                while spans and spans[-1][1] >= lo:
                    lo = min(lo, spans.pop()[0])
                spans.append((lo, i + 1))


SPANS = ArrayType(ArrayType(IntegerType()))
STATE = StructType([StructField("spans", SPANS), StructField("items", ArrayType(StringType()))])


def _blocks(spark: SparkSession, items: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[list]:
    """Items as (id, words), at most ``block_words`` words at a time."""
    rows = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")), F.col(text_col).cast("binary"))
    block, size = [], 0
    for item, data in rows.toLocalIterator():
        words = alnum_words(bytes(data or b""))
        if not words:
            continue
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((item, words))
        size += len(words)
    yield block


def _merge(old: list, new: list) -> list:
    out: list[list[int]] = []
    for lo, hi in sorted([*map(tuple, old), *new]):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def _scanned(
    docs: DataFrame,
    items: DataFrame,
    text_col: str,
    item_col: str,
    item_text_col: str,
    window: int,
    block_words: int,
    finish: Callable[[SuffixAutomaton, bool], Callable[[pa.RecordBatch, list[dict]], pa.RecordBatch]],
    schema: StructType | Callable[[bool], StructType],
) -> tuple[DataFrame, bool]:
    """Scans the documents against every block of items, then turns each batch and its
    hits into rows of ``schema`` by ``finish(last automaton, whether it is the only one)``;
    returns these rows and whether there was one block only.

    With several blocks, what one found is kept in a column and checkpointed before
    the next, so that a task holds one automaton at a time; scan and finish of the
    last block are one Python step."""
    spark = docs.sparkSession
    found = "__hits"
    while found in docs.columns:
        found += "_"
    blocks = _blocks(spark, items, item_col, item_text_col, block_words)
    block, df, only = next(blocks), docs, True
    for following in blocks:
        only = False
        kept = StructType([*docs.schema.fields, StructField(found, STATE)])
        df = _scan(spark, df, SuffixAutomaton(block, window), text_col, found, lambda a: _with_hits(found), kept).checkpoint()
        block = following
    schema = schema if isinstance(schema, StructType) else schema(only)
    return _scan(spark, df, SuffixAutomaton(block, window), text_col, found, lambda a: finish(a, only), schema), only


def _with_hits(name: str):
    kind = pa.struct([("spans", pa.list_(pa.list_(pa.int32()))), ("items", pa.list_(pa.string()))])

    def keep(batch: pa.RecordBatch, hits: list[dict]) -> pa.RecordBatch:
        return batch.append_column(name, pa.array(hits, kind))

    return keep


def _scan(spark: SparkSession, df: DataFrame, automaton: SuffixAutomaton, text_col: str, found: str, finish, schema) -> DataFrame:
    shared = spark.sparkContext.broadcast(automaton)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = shared.value
        done = finish(a)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            before = [None] * batch.num_rows
            if found in batch.schema.names:
                before = batch.column(found).to_pylist()
                batch = batch.drop_columns([found])
            hits = []
            for text, old in zip(batch.column(text_col).to_pylist(), before):
                spans, names = a.matches(alnum_words((text or "").encode()))
                if old:
                    spans, names = _merge(old["spans"], spans), names | set(old["items"])
                hits.append({"spans": [list(s) for s in spans], "items": sorted(names)})
            yield done(batch, hits)

    return df.transform(arrow_map, run, schema)


def contamination_spans(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    block_words: int = 2_000_000,
    out_col: str = "hits",
) -> DataFrame:
    """``docs`` with a struct column ``out_col``: ``spans`` of hit words, merged, as
    [start, stop) over the document's words, and ``items`` found, sorted.  A column
    of ``docs`` named ``out_col`` is replaced."""
    df = docs.drop(out_col)
    schema = StructType([*df.schema.fields, StructField(out_col, STATE)])
    return _scanned(df, items, text_col, item_col, item_text_col, window, block_words, lambda a, only: _with_hits(out_col), schema)[0]


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    hits_per_words: int = 20,
    block_words: int = 2_000_000,
) -> DataFrame:
    """``id, n_words, n_hit, n_items, items_sha256, contaminated`` for every document;
    contaminated: ``n_hit > 0`` and ``hits_per_words * n_hit >= n_words``."""
    schema = StructType([
        StructField(id_col, docs.schema[id_col].dataType),
        StructField("n_words", LongType()),
        StructField("n_hit", LongType()),
        StructField("n_items", LongType()),
        StructField("items_sha256", StringType()),
        StructField("contaminated", BooleanType()),
    ])

    def digest(batch: pa.RecordBatch, hits: list[dict]) -> pa.RecordBatch:
        words = [len(alnum_words((t or "").encode())) for t in batch.column("text").to_pylist()]
        n_hit = [sum(b - a for a, b in h["spans"]) for h in hits]
        return pa.RecordBatch.from_arrays([
            batch.column("id"),
            pa.array(words, pa.int64()),
            pa.array(n_hit, pa.int64()),
            pa.array([len(h["items"]) for h in hits], pa.int64()),
            pa.array([hashlib.sha256(",".join(h["items"]).encode()).hexdigest() for h in hits], pa.string()),
            pa.array([h > 0 and hits_per_words * h >= w for h, w in zip(n_hit, words)], pa.bool_()),
        ], names=schema.names)

    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return _scanned(own, items, "text", item_col, item_text_col, window, block_words, lambda a, only: digest, schema)[0]


# ------------------------------------------------------------------ removal
_WORD_BYTE = bytes(b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256))


def word_places(data: bytes) -> list[tuple[int, int]]:
    """Byte ranges of the words of ``alnum_words``."""
    mask = data.translate(_WORD_BYTE)
    out, at = [], mask.find(1)
    while at >= 0:
        end = mask.find(0, at)
        end = len(mask) if end < 0 else end
        out.append((at, end))
        at = mask.find(1, end)
    return out


def without_spans(data: bytes, spans: list[list[int]]) -> bytes:
    """The text without the words of ``spans`` and what stands between them."""
    places, out, at = word_places(data), [], 0
    for lo, hi in spans:
        out.append(data[at : places[lo][0]])
        at = places[hi - 1][1]
    return b"".join([*out, data[at:]])


def remove_contamination(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    chars_col: str | None = "n_chars",
    window: int = 13,
    hits_per_words: int = 20,
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = 2_000_000,
) -> DataFrame:
    """``docs`` with the hit spans cut out of contaminated texts; a text that has no
    word left goes with its row.  Other rows, null texts too, stay as they are.

    Cutting may bring words together that form a new hit: texts are scanned again
    against all items while they are contaminated; with several blocks of items, all
    blocks pass once more over the texts just cut.  ``chars_col``, if the table has it, gets the new length."""
    has_chars = bool(chars_col) and chars_col in docs.columns
    again = "__again"
    while again in docs.columns:
        again += "_"

    def finish(automaton: SuffixAutomaton, only: bool):
        def cut(text: str, spans: list) -> str:
            """The text without hits; empty if nothing is left."""
            while spans:
                data = text.encode()
                n_words, n_hit = len(alnum_words(data)), sum(b - a for a, b in spans)
                if hits_per_words * n_hit < n_words:
                    break
                if n_hit == n_words:
                    return ""
                text = without_spans(data, spans).decode()
                if not only:
                    break
                spans, _ = automaton.matches(alnum_words(text.encode()))
            return text

        def rows(batch: pa.RecordBatch, hits: list[dict]) -> pa.RecordBatch:
            texts = batch.column(text_col).to_pylist()
            chars = batch.column(chars_col).to_pylist() if has_chars else None
            keep, changed = [], [False] * len(hits)
            for i, h in enumerate(hits):
                if h["spans"]:
                    text = cut(texts[i], h["spans"])
                    if not text:
                        continue
                    changed[i] = text != texts[i]
                    if chars and changed[i]:
                        chars[i] = len(text)
                    texts[i] = text
                keep.append(i)
            columns = []
            for f in batch.schema:
                if f.name == text_col:
                    columns.append(pa.array(texts, f.type))
                elif has_chars and f.name == chars_col:
                    columns.append(pa.array(chars, f.type))
                else:
                    columns.append(batch.column(f.name))
            out = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
            if not only:
                out = out.append_column(again, pa.array(changed, pa.bool_()))
            return out.take(pa.array(keep, pa.int64()))

        return rows

    def schema(only: bool) -> StructType:
        return docs.schema if only else StructType([*docs.schema.fields, StructField(again, BooleanType())])

    def once(rows: DataFrame) -> tuple[DataFrame, bool]:
        return _scanned(rows, items, text_col, item_col, item_text_col, window, block_words, finish, schema)

    df, only = once(docs)
    if only:
        return df
    done = None
    while True:
        df = df.checkpoint()
        clean = df.where(~F.col(again)).drop(again)
        done = clean if done is None else done.unionAll(clean)
        cut_now = df.where(F.col(again)).drop(again)
        if cut_now.isEmpty():
            return done
        df, _ = once(cut_now)
