"""Records of JSON documents of any size, read in parallel.

``read_json_documents`` takes a document as one row in one task.  Here the records, the
objects of one array in the document such as ``{"pets": [{...}, {...}]}``, are read
from all byte ranges of the file at once.  Files are cut at closing braces, so pieces are
short even if the document has no line breaks, and a record always ends with a piece.

1. Every range (Spark's split of the file) answers what its text leads to when it starts
   outside and when it starts inside a string: the state at its end, by how much the depth
   changes, and the open brackets and last keys at each depth counted from its start.
2. The answers of a file's ranges, put together in order, give each range's first state,
   depth, brackets and keys; only ranges after a file's first are kept, one small row for each
   128 MB of a large document.
3. Each range then cuts out its records.  Pieces of records that reach over a range's end
   are the only text that is shuffled; they are joined by file.

Records are parsed by Spark's ``from_json``; one that does not fit the schema gives NULLs
(``PERMISSIVE``) or an error (``FAILFAST``).  One document a file, UTF-8; elements of the
array that are no objects are not records; a file without the path, and an empty one, has
no records.  Compressed files are one range each.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.sources.quoted_csv import quoted_lines, ranges_of

# a whole string with the colon that makes it a key, a bracket, or a string that stays open
_TOKEN = re.compile(r'"((?:[^"\\]|\\.)*+)"(\s*:)?|([{\[])|\]|"', re.S)
_REST_OF_STRING = re.compile(r'((?:[^"\\]|\\.)*+)"(\s*:)?', re.S)


class Walk:
    """State of a walk over pieces of a document, each piece ended by a closing brace:
    whether it is inside a string, the depth, the bracket opened at each depth, and the
    last key at each depth."""

    def __init__(self, inside: bool = False, depth: int = 0, kinds: dict[int, str] | None = None, keys: dict[int, str | None] | None = None):
        self.inside, self.depth = inside, depth
        self.kinds, self.keys = dict(kinds or {}), dict(keys or {})
        self.low = depth  # least depth met
        self.top_key: int | None = None  # least depth at which a key was met

    def _key(self, name: str | None) -> None:
        for deeper in [d for d in self.keys if d > self.depth]:
            del self.keys[deeper]
        self.keys[self.depth] = name
        self.top_key = self.depth if self.top_key is None else min(self.top_key, self.depth)

    def piece(self, text: str) -> Iterator[int]:
        """Walks over a piece without its closing brace; yields where objects open,
        before they count in the depth."""
        at = 0
        if self.inside:
            rest = _REST_OF_STRING.match(text)
            if rest is None:
                return
            self.inside, at = False, rest.end()
            if rest[2]:
                self._key(None)  # a key that holds a brace is on nobody's path
        while (token := _TOKEN.search(text, at)) is not None:
            at = token.end()
            if token[1] is not None:
                if token[2]:
                    self._key(token[1])
            elif token[3]:
                if token[3] == "{":
                    yield token.start()
                self.kinds[self.depth] = token[3]
                self.depth += 1
            elif token[0] == "]":
                self._close()
            else:
                self.inside = True
                return

    def brace(self) -> None:
        """The closing brace that ended the piece; in a string it is a character."""
        if not self.inside:
            self._close()

    def _close(self) -> None:
        self.depth -= 1
        self.kinds.pop(self.depth, None)
        self.low = min(self.low, self.depth)


END = "struct<inside:boolean,depth:int,low:int,kinds:map<int,string>,top_key:int,keys:map<int,string>>"


def _outcomes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range, what it leads to from outside and from inside a string."""
    texts = pa.map_(pa.int32(), pa.string())
    kind = pa.struct([
        ("inside", pa.bool_()), ("depth", pa.int32()), ("low", pa.int32()), ("kinds", texts),
        ("top_key", pa.int32()), ("keys", texts),
    ])
    rows: list[tuple] = []
    at, walks = None, []

    def told(w: Walk) -> dict:
        return {
            "inside": w.inside, "depth": w.depth, "low": w.low, "kinds": list(w.kinds.items()),
            "top_key": w.top_key, "keys": list(w.keys.items()),
        }

    for file, start, pieces in ranges_of(batches):
        if (file, start) != at:
            if at is not None:
                rows.append((*at, *map(told, walks)))
            at, walks = (file, start), [Walk(False), Walk(True)]
        for text in pieces.to_pylist():
            for w in walks:
                for _ in w.piece(text):
                    pass
                w.brace()
    if at is not None:
        rows.append((*at, *map(told, walks)))
    columns = zip(*rows) if rows else [[]] * 4
    types = (pa.string(), pa.int64(), kind, kind)
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["file", "start", "out", "inn"])


def range_starts(pieces: DataFrame) -> DataFrame:
    """(file, start, inside, depth, kinds, keys) of every range that is not its file's first."""
    answers = pieces.mapInArrow(_outcomes, f"file string, start long, out {END}, inn {END}")

    def fold(table: pa.Table) -> pa.Table:
        out = {"file": [], "start": [], "inside": [], "depth": [], "kinds": [], "keys": []}
        inside, depth, kinds, keys = False, 0, {}, {}
        for r in sorted(table.to_pylist(), key=lambda r: r["start"]):
            if r["start"] > 0:
                for name, value in zip(out, (r["file"], r["start"], inside, depth, list(kinds.items()), list(keys.items()))):
                    out[name].append(value)
            led = r["inn"] if inside else r["out"]
            low = depth + led["low"]
            kinds = {d: k for d, k in kinds.items() if d < low} | {depth + d: k for d, k in led["kinds"]}
            if led["top_key"] is not None:
                top = depth + led["top_key"]
                keys = {d: k for d, k in keys.items() if d < top} | {depth + d: k for d, k in led["keys"]}
            inside, depth = led["inside"], depth + led["depth"]
        texts = pa.map_(pa.int32(), pa.string())
        types = (pa.string(), pa.int64(), pa.bool_(), pa.int32(), texts, texts)
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), types)})

    return answers.groupBy("file").applyInArrow(
        fold, "file string, start long, inside boolean, depth int, kinds map<int,string>, keys map<int,string>"
    )


def _records(path: list[str], known: dict[tuple[str, int], tuple]):
    """Whole records, and pieces of such as reach over a range's end: ``opens`` tells that
    the piece begins its record, ``ends`` that it ends it."""
    k = len(path)

    def on_path(w: Walk) -> bool:
        return w.kinds.get(k) == "[" and all(w.kinds.get(d) == "{" and w.keys.get(d + 1) == p for d, p in enumerate(path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, walk, part, opens = None, Walk(), None, True

        def left_open() -> Iterator[pa.RecordBatch]:
            if at is not None and part is not None:
                yield piece_rows(["".join(part)], at, opens, False)

        for file, start, pieces in ranges_of(batches):
            if (file, start) != at:
                yield from left_open()
                at, walk = (file, start), Walk(*known.get((file, start), ()))
                within = walk.depth > k + 1 and walk.kinds.get(k + 1) == "{" and on_path(walk)
                part, opens = ([], False) if within else (None, True)
            done = []
            for text in pieces.to_pylist():
                begins = None
                for place in walk.piece(text):
                    if part is None and begins is None and walk.depth == k + 1 and on_path(walk):
                        begins = place
                if part is not None:
                    part += (text, "}")
                elif begins is not None:
                    part, opens = [text[begins:], "}"], True
                walk.brace()
                if part is not None and not walk.inside and walk.depth == k + 1:
                    if opens:
                        done.append("".join(part))
                    else:
                        yield piece_rows(["".join(part)], at, False, True)
                    part = None
            if done:
                yield piece_rows(done, None, True, True)
        yield from left_open()

    return run


PIECES = "text string, opens boolean, ends boolean, file string, start long"


def piece_rows(texts: list[str], at: tuple[str, int] | None, opens: bool, ends: bool) -> pa.RecordBatch:
    file, start = at or (None, None)
    n = len(texts)
    return pa.RecordBatch.from_arrays([
        pa.array(texts, pa.string()), pa.array([opens] * n), pa.array([ends] * n),
        pa.array([file] * n, pa.string()), pa.array([start] * n, pa.int64()),
    ], names=["text", "opens", "ends", "file", "start"])


def joined_pieces(table: pa.Table) -> pa.Table:
    """Records from a file's pieces, in the order of their ranges."""
    out, part = [], []
    for r in sorted(table.to_pylist(), key=lambda r: (r["start"], r["opens"])):
        part = [r["text"]] if r["opens"] else [*part, r["text"]]
        if r["ends"]:
            out.append("".join(part))
            part = []
    return pa.table({"text": pa.array(out, pa.string())})


def json_record_texts(spark: SparkSession, path: str | Sequence[str], record_path: str) -> DataFrame:
    """``text`` of every object in the array at ``record_path`` (keys joined by dots; empty
    for documents that are arrays themselves)."""
    keys = [json.dumps(p, ensure_ascii=False)[1:-1] for p in record_path.split(".")] if record_path else []
    if any("}" in key for key in keys):
        raise ValueError("keys of a record path cannot hold a closing brace")
    pieces = quoted_lines(spark, path, "}")
    known = {(r.file, r.start): (r.inside, r.depth, r["kinds"], r["keys"]) for r in range_starts(pieces).collect()}
    found = pieces.mapInArrow(_records(keys, known), PIECES)
    whole = found.where("file IS NULL").select("text")
    return whole.unionByName(found.where("file IS NOT NULL").groupBy("file").applyInArrow(joined_pieces, "text string"))


def read_json_records(
    spark: SparkSession, path: str | Sequence[str], record_path: str, schema: StructType, mode: str = "PERMISSIVE"
) -> DataFrame:
    """One row per record, with the columns of ``schema``."""
    parsed = F.from_json("text", schema, {"mode": mode})
    return json_record_texts(spark, path, record_path).select(parsed.alias("r")).select("r.*")
