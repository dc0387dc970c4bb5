"""Records of XML documents of any size, read in parallel and by depth.

Records are the elements of one name: those that are children of the document's root
(``read_root_records``), or the outermost ones at any depth, as Spark's own reader takes them
(``files.read_xml_records``).  Elements in comments or in CDATA sections are none.  Files are cut at
``>``, and as in ``json_records`` every range first answers what it leads to from each
state it may start in (text, comment, CDATA, instruction, quoted attribute, document type),
the answers of a file are put together in order, and each range then cuts out its records.

Records are parsed by Spark's ``from_xml``: attributes become ``_name`` fields, text next
to attributes ``_VALUE``.  One document a file, UTF-8.  A record in which the file breaks
off is not returned, unless records are taken at any depth: then it is parsed as far as it
goes, which is an error with ``FAILFAST``.  An empty file has no records; compressed files are one range each.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.sources.json_records import PIECES, joined_pieces, piece_rows
from sluice.sources.quoted_csv import quoted_lines, ranges_of

MODES = ("text", "comment", "cdata", "instruction", '"', "'", "type")
_ENDS = {"comment": "--", "cdata": "]]", "instruction": "?", "type": "]"}
_QUOTED = re.compile(r""""[^"]*+"|'[^']*+'""")
_NAME = re.compile(r"[^\s/]+")


class Walk:
    """State of a walk over pieces of a document, each ended by ``>``: the mode, the depth
    and the element open at each depth.  None stands for one that opened before."""

    def __init__(self, mode: str = "text", depth: int = 0, names: dict[int, str | None] | None = None):
        self.mode, self.depth, self.low = mode, depth, depth
        self.names = dict(names or ({depth: None} if mode in ('"', "'") else {}))

    def piece(self, text: str) -> int | None:
        """Walks over a piece and the ``>`` behind it; the place where an element opens."""
        if self.mode in _ENDS:
            if text.endswith(_ENDS[self.mode]):
                self.mode = "text"
            return None
        if self.mode != "text":  # within the value of an attribute
            end = text.find(self.mode)
            if end >= 0:
                self._tag(text[end + 1 :])
            return None
        at = text.find("<")
        if at < 0:
            return None
        for opens, mode in (("<!--", "comment"), ("<![CDATA[", "cdata"), ("<?", "instruction")):
            if text.startswith(opens, at):
                if not text[at + len(opens) :].endswith(_ENDS[mode]):
                    self.mode = mode
                return None
        if text.startswith("<!", at):
            if "[" in text[at:] and not text.endswith("]"):
                self.mode = "type"
            return None
        if text.startswith("</", at):
            self._close()
            return None
        name = _NAME.match(text, at + 1)
        self.names[self.depth] = name[0] if name else ""
        self._tag(text[at + 1 :])
        return at

    def _tag(self, rest: str) -> None:
        """What follows in a tag: it ends with the piece unless a quote is open."""
        bare = _QUOTED.sub("", rest)
        quote = next((c for c in bare if c in "\"'"), None)
        if quote:
            self.mode = quote
            return
        self.mode = "text"
        if bare.endswith("/"):
            self.names.pop(self.depth, None)
        else:
            self.depth += 1

    def _close(self) -> None:
        self.depth -= 1
        self.names.pop(self.depth, None)
        self.low = min(self.low, self.depth)


_TEXTS = pa.map_(pa.int32(), pa.string())
_END = pa.struct([("mode", pa.string()), ("depth", pa.int32()), ("low", pa.int32()), ("names", _TEXTS)])
END = "struct<mode:string,depth:int,low:int,names:map<int,string>>"


def _outcomes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range, what it leads to from each mode."""
    rows: list[tuple] = []
    at, walks = None, []

    def told() -> tuple:
        return *at, [{"mode": w.mode, "depth": w.depth, "low": w.low, "names": list(w.names.items())} for w in walks]

    for file, start, pieces in ranges_of(batches):
        if (file, start) != at:
            if at is not None:
                rows.append(told())
            at, walks = (file, start), [Walk(m) for m in MODES]
        for text in pieces.to_pylist():
            for w in walks:
                w.piece(text)
    if at is not None:
        rows.append(told())
    columns = zip(*rows) if rows else [[]] * 3
    types = (pa.string(), pa.int64(), pa.list_(_END))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["file", "start", "ends"])


def _fold(table: pa.Table) -> pa.Table:
    out = {"file": [], "start": [], "mode": [], "depth": [], "names": []}
    mode, depth, names = "text", 0, {}
    for r in sorted(table.to_pylist(), key=lambda r: r["start"]):
        if r["start"] > 0:
            for name, value in zip(out, (r["file"], r["start"], mode, depth, list(names.items()))):
                out[name].append(value)
        led = r["ends"][MODES.index(mode)]
        own = {depth + d: names.get(depth + d) if k is None else k for d, k in led["names"]}
        names = {d: k for d, k in names.items() if d < depth + led["low"]} | own
        mode, depth = led["mode"], depth + led["depth"]
    types = (pa.string(), pa.int64(), pa.string(), pa.int32(), _TEXTS)
    return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), types)})


def range_starts(pieces: DataFrame) -> DataFrame:
    """(file, start, mode, depth, names) of every range that is not its file's first."""
    answers = pieces.mapInArrow(_outcomes, f"file string, start long, ends array<{END}>")
    return answers.groupBy("file").applyInArrow(
        _fold, "file string, start long, mode string, depth int, names map<int,string>"
    )


def _records(row_tag: str, known: dict[tuple[str, int], tuple], any_depth: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, walk, part, opens, level = None, Walk(), None, True, 1

        def left_open() -> Iterator[pa.RecordBatch]:
            if at is not None and part is not None:
                yield piece_rows(["".join(part)], at, opens, False)

        for file, start, pieces in ranges_of(batches):
            if (file, start) != at:
                yield from left_open()
                at, walk = (file, start), Walk(*known.get((file, start), ()))
                around = [d for d, name in walk.names.items() if name == row_tag and (any_depth or d == 1)]
                part, opens, level = ([], False, min(around)) if around else (None, True, 1)
            done = []
            for text in pieces.to_pylist():
                before = walk.depth
                place = walk.piece(text)
                if part is not None:
                    part += (text, ">")
                elif place is not None and (any_depth or before == 1) and _NAME.match(text, place + 1) and _NAME.match(text, place + 1)[0] == row_tag:
                    part, opens, level = [text[place:], ">"], True, before
                if part is not None and walk.depth == level and level not in walk.names:
                    if opens:
                        done.append("".join(part))
                    else:
                        yield piece_rows(["".join(part)], at, False, True)
                    part = None
            if done:
                yield piece_rows(done, None, True, True)
        yield from left_open()

    return run


def _joined_or_broken(table: pa.Table) -> pa.Table:
    """Records from a file's pieces, and the one in which the file breaks off."""
    last = max(table.to_pylist(), key=lambda r: (r["start"], r["opens"]))
    whole = joined_pieces(table)
    if last["ends"]:
        return whole
    pieces = sorted(table.to_pylist(), key=lambda r: (r["start"], r["opens"]))
    first = max(i for i, r in enumerate(pieces) if r["opens"])
    broken = "".join(r["text"] for r in pieces[first:])
    return pa.table({"text": pa.concat_arrays([*whole.column("text").chunks, pa.array([broken], pa.string())])})


def xml_record_texts(spark: SparkSession, path: str | Sequence[str], row_tag: str, any_depth: bool = False) -> DataFrame:
    """``text`` of every ``row_tag`` element that is a child of its document's root; with
    ``any_depth``, of every one that is in no other."""
    pieces = quoted_lines(spark, path, ">")
    # one row per range after a file's first: a range is 128 MB of file
    known = {(r.file, r.start): (r.mode, r.depth, r.names) for r in range_starts(pieces).collect()}
    found = pieces.mapInArrow(_records(row_tag, known, any_depth), PIECES)
    whole = found.where("file IS NULL").select("text")
    join = _joined_or_broken if any_depth else joined_pieces
    return whole.unionByName(found.where("file IS NOT NULL").groupBy("file").applyInArrow(join, "text string"))


def read_root_records(
    spark: SparkSession, path: str | Sequence[str], row_tag: str, schema: StructType, mode: str = "FAILFAST"
) -> DataFrame:
    """One row per record, with the columns of ``schema``."""
    parsed = F.from_xml("text", schema, {"mode": mode})
    return xml_record_texts(spark, path, row_tag).select(parsed.alias("r")).select("r.*")
