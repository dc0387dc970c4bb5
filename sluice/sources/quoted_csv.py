"""CSV files whose quoted fields hold line breaks, read in parallel.

A byte range of such a file does not tell whether it starts inside a quoted field.  Two
scans of the lines do, without moving them:

1. every range (Spark's split of the file) answers what its lines lead to from either
   state, outside and inside a quoted field, as three flags;
2. the flags of a file's ranges, put together in order, give the state each range starts
   in; then each range joins its own lines to records.

Only the pieces of records that reach over a range's end are shuffled, by the range in
which the record begins.  Records are parsed by Spark's own ``from_csv``.

Quotes count where they open a field, close it, or stand doubled in it; a quote within an
unquoted field is an ordinary character, as in the pandas reader.  Records end at ``\\n``
or ``\\r\\n`` outside quotes; blank lines are no records.  Compressed files are one range
each.  Text is UTF-8, a byte order mark is dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# a whole quoted field; one that opens and does not close; a close from inside
_WHOLE = re.compile(r'(?:(?<=,)|\A)"(?:[^"]|"")*+"')
_OPENS = re.compile(r'(?:(?<=,)|\A)"')
_CLOSES = re.compile(r'(?:[^"]|"")*+"')

PIECE_BYTES = 1 << 20


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that starts inside (or outside) a quoted field ends inside one."""
    if inside:
        closed = _CLOSES.match(line)
        if closed is None:
            return True
        line = "x" + line[closed.end() :]  # what follows the quote belongs to the field
    return _OPENS.search(_WHOLE.sub("x", line)) is not None


def quoted_lines(spark: SparkSession, path: str | Sequence[str], sep: str = "\n") -> DataFrame:
    """Lines (what ``sep`` ends) with the file and the start of the range they belong to, in order."""
    return spark.read.option("lineSep", sep).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def ranges_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """Lines of one range at a time (a range comes in several pieces of about ``PIECE_BYTES``, so
    that what Python makes of them stays small however long the lines of a batch are)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        start, file = batch.column("start").to_numpy(), batch.column("file")
        other = pc.not_equal(file.slice(1), file.slice(0, len(file) - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero((np.diff(start) != 0) | other) + 1).tolist(), len(start)]
        values = batch.column("value")
        sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
        for a, b in zip(cuts, cuts[1:]):
            name, at = file[a].as_py(), int(start[a])
            while a < b:
                c = min(b, max(a + 1, int(np.searchsorted(sizes, sizes[a] + PIECE_BYTES, "right")) - 1))
                yield name, at, values.slice(a, c - a)
                a = c


def _quoted(lines: pa.Array) -> list[int]:
    """Places of the lines that hold a quote."""
    return np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)).tolist()


def _outcomes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: ends inside from outside, from inside, and whether a record that
    reaches into the range ends in it."""
    at, state = None, (False, True, False)
    rows = []
    for file, start, lines in ranges_of(batches):
        if (file, start) != at:
            if at is not None:
                rows.append((*at, *state))
            at, state = (file, start), (False, True, False)
        out, inn, closed = state
        for i in _quoted(lines):
            line = lines[i].as_py()
            out, inn = ends_inside(line, out), ends_inside(line, inn)
            closed |= not inn
        state = (out, inn, closed)
    if at is not None:
        rows.append((*at, *state))
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
    columns = zip(*rows) if rows else [[]] * 5
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "start", "out", "inn", "closed"])


def inside_starts(lines: DataFrame) -> DataFrame:
    """Ranges that start inside a quoted field, and the range in which that record begins."""
    ranges = lines.mapInArrow(_outcomes, "file string, start long, out boolean, inn boolean, closed boolean")
    # the ranges of one file, one row each; folded in order
    listed = ranges.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("start", "out", "inn", "closed"))).alias("r"))
    seen = "array<struct<start:bigint,owner:bigint>>"

    def step(acc, r):
        begins = F.when(acc["inside"] & ~r["closed"], acc["owner"]).otherwise(r["start"])
        return F.struct(
            F.when(acc["inside"], r["inn"]).otherwise(r["out"]).alias("inside"),
            begins.alias("owner"),
            F.when(acc["inside"], F.concat(acc["found"], F.array(F.struct(r["start"].alias("start"), acc["owner"].alias("owner")))))
            .otherwise(acc["found"]).alias("found"),
        )

    first = F.struct(F.lit(False).alias("inside"), F.lit(-1).cast("long").alias("owner"), F.array().cast(seen).alias("found"))
    folded = listed.select("file", F.aggregate("r", first, step)["found"].alias("found"))
    return folded.select("file", F.inline("found"))


def quoted_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per record: its text, and whether it is its file's first."""
    lines = quoted_lines(spark, path)
    # one row per range that starts inside a field: a range is 128 MB of file
    owners = {(r.file, r.start): r.owner for r in inside_starts(lines).collect()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part, inside, head, first = None, [], False, False, False

        def flush() -> Iterator[pa.RecordBatch]:
            if at is not None and (part or head):  # the range ends within a record
                owner = owners[at] if head else at[1]
                yield _rows(["\n".join(part)], [first], [at[0]], [owner], [at[1]])

        for file, start, lines in ranges_of(batches):
            if (file, start) != at:
                yield from flush()
                at, part = (file, start), []
                inside = head = at in owners
                first = start == 0
            done: list[str] = []
            heads: list[str] = []
            text, next_ = lines.to_pylist(), 0
            was_first = first
            for i in _quoted(lines):
                if not inside and next_ < i:
                    done += text[next_:i]
                if inside:
                    part += text[next_:i]
                next_ = i + 1
                part.append(text[i])
                inside = ends_inside(text[i], inside)
                if not inside:
                    (heads if head else done).append("\n".join(part))
                    part, head = [], False
            if inside:
                part += text[next_:]
            else:
                done += text[next_:]
            if heads:  # the end of a record that began in an earlier range
                yield _rows(heads, [False], [file], [owners[at]], [start])
            if done:
                yield _rows(done, [was_first] + [False] * (len(done) - 1))
                first = False
        yield from flush()

    schema = "text string, first boolean, file string, owner long, start long"
    found = lines.mapInArrow(run, schema)
    pieces = found.where("owner IS NOT NULL").groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("start", "text"))).alias("p"), F.max("first").alias("first")
    )
    joined = pieces.select(F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"), "first")
    whole = found.where("owner IS NULL").select("text", "first").unionByName(joined)
    text = F.regexp_replace(F.regexp_replace("text", r"\r$", ""), "^﻿", "")
    return whole.select(text.alias("text"), "first").where(F.col("first") | (F.col("text") != ""))


def _rows(text: list[str], first: list[bool], file=None, owner=None, start=None) -> pa.RecordBatch:
    n = len(text)
    columns = [
        pa.array(text, pa.string()),
        pa.array(first, pa.bool_()),
        pa.array(file or [None] * n, pa.string()),
        pa.array(owner or [None] * n, pa.int64()),
        pa.array(start or [None] * n, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["text", "first", "file", "owner", "start"])


def read_quoted_text(spark: SparkSession, path: str, names: Sequence[str], options: dict[str, str]) -> DataFrame:
    """All columns as text; every file starts with the same header."""
    text = StructType([StructField(n, StringType()) for n in names])
    parsed = F.from_csv("text", ", ".join(f"`{n}` STRING" for n in names), options)
    rows = quoted_records(spark, path).select("first", parsed.alias("r"))
    header = F.struct(*[F.lit(n).alias(n) for n in names])
    same = F.assert_true(F.to_json("r") == F.to_json(header), F.lit(f"CSV at {path}: a file has another header"))
    rows = rows.where(F.when(F.col("first"), same.isNotNull()).otherwise(True))
    return rows.select(*[F.col("r")[n].alias(n) for n in text.names])
