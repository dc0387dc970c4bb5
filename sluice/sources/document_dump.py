"""Document collections from binary dumps (BSON), read in parallel.

A dump file holds a collection's documents one after another, each led by its length in
bytes; nothing else marks where one begins.  Files are cut into ranges all the same:

1. Every range guesses its first document, the first place from which several documents
   follow one another whose elements all fit, and follows the lengths to the first document
   after its end.  One small row a range comes back.
2. A file's first range starts at 0; a guess is right if the range before it ends there.  A
   range with a wrong guess is walked again from the proven place, until all are proven: the
   borders are exact, whatever texts or bytes look like documents.
3. ``document_dump``, a Python data source, reads the ranges as Arrow batches.  Only the fields
   of the given schema are decoded, the others are skipped by their lengths.  Thousands of
   documents are walked side by side, an element of all that have it in one step, and columns
   are made from the values' places; a document that is damaged, repeats a field or has
   elements that few others have is decoded alone.

Results for edge cases: a missing field, null and undefined are NULL; of a field that a document
repeats, the last counts; a value that is not of its column's type is NULL (``PERMISSIVE``) or
an error (``FAILFAST``); an empty file and an empty folder have no rows; a truncated or damaged
file is an error.  Numbers fit any numeric column that holds them exactly (a double also takes
any integer); object ids are read as hexadecimal text or bytes.  Files whose names begin with
``_`` or ``.`` are not read.  Dumps are read through ``pyarrow.fs``.
"""

from __future__ import annotations

import calendar
import datetime as dt
import json
import re
import struct
from collections.abc import Iterable, Iterator, Sequence
from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from sluice.session import delete_at_exit, scratch_path

MOST_BYTES = (16 << 20) + (16 << 10)  # of one document, as the stores allow
CHUNK = 4 << 20
BATCH_ROWS, READ_ROWS, LINE_BYTES = 4096, 16384, 1 << 20
CHAIN = 4  # documents that must follow one another for a guess
LEAST, SHARE = 32, 16  # documents walked in one step: as many at least, and one in so many

# type codes of the format (fixed values): values of one size, and those led by a length
SIZES = {0x01: 8, 0x06: 0, 0x07: 12, 0x08: 1, 0x09: 8, 0x0A: 0, 0x10: 4, 0x11: 8, 0x12: 8, 0x13: 16, 0x7F: 0, 0xFF: 0}
TEXTS = (0x02, 0x0D, 0x0E)

_INT32, _INT64, _DOUBLE = struct.Struct("<i"), struct.Struct("<q"), struct.Struct("<d")


class Damaged(ValueError):
    """Bytes that are no document."""


def _length(buf: bytes, at: int) -> int:
    return _INT32.unpack_from(buf, at)[0]


def _end(buf: bytes, kind: int, at: int, end: int) -> int:
    """The end of a value of type ``kind`` at ``at``, within a document whose zero is at ``end``."""
    size = SIZES.get(kind)
    if size is None:
        if kind == 0x0B:  # two texts that end with zero
            size = buf.find(b"\0", buf.find(b"\0", at, end) + 1, end) + 1 - at
            if size < 2:
                raise Damaged("a pattern does not end")
        elif at + 4 > end:
            raise Damaged("a value has no length")
        elif kind in TEXTS or kind == 0x0C:
            size = 4 + _length(buf, at)
            if size < 5 or at + size > end or buf[at + size - 1]:
                raise Damaged("a text does not end with zero")
            size += 12 * (kind == 0x0C)
        elif kind in (0x03, 0x04, 0x0F):
            size = _length(buf, at)
            if size < 5 or at + size > end or (kind != 0x0F and buf[at + size - 1]):
                raise Damaged("a nested document does not end")
        elif kind == 0x05:
            if _length(buf, at) < 0:
                raise Damaged("negative length")
            size = 5 + _length(buf, at)
        else:
            raise Damaged(f"unknown type {kind}")
    if at + size > end:
        raise Damaged("a value reaches over its document")
    return at + size


def elements(buf: bytes, at: int, end: int) -> Iterator[tuple[int, bytes, int, int]]:
    """(type, name, first byte, end) of a document's values; ``buf[at:end]`` is the document."""
    if buf[end - 1]:
        raise Damaged("a document does not end with zero")
    end -= 1
    at += 4
    while at < end:
        kind = buf[at]
        stop = buf.find(b"\0", at + 1, end)
        if stop < 0:
            raise Damaged("a name does not end")
        name, at = buf[at + 1 : stop], stop + 1
        stop = _end(buf, kind, at, end)
        yield kind, name, at, stop
        at = stop


# ------------------------------------------------------------------ borders of documents
def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if ":" not in path.split("/")[0]:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def dump_files(path: str | Sequence[str]) -> list[tuple[str, int]]:
    """(file, bytes) in order of their names; folders are walked."""
    out = []
    for p in [path] if isinstance(path, str) else path:
        fs, inner = file_system(p)
        info = fs.get_file_info(inner)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(p)
        prefix = p[: len(p) - len(inner)] if p.endswith(inner) else ""
        if info.type == pafs.FileType.File:
            out.append((p, info.size))
            continue
        for f in fs.get_file_info(pafs.FileSelector(inner, recursive=True)):
            below = f.path[len(inner) :].strip("/").split("/")
            if f.type == pafs.FileType.File and not any(part[0] in "_." for part in below):
                out.append((prefix + f.path, f.size))
    return sorted(out)


class Window:
    """Bytes of a file read in chunks as a walk moves forward."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.buf, self.start = b"", 0

    def get(self, at: int, n: int) -> int:
        """Makes ``n`` bytes from ``at`` (fewer at the file's end) lie in ``buf``; their place there."""
        if at < self.start or at + n > self.start + len(self.buf):
            if at + n > self.size:
                n = max(0, self.size - at)
            if at < self.start or at + n > self.start + len(self.buf):
                self.file.seek(at)
                self.buf, self.start = self.file.read(min(self.size - at, max(n, CHUNK))), at
        return at - self.start

    def document(self, at: int) -> int:
        """The end of the document at ``at`` by its length."""
        i = self.get(at, 4)
        if len(self.buf) - i < 4:
            raise Damaged(f"{self.size - at} bytes at {at} are no document")
        n = _length(self.buf, i)
        if not 5 <= n <= MOST_BYTES or at + n > self.size:
            raise Damaged(f"a document of {n} bytes at {at}")
        return at + n

    def after(self, at: int, stop: int) -> int:
        """The first place from ``stop`` on that the lengths lead to from the document at ``at``."""
        length = _INT32.unpack_from
        while at < stop:
            at = self.document(at)
            buf, i = self.buf, at - self.start
            last, most = min(stop - self.start, len(buf) - 3), self.size - self.start
            while i < last:
                n = length(buf, i)[0]
                if not 5 <= n <= MOST_BYTES or i + n > most:
                    break  # told by the next ``document``
                i += n
            at = self.start + i
        return at

    def documents(self, at: int, stop: int, most: int) -> list[int]:
        """Places in ``buf`` of the documents from ``at`` on that lie whole in it, one at least,
        up to ``stop`` and ``most`` of them; the last place is the end of the last."""
        length = _INT32.unpack_from
        end = self.document(at)
        i = self.get(at, end - at)
        out = [i, i + end - at]
        buf, i = self.buf, out[-1]
        last, size = min(stop - self.start, len(buf) - 3), len(buf)
        while i < last and len(out) <= most:
            n = length(buf, i)[0]
            if not 5 <= n <= MOST_BYTES or i + n > size:
                break  # read or told by the next call
            i += n
            out.append(i)
        return out


# the zero that ends a document, a length below 32 MB, and a known type
_PLACE = re.compile(rb"\0(?=..[\0-\xff][\0\x01][\x01-\x13\x7f\xff])|\0(?=\x05\0\0\0\0)", re.S)


def guessed_start(w: Window, start: int, stop: int) -> int | None:
    """The first place in [start, stop) where some documents in a row, or all to the file's
    end, look right."""

    def right(at: int) -> bool:
        try:
            for _ in range(CHAIN):
                if at == w.size:
                    return True
                end = w.document(at)
                i = w.get(at, end - at)
                for _ in elements(w.buf, i, i + end - at):
                    pass
                at = end
        except Damaged:
            return False
        return True

    at = start - 1  # the byte before a document ends another one
    while at < stop - 1:
        i = w.get(at, CHUNK)
        block, base = w.buf, w.start
        last = min(len(block), stop - 1 - base)
        for m in _PLACE.finditer(block, i, min(len(block), last + 6)):
            place = base + m.end()
            if place >= stop:
                break
            if right(place):
                return place
        at = max(at + 1, base + last if base + last >= stop - 1 else base + len(block) - 6)
        if at >= w.size - 6:
            break
    return None


RANGE = "file string, size long, start long, stop long, entry long"


def _walks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range, the first document (guessed unless given) and the first one after its end;
    NULL where there is none to follow, with the fault of a given one."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            fs, inner = file_system(r["file"])
            with fs.open_input_file(inner) as f:
                w = Window(f, r["size"])
                at = entry = guessed_start(w, r["start"], r["stop"]) if r["entry"] is None else r["entry"]
                fault = None
                try:
                    if at is not None:
                        at = w.after(at, r["stop"])
                except Damaged as e:
                    at, fault = None, str(e)
                out.append((r["file"], r["start"], entry, at, fault))
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = zip(*out) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["file", "start", "entry", "exit", "fault"])


def dump_ranges(spark: SparkSession, files: list[tuple[str, int]], split_bytes: int) -> list[tuple[str, int, int]]:
    """(file, first document, end) of every range that has documents, proven."""
    cuts = {f: [(a, min(a + split_bytes, size)) for a in range(0, size, split_bytes)] for f, size in files}
    sizes = dict(files)
    # a given first document, for a file's first range and for those whose guess was wrong
    todo = [(f, sizes[f], a, b, 0 if a == 0 else None) for f, ranges in cuts.items() for a, b in ranges]
    led: dict[tuple[str, int], tuple] = {}
    open_files, out = set(cuts), {}
    while todo:
        # a range is walked in less time than its task takes to begin
        tasks = min(max(min(len(todo), 4 * spark.sparkContext.defaultParallelism), -(-len(todo) // 8)), 100_000)
        rows = spark.createDataFrame(todo, RANGE).repartition(tasks)
        answers = rows.mapInArrow(_walks, "file string, start long, entry long, exit long, fault string")
        for r in answers.collect():  # one small row a range
            led[r.file, r.start] = (r.entry, r.exit, r.fault)
        todo = []
        for f in sorted(open_files):
            at, found = 0, []
            for a, b in cuts[f]:
                if at >= b:
                    continue  # within a document that began before
                entry, leads_to, fault = led[f, a]
                if entry != at:
                    todo.append((f, sizes[f], a, b, at))
                    break
                if leads_to is None:
                    raise ValueError(f"{f}: {fault}")
                found.append((f, at, leads_to))
                at = leads_to
            else:
                out[f] = found
                open_files.discard(f)
    return [r for f, _ in files for r in out.get(f, [])]


# ------------------------------------------------------------------ values
class Unfit(Exception):
    """A value that is not of its column's type."""


def _decimal128(raw: bytes) -> Decimal:
    high, low = int.from_bytes(raw[8:], "little"), int.from_bytes(raw[:8], "little")
    if (high >> 59) & 0xF >= 0xE or (high >> 61) & 3 == 3:
        raise Unfit  # infinite, not a number, or a coefficient beyond 34 digits
    coefficient = (high & ((1 << 49) - 1)) << 64 | low
    return Decimal(coefficient).scaleb(((high >> 49) & 0x3FFF) - 6176, Context(prec=60)) * (-1 if high >> 63 else 1)


_WHOLE = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}


def _number(kind: int, buf: bytes, a: int, b: int):
    if kind == 0x10:
        return _INT32.unpack_from(buf, a)[0]
    if kind == 0x12:
        return _INT64.unpack_from(buf, a)[0]
    if kind == 0x01:
        return _DOUBLE.unpack_from(buf, a)[0]
    if kind == 0x13:
        return _decimal128(buf[a:b])
    raise Unfit


def value_of(kind: int, buf: bytes, a: int, b: int, want: T.DataType, strict: bool):
    """The value of type ``kind`` in ``buf[a:b]`` as the column's type takes it."""
    if kind in (0x0A, 0x06):
        return None
    if isinstance(want, T.StringType):
        if kind in TEXTS:
            return buf[a + 4 : b - 1].decode("utf-8", "strict" if strict else "replace")
        if kind == 0x07:
            return buf[a:b].hex()
    elif isinstance(want, T.BooleanType):
        if kind == 0x08:
            return buf[a] != 0
    elif type(want) in _WHOLE:
        x = _number(kind, buf, a, b)
        whole = int(x) if x == x and abs(x) < 1 << 64 else None
        bits = _WHOLE[type(want)]
        if whole is not None and whole == x and -(1 << bits) <= whole < 1 << bits:
            return whole
    elif isinstance(want, (T.DoubleType, T.FloatType)):
        return float(_number(kind, buf, a, b))
    elif isinstance(want, T.DecimalType):
        x = _number(kind, buf, a, b)
        x = Decimal(str(x)) if isinstance(x, float) else Decimal(x)
        if x.is_finite():
            rounded = x.quantize(Decimal(1).scaleb(-want.scale), context=Context(prec=60))
            if rounded == x and abs(x) < 10 ** (want.precision - want.scale):
                return rounded
    elif isinstance(want, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        if kind == 0x09:
            ms = _INT64.unpack_from(buf, a)[0]
            if isinstance(want, T.DateType):
                if abs(ms) < 86_400_000 << 31:
                    return ms // 86_400_000
            elif abs(ms) < (1 << 63) // 1000:
                return ms * 1000
    elif isinstance(want, T.BinaryType):
        if kind == 0x05:
            return buf[a + 5 : b]
        if kind == 0x07:
            return buf[a:b]
    elif isinstance(want, T.StructType):
        if kind == 0x03:
            return fields_of(buf, a, b, {f.name.encode(): f for f in want.fields}, strict)
    elif isinstance(want, T.ArrayType):
        if kind == 0x04:
            errors = "strict" if strict else "replace"
            text = 0x02 if type(want.elementType) is T.StringType else -1
            return [
                buf[x + 4 : y - 1].decode("utf-8", errors) if k == text else _fit(k, buf, x, y, want.elementType, strict)
                for k, _, x, y in elements(buf, a, b)
            ]
    elif isinstance(want, T.MapType):
        if kind == 0x03:
            return list({n.decode(): _fit(k, buf, x, y, want.valueType, strict) for k, n, x, y in elements(buf, a, b)}.items())
    raise Unfit


def _fit(kind: int, buf: bytes, a: int, b: int, want: T.DataType, strict: bool):
    try:
        return value_of(kind, buf, a, b, want, strict)
    except Unfit:
        if strict:
            raise ValueError(f"a value of type {kind} in a column of {want.simpleString()}") from None
        return None


def fields_of(buf: bytes, a: int, b: int, wanted: dict[bytes, T.StructField], strict: bool) -> dict:
    out = {f.name: None for f in wanted.values()}
    errors = "strict" if strict else "replace"
    texts = {n: f.name for n, f in wanted.items() if type(f.dataType) is T.StringType}
    return _fields(buf, a, b, wanted, texts, out, errors)


def _fields(buf: bytes, a: int, b: int, wanted: dict[bytes, T.StructField], texts: dict[bytes, str], out: dict, errors: str) -> dict:
    """``out`` filled with a document's values; texts, the most frequent type, are taken here."""
    at, end = a + 4, b - 1
    if buf[end]:
        raise Damaged("a document does not end with zero")
    find, length = buf.find, _INT32.unpack_from
    while at < end:
        stop = find(b"\0", at + 1, end)
        kind = buf[at]
        if stop < 0:
            raise Damaged("a name does not end")
        name, x = buf[at + 1 : stop], stop + 1
        if kind == 0x02:
            if x + 4 > end:
                raise Damaged("a value has no length")
            y = x + 4 + length(buf, x)[0]
            if y < x + 5 or y > end or buf[y - 1]:
                raise Damaged("a text does not end with zero")
            key = texts.get(name)
            if key is not None:
                out[key] = buf[x + 4 : y - 1].decode("utf-8", errors)
            elif name in wanted:
                f = wanted[name]
                out[f.name] = _fit(kind, buf, x, y, f.dataType, errors == "strict")
        else:
            y = _end(buf, kind, x, end)
            f = wanted.get(name)
            if f is not None:
                out[f.name] = _fit(kind, buf, x, y, f.dataType, errors == "strict")
        at = y
    return out


# ------------------------------------------------------------------ values of many documents
# size by type: those led by a length as the length and so many bytes more, others that are
# found one by one; types whose last byte is zero
_SIZE, _MORE, _LED, _ZERO = np.full(256, -1), np.zeros(256, np.int64), np.zeros(256, bool), np.zeros(256, bool)
for _kind, _size in SIZES.items():
    _SIZE[_kind] = _size
_LED[[*TEXTS, 0x03, 0x04, 0x0F, 0x05]] = _ZERO[[*TEXTS, 0x03, 0x04]] = True
_MORE[[*TEXTS, 0x05]] = [4] * len(TEXTS) + [5]
_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


class Block:
    """Bytes in which many documents are walked side by side."""

    def __init__(self, raw: bytes):
        self.buf = buf = raw + bytes(8)  # so that a number may be taken at any byte
        self.bytes = np.frombuffer(buf, np.uint8)
        self.words, self.longs, self.ints, self.doubles = (
            np.ndarray((len(raw) + 1,), kind, buf, 0, (1,)) for kind in ("<u8", "<i8", "<i4", "<f8")
        )
        self.last = len(raw)

    def begins(self, at: np.ndarray, stop: np.ndarray, text: bytes) -> np.ndarray:
        """Where ``text`` lies at ``at``, before ``stop``."""
        same = at + len(text) <= stop
        for k in range(0, len(text), 8):
            part = text[k : k + 8]
            words = self.words[np.minimum(at + k, self.last)]
            if len(part) < 8:
                words = words & np.uint64((1 << 8 * len(part)) - 1)
            same &= words == np.uint64(int.from_bytes(part, "little"))
        return same

    def ends(self, kind: np.ndarray, at: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ends of the values at ``at`` and whether they are proven as ``_end`` proves them."""
        if len(kind) and (kind == kind[0]).all():
            kind = kind[:1]  # most often all have the same type
        size, led = _SIZE[kind], _LED[kind]
        if led.any():
            length = self.ints[np.minimum(at, self.last)] + _MORE[kind]
            size = np.where(led, np.where((at + 4 <= stop) & (length >= 5), length, -1), size)
        end = at + size
        good = (size >= 0) & (end <= stop)
        zero = _ZERO[kind]
        if zero.any():
            good &= ~zero | (self.bytes[np.where(good, end - 1, 0)] == 0)
        return end, good


Places = tuple[np.ndarray, np.ndarray, np.ndarray]  # types, first bytes and ends of values; type 0: there is none


def places_of(block: Block, at: np.ndarray, end: np.ndarray, names: Iterable[bytes]) -> tuple[dict[bytes, Places], np.ndarray]:
    """Where the documents between ``at`` and ``end`` have their values of ``names``, and which
    documents are to be decoded alone."""
    n = len(at)
    found = {name: (np.zeros(n, np.uint8), np.zeros(n, np.int64), np.zeros(n, np.int64)) for name in names}
    alone = block.bytes[end - 1] != 0
    rows = np.flatnonzero(~alone)
    pos, stop = at[rows] + 4, end[rows] - 1
    while True:
        open_ = pos < stop
        if not open_.all():
            rows, pos, stop = rows[open_], pos[open_], stop[open_]
        if not len(rows):
            return found, alone
        # the element that the first document has next, in all documents that have it next
        first = int(pos[0])
        zero = block.buf.find(b"\0", first + 1, int(stop[0]))
        same = block.begins(pos + 1, stop, block.buf[first + 1 : zero + 1]) if zero >= 0 else np.arange(len(rows)) == 0
        pick = np.flatnonzero(same)
        if zero < 0 or len(pick) < max(LEAST, len(rows) // SHARE):
            alone[rows[pick]] = True
            pos[pick] = stop[pick]
            continue
        name = block.buf[first + 1 : zero]
        r, p, s = (rows, pos, stop) if len(pick) == len(rows) else (rows[pick], pos[pick], stop[pick])
        kind, value = block.bytes[p], p + (zero + 1 - first)
        after, good = block.ends(kind, value, s)
        if name in found:
            kinds, starts, stops = found[name]
            good &= kinds[r] == 0
            kinds[r], starts[r], stops[r] = kind, value, after
        if not good.all():
            alone[r[~good]] = True
            after = np.where(good, after, s)
        pos[pick] = after


def _merged(parts: list[tuple[np.ndarray, pa.Array]], n: int, kind: pa.DataType) -> pa.Array:
    """A column of ``n`` rows from parts, each with the numbers of its rows; NULL elsewhere."""
    if len(parts) == 1 and len(parts[0][0]) == n:
        return parts[0][1]
    if not parts:
        return pa.nulls(n, kind)
    place, k = np.zeros(n, np.int64), 0
    none = np.ones(n, bool)
    for rows, values in parts:
        place[rows], none[rows] = np.arange(k, k + len(rows)), False
        k += len(rows)
    return pa.concat_arrays([values for _, values in parts]).take(pa.array(place, mask=none))


def values_of(block: Block, places: Places, want: T.DataType, arrow: pa.DataType, strict: bool) -> pa.Array:
    """A column of the values at rising places, as ``value_of`` takes them one by one."""
    kinds, starts, stops = places
    parts = []
    for kind in np.flatnonzero(np.bincount(kinds, minlength=256)).tolist():
        if kind in (0, 0x0A, 0x06):
            continue
        rows = np.flatnonzero(kinds == kind)
        a, b = (starts, stops) if len(rows) == len(kinds) else (starts[rows], stops[rows])
        made = _made(block, kind, a, b, want, arrow, strict)
        if made is None:
            one_by_one = zip(a.tolist(), b.tolist())
            made = pa.array([_fit(kind, block.buf, x, y, want, strict) for x, y in one_by_one], arrow)
        parts.append((rows, made))
    return _merged(parts, len(kinds), arrow)


def _made(block: Block, kind: int, a: np.ndarray, b: np.ndarray, want: T.DataType, arrow: pa.DataType, strict: bool) -> pa.Array | None:
    """A column of values of one type in one step; None where they are taken one by one."""
    if isinstance(want, T.StringType):
        if kind in TEXTS:
            return _texts(block, a + 4, b - 1, arrow)
        if kind == 0x07:
            raw = block.bytes[a[:, None] + np.arange(12)]
            digits = np.stack([_DIGITS[raw >> 4], _DIGITS[raw & 15]], axis=2)
            ends = pa.py_buffer(np.arange(len(a) + 1, dtype=np.int32) * 24)
            return pa.Array.from_buffers(pa.string(), len(a), [None, ends, pa.py_buffer(digits.tobytes())]).cast(arrow)
    elif isinstance(want, T.BooleanType) and kind == 0x08:
        return pa.array(block.bytes[a] != 0)
    elif type(want) in _WHOLE and kind in (0x10, 0x12):
        x = block.ints[a].astype(np.int64) if kind == 0x10 else block.longs[a]
        most = (1 << _WHOLE[type(want)]) - 1
        if ((x <= most) & (x >= -most - 1)).all():
            return pa.array(x, pa.int64()).cast(arrow)
    elif isinstance(want, T.DoubleType) and kind in (0x01, 0x10, 0x12):
        x = block.doubles[a] if kind == 0x01 else (block.ints if kind == 0x10 else block.longs)[a]
        return pa.array(x.astype(np.float64), arrow)
    elif isinstance(want, (T.TimestampType, T.TimestampNTZType, T.DateType)) and kind == 0x09:
        ms, day = block.longs[a], isinstance(want, T.DateType)
        most = 86_400_000 << 31 if day else (1 << 63) // 1000
        if ((ms < most) & (ms > -most)).all():
            return pa.array((ms // 86_400_000).astype(np.int32) if day else ms * 1000).cast(arrow)
    elif isinstance(want, T.ArrayType) and kind == 0x04 and pa.types.is_list(arrow):
        return _lists(block, a, b, want, arrow, strict)
    return None


def _texts(block: Block, a: np.ndarray, b: np.ndarray, arrow: pa.DataType) -> pa.Array | None:
    """The bytes from ``a`` to ``b`` as texts, None if some are no UTF-8."""
    ends = np.empty(2 * len(a), np.int32)
    ends[::2], ends[1::2] = a, b
    # by turns a text and what lies between it and the next
    both = pa.Array.from_buffers(pa.binary(), max(0, len(ends) - 1), [None, pa.py_buffer(ends), pa.py_buffer(block.buf)])
    try:
        return both.take(pa.array(np.arange(0, len(ends), 2))).cast(pa.string()).cast(arrow)
    except pa.ArrowInvalid:
        return None


def _lists(block: Block, a: np.ndarray, b: np.ndarray, want: T.ArrayType, arrow: pa.DataType, strict: bool) -> pa.Array:
    """A column of the arrays from ``a`` to ``b``: the elements of one place are walked in one
    step.  Damaged arrays, those whose elements are not named by their places, and what remains
    of a few that are longer than the others are taken one by one."""
    alone = block.bytes[b - 1] != 0
    rows = np.flatnonzero(~alone)
    pos, stop, seen = a[rows] + 4, b[rows] - 1, []
    while True:
        open_ = pos < stop
        if not open_.all():
            rows, pos, stop = rows[open_], pos[open_], stop[open_]
        if len(rows) < LEAST:
            alone[rows] = True
            break
        head = str(len(seen)).encode() + b"\0"
        kind, value = block.bytes[pos], pos + 1 + len(head)
        after, good = block.ends(kind, value, stop)
        good &= block.begins(pos + 1, stop, head)
        if not good.all():
            alone[rows[~good]] = True
            rows, stop, kind, value, after = rows[good], stop[good], kind[good], value[good], after[good]
        seen.append((rows, kind, value, after))
        pos = after
    row, kind, value, after = (np.concatenate(x) for x in zip(*seen)) if seen else (np.zeros(0, np.int64),) * 4
    order = np.argsort(row, kind="stable")
    order = order[~alone[row[order]]]
    whole = np.flatnonzero(~alone)
    ends = np.concatenate([[0], np.cumsum(np.bincount(row[order], minlength=len(a))[whole])])
    inner = values_of(block, (kind[order].astype(np.uint8), value[order], after[order]), want.elementType, arrow.value_type, strict)
    parts = [(whole, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner, type=arrow))]
    if len(whole) < len(a):
        rest = np.flatnonzero(alone)
        lists = [_fit(0x04, block.buf, x, y, want, strict) for x, y in zip(a[rest].tolist(), b[rest].tolist())]
        parts.append((rest, pa.array(lists, arrow)))
    return _merged(parts, len(a), arrow)


def columns_of(block: Block, at: np.ndarray, end: np.ndarray, wanted: dict[bytes, T.StructField], kinds: dict[str, pa.DataType], strict: bool) -> dict[str, pa.Array]:
    """The fields ``wanted`` of the documents between ``at`` and ``end`` as columns."""
    places, alone = places_of(block, at, end, wanted)
    whole, rest = np.flatnonzero(~alone), np.flatnonzero(alone)
    out = {}
    singles = [fields_of(block.buf, x, y, wanted, strict) for x, y in zip(at[rest].tolist(), end[rest].tolist())]
    for name, f in wanted.items():
        own = places[name] if not singles else tuple(x[whole] for x in places[name])
        parts = [(whole, values_of(block, own, f.dataType, kinds[f.name], strict))]
        if singles:
            parts.append((rest, pa.array([r[f.name] for r in singles], kinds[f.name])))
        out[f.name] = _merged(parts, len(at), kinds[f.name])
    return out


# ------------------------------------------------------------------ the data source
class Range(InputPartition):
    def __init__(self, number: int, file: str, size: int, start: int, stop: int):
        self.number, self.file, self.size, self.start, self.stop = number, file, size, start, stop


class DocumentDump(DataSource):
    """``format("document_dump")`` with a schema; one task a file unless ``ranges`` names a
    list of ranges (``read_document_dump`` writes one)."""

    @classmethod
    def name(cls) -> str:
        return "document_dump"

    def schema(self):
        raise ValueError("document_dump needs a schema")

    def reader(self, schema: T.StructType) -> DumpReader:
        return DumpReader(dict(self.options), schema)


class DumpReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.options, self.columns = options, schema
        self.strict = options.get("mode", "PERMISSIVE").upper() == "FAILFAST"
        self.position = options.get("position")

    def partitions(self) -> list[Range]:
        if "ranges" in self.options:
            fs, inner = file_system(self.options["ranges"])
            with fs.open_input_file(inner) as f:
                return [Range(*r) for r in json.loads(f.read())]
        return [Range(k, f, size, 0, size) for k, (f, size) in enumerate(dump_files(self.options["path"]))]

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark makes of no ranges at all
            return
        kinds = to_arrow_schema(self.columns)
        wanted = {f.name.encode(): f for f in self.columns.fields if f.name != self.position}
        types = {f.name: f.type for f in kinds}
        fs, inner = file_system(partition.file)
        with fs.open_input_file(inner) as f:
            w, at = Window(f, partition.size), partition.start
            while at < partition.stop:
                places = np.array(w.documents(at, partition.stop, READ_ROWS), np.int64)
                block, borders = Block(w.buf[places[0] : places[-1]]), places - places[0]
                columns = columns_of(block, borders[:-1], borders[1:], wanted, types, self.strict)
                if self.position:
                    columns[self.position] = pa.array((partition.number << 44) + at + borders[:-1])
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in kinds], schema=kinds)
                at += int(borders[-1])


def read_document_dump(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    mode: str = "PERMISSIVE",
    position: str | None = None,
    split_bytes: int | None = None,
) -> DataFrame:
    """One row per document with the columns of ``schema``, by several tasks a file.
    ``position`` names one more column, each row's place in read order (files by name,
    then documents in the file), as ``first_read`` takes it."""
    if split_bytes is None:
        split_bytes = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    files = dump_files(path)
    number, sizes = {f: k for k, (f, _) in enumerate(files)}, dict(files)
    ranges = [(number[f], f, sizes[f], a, b) for f, a, b in dump_ranges(spark, files, split_bytes)]
    told = scratch_path(spark, "dump-ranges") + ".json"
    fs, inner = file_system(told)
    fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(inner) as out:
        out.write(json.dumps(ranges).encode())
    delete_at_exit(spark, told)
    if position:
        schema = T.StructType([*schema.fields, T.StructField(position, T.LongType())])
    spark.dataSource.register(DocumentDump)
    scan = spark.read.format("document_dump").schema(schema).option("ranges", told).option("mode", mode)
    return (scan.option("position", position) if position else scan).load()


# ------------------------------------------------------------------ writing
_EPOCH = dt.date(1970, 1, 1).toordinal()


def _encoded_decimal(x: Decimal) -> bytes:
    sign, digits, exponent = x.as_tuple()
    if len(digits) > 34:
        raise ValueError("a decimal of more than 34 digits")
    whole = int("".join(map(str, digits)))
    return (sign << 127 | (exponent + 6176) << 113 | whole).to_bytes(16, "little")


def _milliseconds(t: dt.datetime) -> int:
    if t.tzinfo is not None:
        t = t.astimezone(dt.timezone.utc)
    return calendar.timegm(t.timetuple()) * 1000 + t.microsecond // 1000


def encoded(name: str, value, want: T.DataType, object_id: bool = False) -> bytes:
    """One element: type, name and value."""
    head = name.encode()
    if b"\0" in head:
        raise ValueError("a field name with a zero")

    def put(kind: int, raw: bytes) -> bytes:
        return bytes([kind]) + head + b"\0" + raw

    if value is None:
        return put(0x0A, b"")
    if object_id:
        raw = bytes.fromhex(value)
        if len(raw) != 12:
            raise ValueError("an object id has 12 bytes")
        return put(0x07, raw)
    if isinstance(want, T.StringType):
        raw = value.encode()
        return put(0x02, _INT32.pack(len(raw) + 1) + raw + b"\0")
    if isinstance(want, T.BooleanType):
        return put(0x08, b"\1" if value else b"\0")
    if isinstance(want, (T.ByteType, T.ShortType, T.IntegerType)):
        return put(0x10, _INT32.pack(value))
    if isinstance(want, T.LongType):
        return put(0x12, _INT64.pack(value))
    if isinstance(want, (T.DoubleType, T.FloatType)):
        return put(0x01, _DOUBLE.pack(value))
    if isinstance(want, T.DecimalType):
        return put(0x13, _encoded_decimal(value))
    if isinstance(want, (T.TimestampType, T.TimestampNTZType)):
        return put(0x09, _INT64.pack(_milliseconds(value)))
    if isinstance(want, T.DateType):
        return put(0x09, _INT64.pack((value.toordinal() - _EPOCH) * 86_400_000))
    if isinstance(want, T.BinaryType):
        return put(0x05, _INT32.pack(len(value)) + b"\0" + value)
    if isinstance(want, T.StructType):
        return put(0x03, document([(f.name, value[f.name], f.dataType, False) for f in want.fields]))
    if isinstance(want, T.ArrayType):
        return put(0x04, document([(str(i), v, want.elementType, False) for i, v in enumerate(value)]))
    if isinstance(want, T.MapType):
        return put(0x03, document([(k, v, want.valueType, False) for k, v in value]))
    raise ValueError(f"no document type for {want.simpleString()}")


def document(fields: Iterable[tuple[str, object, T.DataType, bool]]) -> bytes:
    body = b"".join(encoded(*f) for f in fields)
    if len(body) + 5 > MOST_BYTES:
        raise ValueError(f"a document of {len(body) + 5} bytes")
    return _INT32.pack(len(body) + 5) + body + b"\0"


_BYTES = pa.large_binary()


def _packed(values: np.ndarray, kind: str) -> pa.Array:
    """Numbers as little-endian bytes, one binary value each."""
    raw = np.ascontiguousarray(values).astype(kind)
    buffer = pa.py_buffer(raw.tobytes())
    ends = pa.py_buffer(np.arange(len(raw) + 1, dtype=np.int64) * raw.itemsize)
    return pa.Array.from_buffers(_BYTES, len(raw), [None, ends, buffer])


def _joined(*parts: pa.Array | bytes) -> pa.Array:
    return pc.binary_join_element_wise(*[pa.scalar(p, _BYTES) if isinstance(p, bytes) else p for p in parts], pa.scalar(b"", _BYTES))


def _documents(*columns: pa.Array) -> pa.Array:
    """Documents from their elements, without the zero that ends them."""
    sizes = sum(pc.binary_length(c).to_numpy(zero_copy_only=False) for c in columns) + 5
    if len(sizes) and sizes.max() > MOST_BYTES:
        raise ValueError(f"a document of {sizes.max()} bytes")
    return _joined(_packed(sizes, "<i4"), *columns)


_NIBBLES = np.full(256, 16, np.uint8)
_NIBBLES[np.frombuffer(b"0123456789abcdefABCDEF", np.uint8)] = [*range(16), *range(10, 16)]


def _object_ids(values: pa.Array) -> pa.Array | None:
    """Bytes of hexadecimal digits (any bytes where NULL); None if a text is not 24 of them."""
    raw = pc.fill_null(values.cast(pa.large_string()), "0" * 24)
    _, ends, data = raw.buffers()
    ends = np.frombuffer(ends, np.int64)[raw.offset : raw.offset + len(raw) + 1] if len(raw) else np.zeros(1, np.int64)
    if len(raw) == 0 or (np.diff(ends) != 24).any():
        return None
    digits = _NIBBLES[np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]]
    if (digits > 15).any():
        return None
    return _packed((digits[::2] << 4 | digits[1::2]).view("V12"), "V12")


def _numbers(values: pa.Array, kind: str) -> pa.Array:
    return _packed(pc.fill_null(values, 0).to_numpy(zero_copy_only=False), kind)


def _payload(values: pa.Array, want: T.DataType) -> tuple[int, pa.Array] | None:
    """Type code and bytes of a column's values (any bytes where NULL); None for types that
    are encoded value by value."""
    if isinstance(want, T.StringType):
        raw = pc.fill_null(values.cast(pa.large_string()).cast(_BYTES), b"")
        return 0x02, _joined(_packed(pc.binary_length(raw).to_numpy(zero_copy_only=False) + 1, "<i4"), raw, b"\0")
    if isinstance(want, T.BooleanType):
        return 0x08, _numbers(values.cast(pa.int8()), "<i1")
    if isinstance(want, (T.ByteType, T.ShortType, T.IntegerType)):
        return 0x10, _numbers(values.cast(pa.int32()), "<i4")
    if isinstance(want, T.LongType):
        return 0x12, _numbers(values, "<i8")
    if isinstance(want, (T.DoubleType, T.FloatType)):
        return 0x01, _packed(pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False), "<f8")
    if isinstance(want, (T.TimestampType, T.TimestampNTZType)):
        micros = pc.fill_null(values.cast(pa.timestamp("us", values.type.tz)).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
        return 0x09, _packed(micros // 1000, "<i8")
    if isinstance(want, T.DateType):
        days = pc.fill_null(values.cast(pa.int32()), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        return 0x09, _packed(days * 86_400_000, "<i8")
    if isinstance(want, T.ArrayType):
        counts = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(counts)])
        places = pa.array(np.arange(ends[-1]) - np.repeat(ends[:-1], counts), pa.int64())
        names = places.cast(pa.large_string()).cast(_BYTES)
        lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), _elements(names, pc.list_flatten(values), want.elementType))
        return 0x04, _joined(_documents(pc.binary_join(lists, pa.scalar(b"", _BYTES))), b"\0")
    return None


def _elements(names: pa.Array | bytes, values: pa.Array, want: T.DataType, object_id: bool = False) -> pa.Array:
    """A column's values as elements, as ``encoded`` makes them one by one."""
    if object_id:
        raw = _object_ids(values)
        found = None if raw is None else (0x07, raw)
    else:
        found = _payload(values, want)
    if found is None:
        heads = [names.decode()] * len(values) if isinstance(names, bytes) else [n.decode() for n in names.to_pylist()]
        return pa.array([encoded(n, v, want, object_id) for n, v in zip(heads, values.to_pylist())], _BYTES)
    kind, raw = found

    def head(kind: bytes) -> list:
        return [kind + names + b"\0"] if isinstance(names, bytes) else [kind, names, b"\0"]

    whole = _joined(*head(bytes([kind])), raw)
    if not values.null_count:
        return whole
    return pc.if_else(values.is_valid(), whole, pc.fill_null(_joined(*head(b"\x0a"), pa.array([b""] * len(values), _BYTES)), b""))


def _lines(documents: pa.Array) -> pa.Array:
    """Documents, without the zero that ends the last of a line, as lines of about ``LINE_BYTES``."""
    whole = _joined(documents, b"\0")
    _, ends, data = whole.buffers()
    ends = np.frombuffer(ends, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    lines, k = [], 0
    while k < len(whole):
        after = max(k + 1, int(np.searchsorted(ends, ends[k] + LINE_BYTES, "right")) - 1)
        lines.append(data[int(ends[k]) : int(ends[after]) - 1].to_pybytes())
        k = after
    return pa.array(lines, _BYTES)


def write_document_dump(df: DataFrame, path: str, object_ids: Sequence[str] = ()) -> None:
    """Writes rows as documents, a file a partition, in the partitions' order; the text
    columns ``object_ids`` (24 hexadecimal digits) become object ids.  Times are kept to the
    millisecond.  Files are committed by Spark's own sink: a document ends with a zero, which is
    the sink's line end, so that some documents without the last one's zero are a line."""
    schema = df.schema

    if any("\0" in f.name for f in schema.fields):
        raise ValueError("a field name with a zero")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                rows = batch.slice(at, BATCH_ROWS)
                columns = [_elements(f.name.encode(), rows.column(k), f.dataType, f.name in object_ids) for k, f in enumerate(schema.fields)]
                body = columns or [pa.array([b""] * rows.num_rows, _BYTES)]
                yield pa.RecordBatch.from_arrays([_lines(_documents(*body))], names=["line"])

    lines = df.mapInArrow(run, "line binary").select(F.col("line").cast("string").alias("value"))
    lines.write.option("lineSep", "\0").text(path)
