"""WARC archives: a writer, the normaliser of whole-file gzip streams, and a reader by
offset (operator 1).

``write_archives`` writes each page as a WARC record into archives that are one gzip
stream each.  ``normalise`` inflates such a stream once, from its beginning, with
bounded memory, writes every record again as a gzip member of its own, and puts an
index of offsets beside the archive.  ``read_records`` fetches records by these
offsets, in any order and from any number of tasks.

Files go to the shared folder through ``pyarrow.fs``, under names that no other
attempt uses; only those in the returned manifest count, which Spark's own committed
output holds, so that lost or repeated tasks leave no trace in the result.

Results for edge cases: a null payload is empty; records with equal payloads of at
least ``min_revisit_bytes`` bytes revisit the one with the smallest id, rows that
repeat this id are responses too; a row with a null id is a response unless an equal
payload has an id; a null URL gives no target; an empty table gives no archives; an
empty archive has no records; a truncated or malformed archive raises an error.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import arrow_map, staged
from sluice.session import delete_at_exit, scratch_path

PIECE = 1 << 20
END = b"\r\n\r\n"
MOST_HEADER_BYTES = 1 << 20


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if ":" not in path.split("/")[0]:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(ident, digest: str) -> str:
    return f"<urn:page:{'' if ident is None else ident}:{digest}>"


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(ident, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """A response, or a revisit of ``refers_to`` without the payload."""
    digest = digest32(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if refers_to is None else b"")
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(ident, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        fields.insert(3, f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        fields += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
        ]
    return "\r\n".join(fields).encode() + END + block + END


# ------------------------------------------------------------------ writing
def _write(folder: str, date: str, file_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        out = pack = name = None
        size = count = 0

        def close() -> pa.RecordBatch:
            out.write(pack.flush())
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"]), pa.array([count], pa.int64())], names=["path", "records"]
            )

        for batch in batches:
            for ident, url, payload, first in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "payload", "first"))):
                if out is None:
                    name, size, count = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = record(ident, url, payload, None if first == ident else first, date)
                out.write(pack.compress(data))
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return run


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 0,
    date: str = "2000-01-01T00:00:00Z",
    file_bytes: int = 48 << 20,
) -> DataFrame:
    """Writes the pages below ``folder`` and returns the manifest (path, records)."""
    spark = pages.sparkSession
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    # one short row per payload that occurs again; the join splits hot payloads (AQE skew join)
    repeated = (
        rows.where(F.length("payload") >= min_revisit_bytes)
        .groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("digest", "first")
    )
    marked = rows.join(repeated, "digest", "left").select("id", "url", "payload", "first")
    return staged(spark, marked.transform(arrow_map, _write(folder, date, file_bytes), "path string, records bigint"), "warc-manifest")


# ------------------------------------------------------------------ streams
class Inflater:
    """Bytes of a gzip stream of any number of members (or of plain data), piece by piece."""

    def __init__(self, source):
        self.source, self.engine, self.plain, self.ended = source, None, False, False
        self.left = b""

    def read(self) -> bytes:
        """Some more bytes; nothing at the end."""
        while True:
            data = self.left or self.source.read(PIECE)
            self.left = b""
            if not data:
                if self.engine is not None:
                    raise ValueError("the gzip stream ends within a member")
                return b""
            if self.engine is None:
                if self.plain or not data.startswith(b"\x1f"):
                    self.plain = True
                    return data
                self.engine = zlib.decompressobj(31)
            out = self.engine.decompress(data, 8 * PIECE)
            if self.engine.eof:
                self.left, self.engine = self.engine.unused_data, None
            else:
                self.left = self.engine.unconsumed_tail
            if out:
                return out


def parse_header(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    out: dict[str, str] = {}
    last = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            out[last] = value.strip()
    return out


def stream_records(inflater: Inflater) -> Iterator[tuple[dict[str, str], bytes, Iterator[bytes]]]:
    """(fields, raw header, pieces of the block) of every record; the pieces must be
    used up before the next record is asked for."""
    have = bytearray()

    def more() -> bool:
        piece = inflater.read()
        have.extend(piece)
        return bool(piece)

    while True:
        while True:  # blank lines between records
            while have[:2] == b"\r\n":
                del have[:2]
            if len(have) >= 5 or not more():
                break
        if not have.strip():
            return
        at = have.find(END)
        while at < 0:
            seen = max(0, len(have) - 3)
            if len(have) > MOST_HEADER_BYTES or not more():
                raise ValueError("a WARC header without an end")
            at = have.find(END, seen)
        header = bytes(have[: at + 4])
        del have[: at + 4]
        fields = parse_header(header)
        need = int(fields["content-length"])

        def block(need: int = need) -> Iterator[bytes]:
            while need:
                if not have and not more():
                    raise ValueError("the archive ends within a record")
                piece = bytes(have[:need])
                del have[: len(piece)]
                need -= len(piece)
                yield piece

        yield fields, header, block()


INDEX = (
    "archive string, offset bigint, length bigint, record_id string, record_type string, "
    "target_uri string, payload_digest string, refers_to string"
)
_FIELDS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
}


def _index_batch(rows: list[dict]) -> pa.RecordBatch:
    names = [c.split()[0] for c in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], pa.int64() if n in ("offset", "length") else pa.string()) for n in names],
        names=names,
    )


def _normalise(folder: str, level: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                source_fs, source_path = file_system(path)
                name = re.sub(r"\.gz$", "", path.rsplit("/", 1)[-1]) + f".{uuid.uuid4().hex[:12]}.gz"
                rows: list[dict] = []
                with (
                    source_fs.open_input_stream(source_path, compression=None) as source,
                    fs.open_output_stream(f"{base}/{name}", compression=None) as out,
                    fs.open_output_stream(f"{base}/{name}.index.jsonl", compression=None) as index,
                ):
                    offset = 0
                    for fields, header, block in stream_records(Inflater(source)):
                        pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                        start = offset
                        for piece in chain([header], block, [END]):
                            data = pack.compress(piece)
                            out.write(data)
                            offset += len(data)
                        data = pack.flush()
                        out.write(data)
                        offset += len(data)
                        row = {"archive": f"{folder}/{name}", "offset": start, "length": offset - start}
                        row |= {k: fields.get(v) for k, v in _FIELDS.items()}
                        index.write(json.dumps(row, ensure_ascii=False).encode() + b"\n")
                        rows.append(row)
                        if len(rows) >= 2000:
                            yield _index_batch(rows)
                            rows = []
                if rows:
                    yield _index_batch(rows)

    return run


def normalise(archives: DataFrame, folder: str, path_col: str = "path", level: int = 4) -> DataFrame:
    """Rewrites the archives named in ``path_col`` below ``folder``, one gzip member a
    record, each with its index beside it, and returns the index of all records.  One
    task handles an archive at a time (a whole-file stream has no other way in)."""
    spark = archives.sparkSession
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    paths = archives.select(F.col(path_col).alias("path"))
    dealt = paths.repartition(spark.sparkContext.defaultParallelism * 4)
    return staged(spark, dealt.transform(arrow_map, _normalise(folder, level), INDEX), "warc-index")


RECORD = (
    "record_id string, record_type string, target_uri string, payload binary, payload_bytes bigint, "
    "payload_digest string, refers_to string"
)


def _fetch(with_payload: bool):
    names = [c.split()[0] for c in RECORD.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, pafs.RandomAccessFile] | None = None
        for batch in batches:
            rows, size = [], 0
            for path, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if opened is None or opened[0] != path:
                    if opened:
                        opened[1].close()
                    fs, inner = file_system(path)
                    opened = (path, fs.open_input_file(inner))
                data = zlib.decompress(opened[1].read_at(length, offset), 31)
                at = data.index(END) + 4
                fields = parse_header(data[:at])
                block = data[at : at + int(fields["content-length"])]
                payload = block.split(END, 1)[1]
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                if fields["warc-type"] == "response" and (
                    digest != digest32(payload) or len(payload) != int(fields["warc-payload-length"])
                ):
                    raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
                rows.append({
                    "record_id": fields["warc-record-id"], "record_type": fields["warc-type"],
                    "target_uri": fields.get("warc-target-uri"), "payload": payload if with_payload else None,
                    "payload_bytes": int(fields["warc-payload-length"]), "payload_digest": digest,
                    "refers_to": fields.get("warc-refers-to"),
                })
                size += len(payload) if with_payload else 0
                if size >= 32 << 20:
                    yield _record_batch(rows, names)
                    rows, size = [], 0
            if rows:
                yield _record_batch(rows, names)
        if opened:
            opened[1].close()

    return run


def _record_batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    kinds = {"payload": pa.binary(), "payload_bytes": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names=names)


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of an index, checked against their digests; revisits have an empty
    payload.  Every row is fetched by its own offset, so that any split of the index
    can be read by any task."""
    rows = index.select("archive", "offset", "length")
    return rows.transform(arrow_map, _fetch(with_payload), RECORD)


def page_of(record_id_col: str) -> Column:
    """The page id within a record id; null if it has none."""
    return F.nullif(F.regexp_extract(record_id_col, r"^<urn:page:(-?\d*):", 1), F.lit("")).cast("long")


def archive_round_trip(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 0
) -> DataFrame:
    """Pages to archives, archives normalised, records read back by offset: ``id,
    payload_bytes, payload_digest, record_type, refers_to`` for every page."""
    spark: SparkSession = pages.sparkSession
    raw, packed = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    archives = write_archives(pages, raw, id_col, url_col, payload_col, min_revisit_bytes)
    index = normalise(archives, packed)
    for folder in (raw, packed):
        delete_at_exit(spark, folder)
    return read_records(index, with_payload=False).select(
        page_of("record_id").alias(id_col),
        "payload_bytes", "payload_digest", "record_type",
        page_of("refers_to").alias("refers_to"),
    )
