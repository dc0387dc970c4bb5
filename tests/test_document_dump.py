"""Binary document dumps read by ranges: every type, borders in any range, damaged files."""

import datetime as dt
import os
import random
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.dedupe import first_read
from sluice.sources import read_document_dump, write_document_dump
from sluice.sources.document_dump import DocumentDump, document, dump_files, dump_ranges, elements, fields_of

ALL = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("t", T.StringType()), T.StructField("b", T.BooleanType()),
    T.StructField("i", T.IntegerType()), T.StructField("l", T.LongType()), T.StructField("x", T.DoubleType()),
    T.StructField("d", T.DecimalType(20, 3)), T.StructField("day", T.DateType()), T.StructField("at", T.TimestampNTZType()),
    T.StructField("raw", T.BinaryType()), T.StructField("m", T.MapType(T.StringType(), T.LongType())),
    T.StructField("s", T.StructType([T.StructField("a", T.ArrayType(T.StringType())), T.StructField("n", T.LongType())])),
    T.StructField("deep", T.ArrayType(T.StructType([T.StructField("k", T.StringType())]))),
])


def rows(n, seed=0):
    r = random.Random(seed)
    # texts and bytes that look like documents themselves
    inner = document([("k", "x" * 9, T.StringType(), False)])
    tricks = [inner * 5, b"\0" * 60, b"\5\0\0\0\0" * 30, struct.pack("<i", 12) + b"\x10a\0\1\0\0\0\0", b""]
    out = []
    for k in range(n):
        trick = r.choice(tricks)
        out.append((
            f"{k:024x}", r.choice(["", "plain", "é\0ü", trick.decode("latin-1")]), r.random() < 0.5, r.randrange(-5, 5), r.randrange(-(1 << 60), 1 << 60),
            r.choice([0.0, -1.5, 1e300]), Decimal(r.randrange(-(10**12), 10**12)).scaleb(-3), dt.date(1960, 1, 1) + dt.timedelta(days=k),
            dt.datetime(1950, 1, 1, 0, 0, 0, 123000) + dt.timedelta(hours=7919 * k), bytearray(trick), {"p": 1, "q": None},
            ([trick.decode("latin-1"), None], k), [{"k": "z" * r.randrange(60)}, None],
        ) if r.random() < 0.9 else (None,) * 13)
    return out


@pytest.mark.parametrize("size", [97, 1500, 1 << 27])
def test_round_trip_in_any_range(spark, tmp_dir, size):
    df = spark.createDataFrame(rows(120), ALL).repartition(2)
    path = os.path.join(tmp_dir, "d")
    write_document_dump(df, path, object_ids=["_id"])
    files = dump_files(path)
    got = read_document_dump(spark, path, ALL, mode="FAILFAST", split_bytes=max(size, sum(n for _, n in files) // 60))
    key = lambda x: sorted(map(repr, x.collect()))
    assert key(got) == key(df)


def test_guesses_are_proven(spark, tmp_dir):
    # a range lies within a value that is itself a long row of right documents
    decoy = document([("k", "y" * 20, T.StringType(), False)]) * 400
    docs = [document([("n", k, T.IntegerType(), False), ("raw", decoy, T.BinaryType(), False)]) for k in range(5)]
    path = os.path.join(tmp_dir, "x.bson")
    with open(path, "wb") as f:
        f.write(b"".join(docs))
    starts = [sum(map(len, docs[:k])) for k in range(5)]
    ranges = dump_ranges(spark, dump_files(path), 1000)
    assert [a for _, a, _ in ranges] == starts
    schema = T.StructType([T.StructField("n", T.LongType())])
    assert sorted(r.n for r in read_document_dump(spark, path, schema, split_bytes=1000).collect()) == [0, 1, 2, 3, 4]


def test_read_order(spark, tmp_dir):
    df = spark.range(0, 300, 1, 3).select((F.col("id") % 7).cast("string").alias("key"), F.col("id").alias("n"))
    path = os.path.join(tmp_dir, "d")
    write_document_dump(df, path)
    got = read_document_dump(spark, path, df.schema, position="_position", split_bytes=500)
    placed = [r.n for r in got.orderBy("_position").collect()]
    assert placed == list(range(300))
    assert sorted(map(tuple, first_read(got, ["key"]).collect())) == [(str(k), k) for k in range(7)]


def test_values_that_do_not_fit(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x.bson")
    one = document([("n", "text", T.StringType(), False), ("n", 7, T.IntegerType(), False), ("x", 3, T.LongType(), False), ("other", "o", T.StringType(), False)])
    two = document([("n", 2.5, T.DoubleType(), False), ("x", True, T.BooleanType(), False)])
    with open(path, "wb") as f:
        f.write(one + two + b"\5\0\0\0\0")
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType()), T.StructField("none", T.StringType())])
    got = read_document_dump(spark, path, schema)
    assert sorted(map(tuple, got.collect()), key=repr) == [(7, 3.0, None), (None, None, None), (None, None, None)]
    with pytest.raises(Exception, match="a value of type"):
        read_document_dump(spark, path, schema, mode="FAILFAST").collect()


def test_empty_and_damaged(spark, tmp_dir):
    schema = T.StructType([T.StructField("n", T.IntegerType())])
    empty = os.path.join(tmp_dir, "e")
    os.makedirs(empty)
    assert read_document_dump(spark, empty, schema).count() == 0
    for name in ("_SUCCESS", ".x.crc", "a.bson"):
        open(os.path.join(empty, name), "wb").close()
    assert read_document_dump(spark, empty, schema, position="_p").collect() == []
    whole = document([("n", 1, T.IntegerType(), False)]) * 3
    for bad in (whole[:-1], whole + b"\1", b"\3\0\0\0" + whole):
        path = os.path.join(tmp_dir, f"bad{len(bad)}{bad[0]}")
        with open(path, "wb") as f:
            f.write(bad)
        with pytest.raises(ValueError, match="document"):
            read_document_dump(spark, path, schema, split_bytes=9)
    with pytest.raises(FileNotFoundError):
        read_document_dump(spark, os.path.join(tmp_dir, "nowhere"), schema)


def test_plain_format(spark, tmp_dir):
    df = spark.range(50).withColumn("t", F.lit("x"))
    path = os.path.join(tmp_dir, "d")
    write_document_dump(df, path)
    spark.dataSource.register(DocumentDump)
    got = spark.read.format("document_dump").schema(df.select("id").schema).load(path)
    assert sorted(r.id for r in got.collect()) == list(range(50))


def test_known_bytes():
    # the format's own examples: {"hello": "world"} and {"BSON": ["awesome", 5.05, 1986]}
    hello = b"\x16\x00\x00\x00\x02hello\x00\x06\x00\x00\x00world\x00\x00"
    nested = b"\x31\x00\x00\x00\x04BSON\x00\x26\x00\x00\x00\x020\x00\x08\x00\x00\x00awesome\x00\x011\x00\x33\x33\x33\x33\x33\x33\x14\x40\x102\x00\xc2\x07\x00\x00\x00\x00"
    assert document([("hello", "world", T.StringType(), False)]) == hello
    assert [e[:2] for e in elements(nested, 0, len(nested))] == [(4, b"BSON")]
    want = T.StructField("BSON", T.ArrayType(T.DoubleType()))
    assert fields_of(nested, 0, len(nested), {b"BSON": want}, False) == {"BSON": [None, 5.05, 1986.0]}


def test_columns_are_encoded_as_single_values(spark):
    import datetime as dt
    from decimal import Decimal

    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    from sluice.sources.document_dump import _documents, _elements, _joined, document

    schema = T._parse_datatype_string(
        "_id string, s string, b boolean, y byte, i int, l long, f float, d double, t timestamp_ntz, z timestamp, day date, n decimal(9,2), "
        "raw binary, a array<string>, aa array<array<int>>, st struct<x:int,y:array<string>>, m map<string,long>, as array<struct<x:int>>"
    )
    t = dt.datetime(1969, 12, 31, 23, 59, 59, 999_501)
    full = ("0123456789abcdef01234567", "tëxt\n", True, -3, 1 << 30, -(1 << 60), 0.5, -1e300, t, t.replace(tzinfo=dt.timezone.utc), dt.date(1950, 2, 3),
            Decimal("-12.30"), b"\0\1", ["a", None, ""], [[1, None], None, []], {"x": 1, "y": ["q"]}, [("k", 1), ("j", None)], [{"x": 2}, None])
    rows = [full, (None,) * len(full), full[:1] + ("",) + (None,) * 11 + ([], []) + (None,) * 3, full]
    kinds = to_arrow_schema(schema)
    whole = pa.RecordBatch.from_pylist([dict(zip(kinds.names, r)) for r in [full, *rows]], schema=kinds)
    for batch in (whole.slice(1), whole.slice(2, 1)):  # slices have offsets
        columns = [_elements(f.name.encode(), batch.column(k), f.dataType, f.name == "_id") for k, f in enumerate(schema.fields)]
        want = [document([(f.name, r[f.name], f.dataType, f.name == "_id") for f in schema.fields])[:-1] for r in batch.to_pylist()]
        assert _documents(_joined(*columns)).to_pylist() == want


TEXTS, POINT = T.ArrayType(T.StringType()), T.StructType([T.StructField("x", T.IntegerType())])
ODD = T.StructType([T.StructField(name, kind) for name, kind in {
    "_id": T.StringType(), "t": T.StringType(), "b": T.BooleanType(), "i": T.IntegerType(), "y": T.ByteType(), "l": T.LongType(),
    "x": T.DoubleType(), "f": T.FloatType(), "at": T.TimestampType(), "n": T.TimestampNTZType(), "day": T.DateType(), "d": T.DecimalType(9, 2),
    "raw": T.BinaryType(), "a": TEXTS, "aa": T.ArrayType(T.ArrayType(T.IntegerType())), "st": POINT, "ax": T.ArrayType(T.DoubleType()),
    "m": T.MapType(T.StringType(), T.LongType()),
}.items()])


def odd_documents(n, seed):
    """Documents with fields in any order, missing, of other types and repeated; with texts that are no UTF-8."""
    r = random.Random(seed)
    text = lambda: r.choice([b"", b"plain", "é€😀".encode(), b"\0" * 9, b"\xff\xed\xa0\x80", bytes([r.randrange(32, 127)]) * r.randrange(300)])
    long = lambda x: struct.pack("<i", len(x) + 1) + x + b"\0"
    nest = lambda x: struct.pack("<i", len(x) + 5) + x + b"\0"

    def value(kind):
        if kind in (2, 13, 14):
            return long(text() if r.random() < 0.05 else text().decode("utf-8", "ignore").encode())
        if kind == 4:
            inner = r.choice([2, 2, 16, 10, 4]) if r.random() < 0.9 else 7
            names = [str(k) if r.random() < 0.99 else "q" for k in range(r.choice([0, 1, 2, 40]))]
            return nest(b"".join(bytes([k]) + name.encode() + b"\0" + (value(k) if k != 4 else nest(b"\x10" + b"0\0" + value(16))) for name in names for k in [inner if r.random() < 0.9 else 10]))
        if kind == 3:
            return nest(b"\x10x\0" + value(16))
        if kind == 5:
            x = text()
            return struct.pack("<i", len(x)) + b"\0" + x
        if kind == 11:
            return b"ab\0i\0"
        if kind == 12:
            return long(b"db") + bytes(12)
        if kind == 15:
            return nest(b"code")
        if kind == 1:
            return struct.pack("<d", r.choice([0.5, -3.0, 1e30, float("nan")]))
        if kind == 16:
            return struct.pack("<i", r.choice([0, -1, 200, -(1 << 31)]))
        if kind in (9, 18):
            return struct.pack("<q", r.choice([0, -1, 77, 86_400_000 * 9 + 1, -(1 << 41)] + [-(1 << 63), (1 << 63) - 1] * (r.random() < 0.01)))
        if kind == 8:
            return r.choice([b"\0", b"\1", b"\2"])
        if kind == 19:
            return struct.pack("<QQ", r.randrange(9), (6176 << 49))
        return bytes(r.randrange(256) for _ in range({7: 12, 17: 8}.get(kind, 0)))

    usual = {"_id": 7, "t": 2, "b": 8, "i": 16, "y": 16, "l": 18, "x": 1, "f": 1, "at": 9, "n": 9, "day": 9, "d": 19, "raw": 5, "a": 4, "aa": 4, "st": 3, "ax": 4, "m": 3, "other": 2}
    kinds = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 127, 255]
    out = []
    for _ in range(n):
        fields = [(name, kind) for name, kind in usual.items() if r.random() < 0.97]
        if r.random() < 0.05:
            r.shuffle(fields)
        if r.random() < 0.05:
            fields += r.choices(fields, k=2) if fields else []
        out.append(nest(b"".join(bytes([k]) + name.encode() + b"\0" + value(k) for name, kind in fields for k in [kind if r.random() < 0.98 else r.choice([10, r.choice(kinds)])])))
    return out


@pytest.mark.parametrize("n", [0, 1, 31, 40, 900])
@pytest.mark.parametrize("strict", [False, True])
def test_many_documents_are_decoded_as_single_ones(n, strict):
    import numpy as np
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    from sluice.sources.document_dump import Block, columns_of

    wanted, kinds = {f.name.encode(): f for f in ODD.fields}, {f.name: f.type for f in to_arrow_schema(ODD)}
    docs = odd_documents(n, n)

    def single(d):
        try:
            return fields_of(d, 0, len(d), wanted, strict)
        except ValueError:
            return None

    if strict:  # those that are no error
        if docs and not all(map(single, docs)):
            ends = np.cumsum([0, *map(len, docs)])
            with pytest.raises(ValueError):
                columns_of(Block(b"".join(docs)), ends[:-1], ends[1:], wanted, kinds, strict)
        docs = [d for d in docs if single(d)]
    ends = np.cumsum([0, *map(len, docs)]).astype(np.int64)
    got = columns_of(Block(b"".join(docs)), ends[:-1], ends[1:], wanted, kinds, strict)
    one_by_one = [single(d) for d in docs]
    for name, kind in kinds.items():
        want = pa.array([x[name] for x in one_by_one], kind)
        assert got[name].type == kind and got[name].null_count == want.null_count
        assert repr(got[name].to_pylist()) == repr(want.to_pylist()), name
    if n > 32 and not strict:  # a damaged one is found among the others
        for bad in (docs[5][:-1] + b"\1", struct.pack("<i", 12) + b"\x10i\0\1\0\0\0", struct.pack("<i", 14) + b"\x02t\0\xff\xff\xff\x7fa\0\0", struct.pack("<i", 8) + b"\x10i\0\0"):
            some = [*docs[:20], bad, *docs[20:]]
            ends = np.cumsum([0, *map(len, some)])
            with pytest.raises(ValueError, match="document|value|text|name"):
                columns_of(Block(b"".join(some)), ends[:-1], ends[1:], wanted, kinds, strict)


def test_documents_of_one_shape_are_decoded_together(tmp_dir, monkeypatch):
    from sluice.sources import document_dump as dump

    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("a", TEXTS), T.StructField("n", T.LongType()), T.StructField("_p", T.LongType())])
    docs = [document([("s", f"text {k}" if k % 3 else None, T.StringType(), False), ("a", ["x"] * (k % 4), TEXTS, False), ("n", k, T.IntegerType(), False)]) for k in range(500)]
    path = os.path.join(tmp_dir, "x.bson")
    with open(path, "wb") as f:
        f.write(b"".join(docs))

    def alone(*_):
        raise AssertionError("a document is decoded alone")

    for name in ("_fields", "value_of", "_end"):
        monkeypatch.setattr(dump, name, alone)
    size = sum(map(len, docs))
    reader = dump.DumpReader({"mode": "FAILFAST", "position": "_p"}, schema)
    rows = [r for b in reader.read(dump.Range(1, path, size, 0, size)) for r in b.to_pylist()]
    places = [(1 << 44) + sum(map(len, docs[:k])) for k in range(500)]
    assert [tuple(r.values()) for r in rows] == [(f"text {k}" if k % 3 else None, ["x"] * (k % 4), k, places[k]) for k in range(500)]


def test_lines_hold_many_documents(monkeypatch):
    import pyarrow as pa

    from sluice.sources import document_dump as dump

    monkeypatch.setattr(dump, "LINE_BYTES", 1000)
    docs = [document([("t", "x" * n, T.StringType(), False)]) for n in (0, 10, 3000, 900, 80, 5)] + [b"\5\0\0\0\0"] * 300
    lines = dump._lines(pa.array([b"left out", *[d[:-1] for d in docs]], pa.large_binary()).slice(1)).to_pylist()
    assert b"".join(x + b"\0" for x in lines) == b"".join(docs)
    assert len(lines) == 5 and all(len(x) < 1000 for x in lines if x + b"\0" not in docs)
    assert dump._lines(pa.array([], pa.large_binary())).to_pylist() == []


def test_object_ids_in_one_step():
    import pyarrow as pa

    from sluice.sources.document_dump import _object_ids

    ids = ["0123456789abcdefABCDEF00", None, "ff" * 12, "00" * 12]
    got = _object_ids(pa.array(["skipped", *ids]).slice(1)).to_pylist()
    assert [g for g, i in zip(got, ids) if i] == [bytes.fromhex(i) for i in ids if i]
    for other in ("0" * 23, "0" * 26, "g" * 24, " " + "0" * 23, "é" + "0" * 22):  # told, or taken, one by one
        assert _object_ids(pa.array([ids[0], other])) is None
