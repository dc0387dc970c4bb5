"""CSV with quoted line breaks, read in many ranges, against pandas."""

import random

import pandas as pd
import pytest

from sluice.operators.loads import write_csv
from sluice.sources.files import read_csv
from sluice.sources.quoted_csv import ends_inside, quoted_lines, quoted_records

SCHEMA = "id int, text string, more string"


@pytest.fixture()
def small_ranges(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    for k, v in keep.items():
        spark.conf.set(k, v)


def field(r):
    text = "".join(r.choices(["a", "bc", ",", "\n", "\r\n", '"', " ", "é", "5\"", "\n\n", '""'], k=r.randrange(9)))
    return text


def spelled(text, r):
    if any(c in text for c in ',"\r\n') or text == "" or r.random() < 0.2:
        return '"' + text.replace('"', '""') + '"'
    return text


def write(path, seed, n, end="\n", plain_quotes=False):
    r = random.Random(seed)
    lines = ["id,text,more"]
    for i in range(n):
        more = '5" pipe' if plain_quotes and r.random() < 0.3 else spelled(field(r), r)
        lines.append(f"{i},{spelled(field(r), r)},{more}")
    with open(path, "w", newline="") as f:
        f.write(end.join(lines) + (end if seed % 2 else ""))


def pandas_rows(path):
    df = pd.read_csv(path, keep_default_na=False, dtype=str)
    return sorted((int(a), b, c) for a, b, c in df.itertuples(index=False))


def rows(spark, path):
    schema = spark.createDataFrame([], SCHEMA).schema
    got = read_csv(spark, path, schema, missing=("\\N",), quoted_breaks=True)
    return sorted((r.id, r.text, r.more) for r in got.collect())


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_pandas_whatever_the_ranges(spark, tmp_dir, small_ranges, size, end):
    small_ranges(size)
    for seed in range(2):
        path = f"{tmp_dir}/{seed}-{size}.csv"
        write(path, seed, 60, end, plain_quotes=True)
        if size == 64:
            assert quoted_lines(spark, path).rdd.getNumPartitions() > 10
        assert rows(spark, path) == pandas_rows(path)


def test_one_record_over_many_ranges(spark, tmp_dir, small_ranges):
    small_ranges(50)
    path = f"{tmp_dir}/long.csv"
    text = "\n".join(f'line {i}, with ""quotes"" ' for i in range(200))
    with open(path, "w") as f:
        f.write(f'id,text,more\n1,a,b\n2,"{text}","x\ny"\n3,"{text}",z\n')
    assert rows(spark, path) == pandas_rows(path)
    assert quoted_records(spark, path).count() == 4


def test_several_files_and_a_wrong_header(spark, tmp_dir, small_ranges):
    small_ranges(100)
    for seed in range(3):
        write(f"{tmp_dir}/f{seed}.csv", seed, 30)
    want = sorted(x for seed in range(3) for x in pandas_rows(f"{tmp_dir}/f{seed}.csv"))
    assert rows(spark, tmp_dir) == want
    with open(f"{tmp_dir}/z.csv", "w") as f:
        f.write("id,more,text\n1,a,b\n")
    with pytest.raises(Exception, match="another header"):
        rows(spark, tmp_dir)


def test_reads_what_is_written(spark, tmp_dir, small_ranges):
    small_ranges(40)
    texts = ['q "x" y', 'say "hi", now', 'end"', '"', '""', "a\nb", "a\r\nb", "\n", "", None, "  lead ", ",", "plain", "back\\", '\\"', "é\tü"]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], SCHEMA)
    write_csv(df, f"{tmp_dir}/w")
    got = read_csv(spark, f"{tmp_dir}/w", df.schema, missing=("\\N",), quoted_breaks=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))
    flat = df.where("text IS NULL OR NOT contains(text, '\\n')")  # the plain reader takes quotes too
    write_csv(flat, f"{tmp_dir}/flat")
    got = read_csv(spark, f"{tmp_dir}/flat", df.schema, missing=("\\N",))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, flat.collect()))


def test_lines_and_states():
    assert ends_inside('a,"b', False) and ends_inside('a,"b""', False) and not ends_inside('a,"b"', False)
    assert not ends_inside('b",c', True) and ends_inside('b"",c', True)
    assert ends_inside('b","c', True) and not ends_inside('5" x', False)


def test_empty_files(spark, tmp_dir):
    with open(f"{tmp_dir}/e.csv", "w") as f:
        f.write("id,text,more\n")
    assert rows(spark, f"{tmp_dir}/e.csv") == []


def test_ranges_come_in_small_pieces():
    import pyarrow as pa

    from sluice.sources.quoted_csv import PIECE_BYTES, ranges_of

    texts = ["x" * 3000, None, "é" * PIECE_BYTES, ""] * 800
    batch = pa.RecordBatch.from_pydict({"value": texts, "file": ["f"] * 3200, "start": [0] * 1601 + [9] * 1599}).slice(2)
    found = list(ranges_of([batch]))
    assert [x for _, _, v in found for x in v.to_pylist()] == texts[2:]
    assert {s for _, s, _ in found} == {0, 9} and sum(len(v) for _, s, v in found if s == 0) == 1599
    assert all(len(v) == 1 or sum(len((x or "").encode()) for x in v.to_pylist()) <= PIECE_BYTES for _, _, v in found)
