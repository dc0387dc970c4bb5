import pytest
from pyspark.sql import functions as F

from sluice.operators.dedupe import dedupe_first
from sluice.operators.loads import (
    insert_if_absent,
    insert_if_absent_to_path,
    read_or_empty,
    strict_insert,
    strict_insert_to_path,
    upsert,
    upsert_to_path,
)

SCHEMA = "k int, part string, v string"


def test_upsert_replaces_and_adds(spark):
    t = spark.createDataFrame([(1, "a", "old"), (2, "a", "keep")], SCHEMA)
    b = spark.createDataFrame([(1, "a", "new"), (3, "b", "add")], SCHEMA)
    assert sorted(upsert(t, b, ["k"]).collect()) == sorted(
        spark.createDataFrame([(1, "a", "new"), (2, "a", "keep"), (3, "b", "add")], SCHEMA).collect()
    )


def test_insert_if_absent_existing_wins(spark):
    t = spark.createDataFrame([(1, "a", "old")], SCHEMA)
    b = spark.createDataFrame([(1, "a", "changed"), (2, "b", "x"), (2, "b", "a-first")], SCHEMA)
    out = {r["k"]: r["v"] for r in insert_if_absent(t, b, ["k"], order_by=["v"]).collect()}
    assert out == {1: "old", 2: "a-first"}


def test_strict_insert_raises_on_existing_or_repeated_key(spark):
    t = spark.createDataFrame([(1, "a", "x")], SCHEMA)
    ok = spark.createDataFrame([(2, "a", "y")], SCHEMA)
    assert strict_insert(t, ok, ["k"]).count() == 2
    with pytest.raises(Exception, match="duplicate primary key"):
        strict_insert(t, spark.createDataFrame([(1, "a", "z")], SCHEMA), ["k"]).collect()
    with pytest.raises(Exception, match="duplicate primary key"):
        strict_insert(t, spark.createDataFrame([(5, "a", "z"), (5, "b", "w")], SCHEMA), ["k"]).collect()


def test_dedupe_first_deterministic_with_hot_key(spark):
    rows = [(7, "p", f"v{i:05d}") for i in range(3000, 0, -1)] + [(8, "q", "z")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = {r["k"]: r["v"] for r in dedupe_first(df, ["k"], ["v"]).collect()}
    assert out == {7: "v00001", 8: "z"}


def test_upsert_to_path_dynamic_partitions(spark, tmp_dir):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    schema = StructType([StructField("k", IntegerType()), StructField("v", StringType()), StructField("part", StringType())])
    path = f"{tmp_dir}/daily"
    b1 = spark.createDataFrame([(1, "a", "p1"), (2, "b", "p1"), (3, "c", "p2")], schema)
    assert upsert_to_path(spark, b1, path, ["k"], ["part"], schema) == 3
    b2 = spark.createDataFrame([(2, "B", "p1"), (4, "d", "p1")], schema)
    upsert_to_path(spark, b2, path, ["k"], ["part"], schema)
    got = sorted((r["k"], r["v"], r["part"]) for r in read_or_empty(spark, path, schema).collect())
    assert got == [(1, "a", "p1"), (2, "B", "p1"), (3, "c", "p2"), (4, "d", "p1")]
    # idempotent
    upsert_to_path(spark, b2, path, ["k"], ["part"], schema)
    assert sorted((r["k"], r["v"], r["part"]) for r in read_or_empty(spark, path, schema).collect()) == got
    with pytest.raises(Exception, match="duplicate primary key"):
        upsert_to_path(spark, spark.createDataFrame([(9, "x", "p1"), (9, "y", "p1")], schema), path, ["k"], ["part"], schema)


def test_insert_if_absent_and_strict_insert_to_path(spark, tmp_dir):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    schema = StructType([StructField("k", IntegerType()), StructField("v", StringType())])
    path = f"{tmp_dir}/users"
    assert insert_if_absent_to_path(spark, spark.createDataFrame([(1, "a"), (2, "b")], schema), path, ["k"], schema) == 2
    assert insert_if_absent_to_path(spark, spark.createDataFrame([(2, "B"), (3, "c")], schema), path, ["k"], schema) == 1
    assert sorted(tuple(r) for r in read_or_empty(spark, path, schema).collect()) == [(1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(Exception, match="duplicate primary key"):
        strict_insert_to_path(spark, spark.createDataFrame([(3, "x")], schema), path, ["k"], schema)
    assert read_or_empty(spark, path, schema).count() == 3  # nothing written
    assert strict_insert_to_path(spark, spark.createDataFrame([(4, "d")], schema), path, ["k"], schema) == 1


def test_key_rules_are_in_the_plan(spark, tmp_dir):
    t = spark.createDataFrame([(1, "a", "x")], SCHEMA)
    twice = spark.createDataFrame([(5, "a", "z"), (5, "b", "w")], SCHEMA)
    null = spark.createDataFrame([(None, "a", "z")], SCHEMA)
    for bad in (twice, null):
        for empty in (t, t.where("k > 9")):
            with pytest.raises(Exception, match="duplicate primary key or NULL key"):
                upsert(empty, bad, ["k"]).collect()
            with pytest.raises(Exception, match="duplicate primary key or NULL key"):
                strict_insert(empty, bad, ["k"]).collect()
    with pytest.raises(Exception, match="NULL key"):
        insert_if_absent(t, null, ["k"]).collect()


def test_upsert_moves_a_key_between_partitions(spark, tmp_dir):
    schema = spark.createDataFrame([], "k int, v string, p string").schema
    path = f"{tmp_dir}/moving"
    upsert_to_path(spark, spark.createDataFrame([(1, "old", "a"), (2, "two", "c x"), (3, "three", "c x"), (4, "four", "d")], schema), path, ["k"], ["p"], schema)
    upsert_to_path(spark, spark.createDataFrame([(1, "new", "b"), (2, "TWO", "d")], schema), path, ["k"], ["p"], schema)
    got = sorted(tuple(r) for r in read_or_empty(spark, path, schema).collect())
    assert got == [(1, "new", "b"), (2, "TWO", "d"), (3, "three", "c x"), (4, "four", "d")]
    # the partition of spaces and a further move that empties it
    upsert_to_path(spark, spark.createDataFrame([(3, "THREE", "b")], schema), path, ["k"], ["p"], schema)
    got = sorted(tuple(r) for r in read_or_empty(spark, path, schema).collect())
    assert got == [(1, "new", "b"), (2, "TWO", "d"), (3, "THREE", "b"), (4, "four", "d")]


def test_snapshot_equals_its_source(spark, tmp_dir):
    from sluice.operators.loads import read_snapshot, snapshot_copy

    texts = ["  lead", "trail  ", "", None, "a\nb", "a\r\nb", 'q"uo"te', "\\N", "\\n", "\\\\", "back\\", ",", "\u0001", "\u00012", "#c", "é\tb", '"', " "]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "k int, t string, `a.b` string")
    snapshot_copy(df, f"{tmp_dir}/snap")
    got = read_snapshot(spark, f"{tmp_dir}/snap", df.schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_upsert_keeps_rows_of_the_null_partition(spark, tmp_dir):
    schema = spark.createDataFrame([], "k int, v string, p string").schema
    path = f"{tmp_dir}/nulls"

    def load(*rows):
        upsert_to_path(spark, spark.createDataFrame(list(rows), schema), path, ["k"], ["p"], schema)
        return sorted((tuple(r) for r in read_or_empty(spark, path, schema).collect()), key=repr)

    load((1, "x", None), (2, "y", None), (5, "v", "m2"))
    assert load((3, "z", None)) == [(1, "x", None), (2, "y", None), (3, "z", None), (5, "v", "m2")]
    assert load((1, "moved", "m1"), (2, "Y", None)) == [(1, "moved", "m1"), (2, "Y", None), (3, "z", None), (5, "v", "m2")]
    assert load((1, "back", None)) == [(1, "back", None), (2, "Y", None), (3, "z", None), (5, "v", "m2")]
    assert load((1, "a", "m2"), (2, "b", "m2"), (3, "c", "m2")) == [(1, "a", "m2"), (2, "b", "m2"), (3, "c", "m2"), (5, "v", "m2")]


def test_strict_insert_of_few_rows_moves_no_target_keys(spark, tmp_dir):
    spark.range(100_000).selectExpr("cast(id as int) k", "'v' v").write.parquet(f"{tmp_dir}/big")
    big = spark.read.parquet(f"{tmp_dir}/big")
    out = strict_insert(big, spark.createDataFrame([(-1, "new")], big.schema), ["k"])
    assert out.count() == 100_001
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 1 and "Union" in plan


def test_json_lines_are_compressed_and_bounded(spark, tmp_dir, monkeypatch):
    import os

    from sluice.operators import loads
    from sluice.operators.dedupe import first_read
    from sluice.sources.files import with_read_order

    monkeypatch.setattr(loads, "ROWS_PER_FILE", 30)
    rows = spark.range(0, 100, 1, 1).select((F.col("id") % 40).alias("k"), F.col("id").alias("n"), F.lit("repeated " * 40).alias("t"))
    path = f"{tmp_dir}/lines"
    loads.write_json_lines(rows, path)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 4 and all(f.endswith(".json.gz") for f in files)
    assert sum(os.path.getsize(f"{path}/{f}") for f in files) < 100 * 360 / 5
    placed = with_read_order(spark.read.schema(rows.schema).json(path))
    assert [r.n for r in placed.orderBy("_position").collect()] == list(range(100))
    assert sorted(r.n for r in first_read(placed, ["k"]).collect()) == list(range(40))
