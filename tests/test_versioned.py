"""Versioned tables: whole loads or none, conflicts, and which files a load reads."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import versioned
from sluice.operators.versioned import ConcurrentLoad, VersionedTable

SCHEMA = "k long, part string, v string"


@pytest.fixture()
def table(spark, tmp_dir):
    schema = spark.createDataFrame([], SCHEMA).schema
    return VersionedTable(spark, f"{tmp_dir}/t", schema, ["k"])


def rows(spark, *data, slices=2):
    return spark.createDataFrame(list(data), SCHEMA).repartition(slices)


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_loads_and_earlier_versions(spark, table):
    assert table.version() == 0 and content(table.read()) == []
    table.append(rows(spark, (1, "a", "x"), (2, None, "y")))
    table.upsert(rows(spark, (2, "b", "Y"), (3, None, "z")))
    table.insert_if_absent(rows(spark, (3, "c", "late"), (4, "d", "w"), (4, "d", "v")), order_by=["v"])
    table.strict_insert(rows(spark, (5, None, None)))
    assert table.versions() == [1, 2, 3, 4]
    assert content(table.read(1)) == [(1, "a", "x"), (2, None, "y")]
    assert content(table.read()) == [(1, "a", "x"), (2, "b", "Y"), (3, None, "z"), (4, "d", "v"), (5, None, None)]
    table.replace(table.read().where("k > 3"))
    assert content(table.read()) == [(4, "d", "v"), (5, None, None)]
    table.replace(table.read().limit(0))
    assert content(table.read()) == []
    table.upsert(rows(spark, (9, "i", "n")))
    assert content(table.read()) == [(9, "i", "n")]


def test_broken_key_rules_leave_the_table_as_it_was(spark, table):
    table.append(rows(spark, (1, "a", "x")))
    for bad in ([(2, "a", "x"), (2, "b", "y")], [(None, "a", "x")]):
        for load in (table.upsert, table.strict_insert):
            with pytest.raises(Exception, match="duplicate primary key or NULL key"):
                load(rows(spark, *bad))
    with pytest.raises(Exception, match="NULL key"):
        table.insert_if_absent(rows(spark, (None, "a", "x")))
    with pytest.raises(ValueError, match="duplicate primary key"):
        table.strict_insert(rows(spark, (1, "b", "y"), (7, "c", "z")))
    assert table.versions() == [1] and content(table.read()) == [(1, "a", "x")]


@pytest.mark.parametrize("step", ["data", "index", "manifest", "publish"])
def test_a_load_that_dies_is_not_seen(spark, table, monkeypatch, step):
    table.append(rows(spark, (1, "a", "x"), (2, "b", "y")))
    before = content(table.read())

    def die(*_, **__):
        raise KeyboardInterrupt(step)

    if step == "publish":
        monkeypatch.setattr(VersionedTable, "_publish", die)
    elif step == "index":
        monkeypatch.setattr(versioned, "_index_rows", die)
    elif step == "data":
        monkeypatch.setattr(versioned, "_below", die)
    else:
        whole = VersionedTable.manifest
        calls = []
        monkeypatch.setattr(VersionedTable, "manifest", lambda *a: die() if len(calls) else calls.append(1) or whole(*a))
    with pytest.raises(KeyboardInterrupt):
        table.upsert(rows(spark, (2, "b", "new"), (3, "c", "z")))
    monkeypatch.undo()
    assert table.versions() == [1] and content(table.read()) == before
    table.upsert(rows(spark, (2, "b", "again")))
    assert content(table.read()) == [(1, "a", "x"), (2, "b", "again")]
    table.vacuum(keep=2)
    assert content(table.read(1)) == before and content(table.read()) == [(1, "a", "x"), (2, "b", "again")]


def test_of_two_writers_one_wins(spark, table, monkeypatch):
    table.append(rows(spark, (1, "a", "x")))
    whole = VersionedTable._publish

    def other_first(self, version, load):
        monkeypatch.setattr(VersionedTable, "_publish", whole)
        VersionedTable(spark, self.path, self.schema, self.keys).upsert(rows(spark, (1, "a", "other"), (2, "b", "other")))
        whole(self, version, load)

    monkeypatch.setattr(VersionedTable, "_publish", other_first)
    with pytest.raises(ConcurrentLoad):
        table.upsert(rows(spark, (1, "a", "mine")))
    assert content(table.read()) == [(1, "a", "other"), (2, "b", "other")] and table.versions() == [1, 2]
    monkeypatch.setattr(VersionedTable, "_publish", other_first)
    table.upsert(rows(spark, (1, "a", "mine")), attempts=2)
    assert content(table.read()) == [(1, "a", "mine"), (2, "b", "other")] and table.versions() == [1, 2, 3, 4]


def test_few_rows_look_at_few_files(spark, table):
    for k in range(8):  # ranges overlap in all files: keys are dealt out at random
        table.append(spark.range(k, 8000, 8).select(F.col("id").alias("k"), F.lit("p").alias("part"), F.lit("v").alias("v")).coalesce(1))
    every = {r.file for r in table.manifest().collect()}
    assert len(every) == 8
    near = table.candidates(rows(spark, (803, "p", "new")), 8)
    assert len(near) < 4 and table._holding(rows(spark, (803, "p", "new")), 8)[0] in near
    assert table.candidates(rows(spark, (9000, "p", "new")), 8) == []
    table.upsert(rows(spark, (803, "p", "new"), (9001, "p", "add")))
    after = {r.file for r in table.manifest().collect()}
    assert len(every - after) == 1
    got = {r.k: r.v for r in table.read().collect()}
    assert len(got) == 8001 and {k for k, v in got.items() if v == "new"} == {803}


def test_random_loads_equal_a_dict(spark, table):
    r, want = random.Random(3), {}
    for step in range(8):
        batch = {r.randrange(40): (str(step), r.choice(["a", None])) for _ in range(r.randrange(1, 12))}
        df = rows(spark, *[(k, p, v) for k, (v, p) in batch.items()])
        if step % 2:
            table.upsert(df)
            want |= batch
        else:
            table.insert_if_absent(df)
            want = batch | want
        assert content(table.read()) == sorted(((k, p, v) for k, (v, p) in want.items()), key=repr)


def test_two_column_keys(spark, tmp_dir):
    schema = spark.createDataFrame([], "a string, b date, v int").schema
    t = VersionedTable(spark, f"{tmp_dir}/two", schema, ["a", "b"])
    data = spark.sql("SELECT concat('u', id % 7) a, date_add(date '2024-01-01', cast(id / 7 as int)) b, cast(id as int) v FROM range(70)")
    t.strict_insert(data)
    t.upsert(data.where("v % 10 = 0").withColumn("v", F.lit(-1)))
    got = t.read()
    assert got.count() == 70 and got.where("v = -1").count() == 7
    with pytest.raises(ValueError, match="duplicate"):
        t.strict_insert(data.limit(1))


def test_vacuum_removes_what_no_version_names(spark, table):
    table.append(rows(spark, (1, "a", "x")))
    table.replace(rows(spark, (2, "b", "y")))
    table.upsert(rows(spark, (2, "b", "z")))
    assert len(table.vacuum()) == 2 and table.versions() == [3]
    assert content(table.read()) == [(2, "b", "z")]
