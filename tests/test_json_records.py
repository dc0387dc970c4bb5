"""Records of large documents read by ranges, against Python's json."""

import json
import os
import random

import pytest

from sluice.operators.loads import write_json_documents
from sluice.plans.documents import pets_flat
from sluice.schemas import PETS_DOCUMENT
from sluice.sources import read_json_documents, read_json_records
from sluice.sources.json_records import json_record_texts

STRINGS = ["plain", 'q"uote', "br}ace", "{[", "]}", "back\\slash", '\\"', "}" * 5, "é}ü", "", "\n", '":', '"pets": [{', "\\}"]


def record(r, depth=0):
    out = {r.choice(["name", "a}b", 'k"', "pets", "x"]): r.choice(STRINGS) for _ in range(r.randrange(4))}
    if depth < 3 and r.random() < 0.5:
        out["deep"] = [record(r, depth + 1) for _ in range(r.randrange(3))]
    if r.random() < 0.3:
        out["pets"] = {"pets": [1, record(r, 3), None]}
    return out


def read(spark, path, record_path, size):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        return [json.loads(r.text) for r in json_record_texts(spark, path, record_path).collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def same(got, wanted):
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, wanted))


@pytest.mark.parametrize("size", [61, 300, 10**6])
def test_equal_to_json_in_any_range(spark, tmp_dir, size):
    r = random.Random(size)
    wanted = []
    for k in range(3):
        pets = [record(r) for _ in range(40)] + [{"big": "}" * 700}, {}, record(r)]
        doc = {"meta": [record(r)], "x}": {"pets": [record(r)]}, "pets": pets, "later": [{"pets": [record(r)]}]}
        with open(os.path.join(tmp_dir, f"d{k}.json"), "w") as f:
            json.dump(doc, f, indent=r.choice([None, 2]), ensure_ascii=bool(k))
        wanted += pets
    same(read(spark, tmp_dir, "pets", size), wanted)


@pytest.mark.parametrize("size", [40, 10**6])
def test_paths(spark, tmp_dir, size):
    docs = {
        "a": {"data": {"note": {"items": [{"no": 1}]}, "items": [{"id": i, "sub": {"items": [{"no": 2}]}} for i in range(9)]}},
        "b": {"x": {"items": 1}, "data": [[{"no": 3}]]},
        "c": {"data": {"items": {"one": {"no": 4}}}, "items": [{"no": 5}]},
        "d": {"data": {"items": [1, "x", None, [{"no": 6}], {"id": 99}]}},
        "e": {},
    }
    for name, doc in docs.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            json.dump(doc, f)
    open(os.path.join(tmp_dir, "empty"), "w").close()
    same(read(spark, tmp_dir, "data.items", size), [*docs["a"]["data"]["items"], {"id": 99}])


def test_document_that_is_an_array(spark, tmp_dir):
    rows = [{"id": i, "l": [{"k": "}"}]} for i in range(50)]
    path = os.path.join(tmp_dir, "list.json")
    with open(path, "w") as f:
        json.dump(rows, f)
    same(read(spark, path, "", 64), rows)


def test_many_tasks_give_the_rows_of_the_plain_reader(spark, tmp_dir):
    pets = [{"name": f"n{i}", "species": "cat", "birthYear": 2000 + i % 9, "favFoods": ["a", "b}"][: i % 3], "photo": None} for i in range(500)]
    path = os.path.join(tmp_dir, "pets.json")
    with open(path, "w") as f:
        json.dump({"pets": pets}, f)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    try:
        schema = PETS_DOCUMENT["pets"].dataType.elementType
        records = read_json_records(spark, path, "pets", schema)
        assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 3
        got = sorted(map(repr, records.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    plain = read_json_documents(spark, path, PETS_DOCUMENT).selectExpr("inline(pets)")
    assert got == sorted(map(repr, plain.collect()))
    assert len(got) == pets_flat(read_json_documents(spark, path, PETS_DOCUMENT)).count() == 500


def test_written_documents_come_back(spark, tmp_dir):
    rows = [(i, None if i % 7 == 0 else r, {"n": r}) for i, r in enumerate(STRINGS * 9)]
    df = spark.createDataFrame(rows, "id long, t string, m struct<n:string>").repartition(5)
    write_json_documents(df, tmp_dir + "/j", "rows of \"it\"")
    write_json_documents(df.where("id < 0"), tmp_dir + "/none", "rows")
    same([tuple(r[:2]) for r in read_json_records(spark, tmp_dir + "/j", 'rows of "it"', df.schema).collect()], [r[:2] for r in rows])
    assert read_json_records(spark, tmp_dir + "/none", "rows", df.schema).count() == 0


def test_braces_in_a_path_are_refused(spark, tmp_dir):
    with pytest.raises(ValueError):
        json_record_texts(spark, tmp_dir, "a}b")
