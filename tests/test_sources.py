"""CSV by header name, missing tokens, time zones, scratch folders."""

import datetime as dt
import os

import pytest

from sluice.functions.time import parse_iso
from sluice.plans.readings import prepare_readings
from sluice.plans.support import replicate_sessions, user_activity_mart
from sluice.schemas import TEMP_READINGS
from sluice.session import local_scratch
from sluice.sources.files import read_csv


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_missing_tokens_and_extra_columns(spark, tmp_dir):
    p = os.path.join(tmp_dir, "r.csv")
    _write(p, ["id,temp,room,noted_date,out/in", "a,NA,x,1-2-2024 3:04,In", "b,null,x,1-2-2024 3:04,In", "c,NaN,x,1-2-2024 3:04,In",
               "d,,x,1-2-2024 3:04,In", "e,21.5,x,1-2-2024 3:04, in ", "f,n/a,x,NA,Out"])
    df = read_csv(spark, p, TEMP_READINGS)
    assert df.columns == TEMP_READINGS.names
    assert [r.temp for r in df.collect()] == [None, None, None, None, 21.5, None]
    assert [r.temp for r in prepare_readings(df).where("temp is not null").collect()] == [21.5]
    _write(p, ["temp,noted_date,out/in", "warm,1-2-2024 3:04,In"])
    with pytest.raises(Exception):
        read_csv(spark, p, TEMP_READINGS).collect()


def test_files_with_other_headers_are_refused(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "many")
    os.makedirs(folder)
    _write(os.path.join(folder, "a.csv"), ["out/in,noted_date,temp", "In,1-2-2024 3:04,1"])
    _write(os.path.join(folder, "b.csv"), ["temp,noted_date,out/in", "2,1-2-2024 3:04,In"])
    with pytest.raises(Exception):
        read_csv(spark, folder, TEMP_READINGS).collect()


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_results_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2024-03-31T23:30:00Z", "2024-03-31T02:30:00Z", "2024-10-27T02:30:00.5Z", "2024-03-31T23:30:00+02:00", "2024-03-31 23:30:00"]
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_iso("t").alias("t"))
        assert dict(df.dtypes)["t"] == "timestamp_ntz"
        assert [r.t for r in df.collect()] == [
            dt.datetime(2024, 3, 31, 23, 30), dt.datetime(2024, 3, 31, 2, 30), dt.datetime(2024, 10, 27, 2, 30, 0, 500000),
            dt.datetime(2024, 3, 31, 21, 30), dt.datetime(2024, 3, 31, 23, 30),
        ]
        docs = spark.createDataFrame(
            [("s1", "u1", "2024-03-31T23:30:00Z", "2024-04-01T00:30:00Z", ["/a"], "d", ["x"])],
            "session_id string, user_id string, start_time string, end_time string, pages_visited array<string>, device string, actions array<string>",
        )
        row = user_activity_mart(replicate_sessions(docs)).first()
        assert (row.activity_date, row.avg_session_min) == (dt.date(2024, 3, 31), 60.0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_scratch_folder_must_be_shared_off_local_masters():
    assert os.path.isdir(local_scratch("local[4]"))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError):
            local_scratch(master)


def test_first_read_equals_pandas_over_files(spark, tmp_dir):
    import json
    import random

    import pandas as pd

    from sluice.operators.dedupe import first_read
    from sluice.sources.files import with_read_order

    r = random.Random(4)
    frames = []
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        for f in ("b", "a", "c"):
            rows = [{"k": r.choice([None, *range(12)]), "v": f"{f}{i}", "doc": "x" * r.randrange(40)} for i in range(40)]
            with open(f"{tmp_dir}/{f}.json", "w") as out:
                out.writelines(json.dumps(x) + "\n" for x in rows)
            frames.append((f, pd.DataFrame(rows)))
        scan = spark.read.schema("k int, v string, doc string").json(f"{tmp_dir}/*.json")
        assert scan.rdd.getNumPartitions() > 6
        every = pd.concat([x for _, x in sorted(frames, key=lambda p: p[0])])
        want = sorted(every.drop_duplicates("k").v)
        placed = with_read_order(scan)
        assert sorted(x.v for x in first_read(placed, ["k"]).collect()) == want
        assert [x.v for x in placed.orderBy("_position").collect()] == list(every.v)
        plan = first_read(placed, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan
        scan.coalesce(1).write.parquet(f"{tmp_dir}/p")
        stored = spark.read.parquet(f"{tmp_dir}/p")
        want = sorted(pd.DataFrame([x.asDict() for x in stored.collect()]).drop_duplicates("k").v)
        assert sorted(x.v for x in first_read(with_read_order(stored), ["k"]).collect()) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
