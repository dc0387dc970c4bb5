import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.functions import (
    PY_WHITESPACE,
    hours_between,
    join_list,
    minutes_between,
    normalized,
    parse_datetime,
    parse_iso,
    py_strip,
    round_half_even_np,
    strftime_pattern,
    text_to_double,
)


def test_py_whitespace_matches_python():
    assert all(c.isspace() for c in PY_WHITESPACE)
    assert "\f" in PY_WHITESPACE and "\v" in PY_WHITESPACE and "　" in PY_WHITESPACE


def test_strip_lower_like_python(spark):
    vals = [" In\t", "OUT", None, "\fin\v", "inf", "　IN ", "i n"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(normalized("v")).collect()]
    assert got == [None if v is None else v.strip().lower() for v in vals]
    assert [r[0] for r in df.select(py_strip("v")).collect()] == [None if v is None else v.strip() for v in vals]


def test_join_list_null_and_empty(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "v array<string>")
    assert [r[0] for r in df.select(join_list("v")).collect()] == ["a, b", "", None]


@pytest.mark.parametrize("x", [1.015, 2.665, 2.675, 0.125, 0.135, -1.005, 12.345, 1e-9, 99.995])
def test_round_half_even_matches_numpy(spark, x):
    got = spark.range(1).select(round_half_even_np(F.lit(x)).alias("r")).first()["r"]
    assert got == float(np.round(x, 2))


def test_strftime_pattern():
    assert strftime_pattern("%d-%m-%Y %H:%M") == "d-M-yyyy H:m"


def test_parse_datetime_one_digit_fields_and_strict(spark):
    df = spark.createDataFrame([("1-2-2018 5:03",), ("12-11-2018 23:59",)], "s string")
    got = [r[0] for r in df.select(parse_datetime("s")).collect()]
    assert got[0].replace(tzinfo=None) == dt.datetime(2018, 2, 1, 5, 3)
    assert got[1].replace(tzinfo=None) == dt.datetime(2018, 11, 12, 23, 59)
    bad = spark.createDataFrame([("junk",)], "s string")
    with pytest.raises(Exception):
        bad.select(parse_datetime("s")).collect()
    assert bad.select(parse_datetime("s", lenient=True)).first()[0] is None


def test_iso_and_differences(spark):
    df = spark.createDataFrame(
        [("2024-01-01T10:00:00Z", "2024-01-01T10:01:30.5Z"), ("2024-01-01T10:00:00.123456Z", None)],
        "a string, b string",
    )
    rows = df.select(
        minutes_between(parse_iso("a"), parse_iso("b")).alias("m"),
        hours_between(parse_iso("a"), parse_iso("b")).alias("h"),
    ).collect()
    assert rows[0]["m"] == pytest.approx(90.5 / 60)
    assert rows[0]["h"] == pytest.approx(90.5 / 3600)
    assert rows[1]["m"] is None


def test_text_to_double(spark):
    df = spark.createDataFrame([("0",), ("",), ("  ",), (None,), (" 2.5 ",)], "s string")
    assert [r[0] for r in df.select(text_to_double("s")).collect()] == [0.0, None, None, None, 2.5]
    with pytest.raises(Exception):
        spark.createDataFrame([("abc",)], "s string").select(text_to_double("s")).collect()


def test_iso_texts_in_any_session_zone(spark):
    texts = {
        "2024-01-02T03:04:05Z": "2024-01-02 03:04:05", "2024-01-02T03:04:05.120000Z": "2024-01-02 03:04:05.12",
        "2024-01-02 03:04:05.5Z": "2024-01-02 03:04:05.5", "2024-01-02T03:04:05+02:00": "2024-01-02 01:04:05",
        "2024-01-02T03:04:05": "2024-01-02 03:04:05", "2024-01-02T03:04:05Z ": "2024-01-02 03:04:05",
    }
    df = spark.createDataFrame([(k,) for k in [*texts, None]], "t string")
    from sluice.functions.time import parse_iso

    keep = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = df.select("t", parse_iso("t").cast("string").alias("x"), parse_iso("t", lenient=True).cast("string").alias("y")).collect()
            assert {r.t: r.x for r in got} == {r.t: r.y for r in got} == texts | {None: None}
        junk = spark.createDataFrame([("2024-13-02T03:04:05Z",), ("x",)], "t string")
        assert [r.x for r in junk.select(parse_iso("t", lenient=True).alias("x")).collect()] == [None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", keep)
