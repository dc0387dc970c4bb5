import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators.cleaning import trim_by_quantiles
from sluice.operators.quantiles import exact_quantiles


def _check(spark, values, probs=(0.05, 0.95), **kw):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    got = exact_quantiles(df, "x", list(probs), **kw).first()
    clean = np.array([v for v in values if v is not None], dtype=float)
    for i, p in enumerate(probs):
        if clean.size == 0:
            assert got[i] is None
        else:
            assert got[i] == pytest.approx(float(np.quantile(clean, p)), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize(
    "values",
    [
        [1.0],
        [3.0, 1.0],
        [5.0, 5.0, 5.0],
        [None, 2.0, None, 7.0, 1.0],
        list(range(100)),
        [0.01 * i for i in range(2000)],
    ],
)
def test_matches_numpy_small(spark, values):
    _check(spark, values)


def test_empty_gives_null(spark):
    _check(spark, [None, None])


def test_hot_value_third_of_rows(spark):
    rng = np.random.default_rng(7)
    vals = list(np.round(rng.normal(20, 5, 6000), 2)) + [21.5] * 3000
    _check(spark, vals, probs=(0.05, 0.5, 0.95, 0.0, 1.0))


def test_nan_is_missing(spark):
    nan = float("nan")
    for extra in (5, 500):
        df = spark.createDataFrame([(float(v),) for v in range(1000)] + [(nan,)] * extra, "x double")
        assert tuple(exact_quantiles(df, "x", [0.05, 0.95]).first()) == pytest.approx((49.95, 949.05))
    kept = trim_by_quantiles(spark.createDataFrame([(float(v),) for v in range(21)] + [(nan,)], "x double"), "x")
    assert sorted(r[0] for r in kept.collect()) == [float(v) for v in range(1, 20)]


@pytest.mark.parametrize("k", [8, 16, 4096])
def test_many_distinct_small_sketches(spark, k):
    # tiny k -> coarse sketches and wide brackets; the result must stay exact
    rng = np.random.default_rng(3)
    vals = list(rng.uniform(-100, 100, 50_000))
    _check(spark, vals, probs=(0.05, 0.25, 0.95), k=k)


def test_methods_agree(spark):
    rng = np.random.default_rng(11)
    df = spark.createDataFrame([(float(v),) for v in rng.integers(0, 50, 3000)], "x double")
    a = exact_quantiles(df, "x", [0.05, 0.95], method="sketch").first()
    b = exact_quantiles(df, "x", [0.05, 0.95], method="percentile").first()
    assert tuple(a) == pytest.approx(tuple(b))


def test_trim_keeps_bounds_and_drops_null(spark):
    df = spark.createDataFrame([(float(v),) for v in range(21)] + [(None,)], "x double")
    kept = sorted(r[0] for r in trim_by_quantiles(df, "x").collect())
    assert kept == [float(v) for v in range(1, 20)]  # q05 = 1.0, q95 = 19.0 inclusive
    assert kept == [v for v in range(21) if 1.0 <= v <= 19.0]
    assert trim_by_quantiles(df.where(F.col("x").isNull()), "x").count() == 0
