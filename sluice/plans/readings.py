"""Sensor readings: daily extremes (X3), full load (X4), incremental load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluice.functions.time import parse_datetime
from sluice.operators.cleaning import daily_stats, extremes, keep_normalized_equal, trim_by_quantiles
from sluice.operators.loads import upsert
from sluice.sources.files import high_water_mark


def prepare_readings(
    readings: DataFrame,
    flag_col: str = "out/in",
    flag_value: str = "in",
    time_col: str = "noted_date",
    value_col: str = "temp",
    time_format: str = "%d-%m-%Y %H:%M",
) -> DataFrame:
    """P4 -> F4 -> F5: keep rows whose flag is ``flag_value`` after
    strip/lower, parse the time (text with ``time_format``, or already a
    timestamp) and derive the day.  Output ``(date, temp)``."""
    kept = keep_normalized_equal(readings, flag_col, flag_value)
    t = F.col(time_col)
    if isinstance(readings.schema[time_col].dataType, StringType):
        t = parse_datetime(t, time_format)
    return kept.select(F.to_date(t).alias("date"), F.col(value_col).cast("double").alias("temp"))


def temp_daily_full(prepared: DataFrame, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Quantile trim over all prepared readings, then daily stats."""
    return daily_stats(trim_by_quantiles(prepared, "temp", low, high), "date", "temp")


def temp_extremes(prepared: DataFrame, k: int = 5) -> DataFrame:
    """The k hottest and k coldest days (by rounded average)."""
    return extremes(temp_daily_full(prepared), k)


def incremental_batch(target: DataFrame, prepared: DataFrame, as_of: str, days_back: int = 7) -> DataFrame:
    """X5 batch: readings strictly after ``greatest(max(target.date),
    as_of - days_back)`` (NULL mark -> only the window), trimmed by quantiles of
    that slice alone, aggregated per day.

    The cutoff is a scalar subquery in the scan filter — no driver code, no
    join — so on a date-partitioned source it can prune files.
    """
    mark = high_water_mark(target, "date", "_mark")
    cutoff = mark.select(
        F.greatest(F.col("_mark"), F.date_sub(F.to_date(F.lit(as_of)), days_back)).alias("_cutoff")
    ).scalar()
    return temp_daily_full(prepared.where(F.col("date") > cutoff))


def temp_daily_incremental(target: DataFrame, prepared: DataFrame, as_of: str, days_back: int = 7) -> DataFrame:
    """Upsert the incremental batch into the target table (key ``date``)."""
    batch = incremental_batch(target, prepared, as_of, days_back)
    return upsert(target, batch, ["date"])
