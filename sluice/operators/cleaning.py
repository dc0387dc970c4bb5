"""Cleaning, trimming and daily aggregation of readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.numeric import round_half_even_np
from sluice.functions.text import normalized
from sluice.operators.quantiles import exact_quantiles


def keep_normalized_equal(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows where ``column.strip().lower() == value`` (NULL dropped)."""
    return df.where(normalized(F.col(column)) == F.lit(value.lower()))


def trim_by_quantiles(
    df: DataFrame,
    column: str,
    low: float = 0.05,
    high: float = 0.95,
    method: str = "sketch",
) -> DataFrame:
    """Keep rows with ``q(low) <= column <= q(high)``; NULL values are dropped.

    The bounds are one struct-valued scalar subquery (computed once, inlined
    into the filter) — never collected by this code, no join, one lazy plan.
    """
    bounds = exact_quantiles(df, column, [low, high], ["lo", "hi"], method=method)
    b = bounds.select(F.struct("lo", "hi")).scalar()
    return df.where((F.col(column) >= b["lo"]) & (F.col(column) <= b["hi"]))


def daily_stats(df: DataFrame, date_col: str, value_col: str, digits: int = 2) -> DataFrame:
    """``groupby(date).agg(mean, min, max, count).round(2)`` with numpy rounding.

    NULL dates are dropped like pandas ``groupby``; ``reading_count`` counts
    non-NULL values (64-bit).  Partial aggregation happens map-side, so
    a hot date only ships one partial row per task.
    """
    v = F.col(value_col)
    return (
        df.where(F.col(date_col).isNotNull())
        .groupBy(F.col(date_col).alias("date"))
        .agg(
            F.avg(v).alias("avg_temp"),
            F.min(v).alias("min_temp"),
            F.max(v).alias("max_temp"),
            F.count(v).alias("reading_count"),
        )
        .select(
            "date",
            round_half_even_np("avg_temp", digits).alias("avg_temp"),
            round_half_even_np("min_temp", digits).alias("min_temp"),
            round_half_even_np("max_temp", digits).alias("max_temp"),
            "reading_count",
        )
    )


def top_k(df: DataFrame, k: int, by: str, largest: bool = True, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """``nlargest``/``nsmallest`` with ``keep='first'``: ties go to the earlier
    tie-breaker value.  Plans as ``TakeOrderedAndProject`` (per-task top-k, then
    a k-row merge) — no global sort."""
    order: list[Column] = [F.col(by).desc() if largest else F.col(by).asc()]
    order += [F.col(c).asc() for c in tie_breakers]
    return df.orderBy(*order).limit(k)


def extremes(daily: DataFrame, k: int = 5, by: str = "avg_temp", key: str = "date") -> DataFrame:
    """Hottest k ∪ coldest k (UNION ALL: a day can appear in both)."""
    hottest = top_k(daily, k, by, True, [key]).withColumn("type", F.lit("hottest"))
    coldest = top_k(daily, k, by, False, [key]).withColumn("type", F.lit("coldest"))
    return hottest.unionByName(coldest)
