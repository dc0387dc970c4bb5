"""Deterministic keep-first deduplication (A14) and distinct keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order_by`` (ascending, NULLs first),
    remaining columns as further tie-breakers.

    ``drop_duplicates`` keeps the first row *in read order*, which a distributed
    scan does not define; ``dropDuplicates`` is arbitrary.  Here "first" is the
    minimum of ``struct(order_by..., rest...)``.  Being a plain ``min``
    aggregate it runs partial (map-side) first, so a key holding a third of all
    rows is reduced inside every task before the shuffle — unlike a
    ``row_number()`` window, which would sort that whole key in one task.
    Equivalent SQL: ``row_number() over (partition by keys order by order_by,
    rest NULLS FIRST) = 1``.
    """
    keys = list(keys)
    order = [c for c in (order_by or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    firsts = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return firsts.select(*keys, *[F.col("_first")[c].alias(c) for c in order + rest]).select(*df.columns)


def first_read(df: DataFrame, keys: Sequence[str], position: str = "_position") -> DataFrame:
    """One row per key: the first in read order, which ``position`` carries as a number
    (``sources.with_read_order``).  The least position of a key is a hash aggregation
    over keys and positions alone; the whole rows are fetched by a semi join on it.
    NULL keys are one key, as in the pandas reader's ``drop_duplicates``."""
    winners = df.groupBy(*keys).agg(F.min(position).alias(position)).select(position)
    return df.join(winners, position, "left_semi").drop(position)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df[keys].drop_duplicates()`` (partial aggregation before the shuffle)."""
    return df.select(*keys).distinct()
