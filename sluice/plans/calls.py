"""Call log: typed snapshot copy (X15) and strict keyed insert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.operators.loads import read_snapshot, snapshot_copy, strict_insert
from sluice.schemas import CALL_LOG


def snapshot_roundtrip(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as an uncompressed CSV snapshot, read it back typed
    with the source schema (row count and values equal the source)."""
    snapshot_copy(df, path)
    return read_snapshot(spark, path, df.schema)


def strict_insert_calls(target: DataFrame, batch: DataFrame) -> DataFrame:
    """INSERT into the call log keyed by ``call_id`` (existing key = error)."""
    return strict_insert(target.select(*CALL_LOG.names), batch.select(*CALL_LOG.names), ["call_id"])
