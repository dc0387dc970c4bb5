"""JSON message encoding/decoding shared by batch and streaming code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def to_json_message(df: DataFrame, columns: list[str] | None = None) -> Column:
    """``to_json(struct(*cols))`` — one JSON object per row, NULL fields omitted."""
    cols = columns or df.columns
    return F.to_json(F.struct(*[F.col(c).alias(c) for c in cols]))


def from_json_message(value: Column, schema: StructType | str) -> Column:
    """PERMISSIVE parse: junk, ``null`` or a JSON array give an all-NULL struct;
    a field of the wrong type is NULL on its own; unknown fields are ignored."""
    return F.from_json(value, schema)
