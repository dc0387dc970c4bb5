"""JSON messages: encode (X12) and one decoder for batch (X13) and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.functions.json import from_json_message, to_json_message
from sluice.schemas import LOAN_MESSAGE


def encode_messages(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One ``value`` (JSON text as bytes, as a message bus stores it) per row."""
    return df.select(to_json_message(df, columns).cast("binary").alias("value"))


def decode_messages(envelope: DataFrame, schema: StructType = LOAN_MESSAGE, key_field: str = "loan_id") -> DataFrame:
    """``from_json(cast(value as string))`` -> fields + ``timestamp``,
    dropping messages whose key field is NULL (junk text, ``null``, arrays,
    wrong-typed key).  Pure projection + filter, so the same function serves a
    batch and a streaming DataFrame."""
    return (
        envelope.select(
            from_json_message(F.col("value").cast("string"), schema).alias("data"),
            F.col("timestamp"),
        )
        .select("data.*", "timestamp")
        .where(F.col(key_field).isNotNull())
    )
