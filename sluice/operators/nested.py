"""Nested data: lockstep unnest (F13), record explode (S1), items/add-ons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def _empty_like(dtype: DataType) -> Column:
    return F.array().cast(dtype)


def lockstep_unnest(df: DataFrame, keep: list[str], arrays: dict[str, str], ignore_padding: bool = False) -> DataFrame:
    """``SELECT keep..., unnest(a1) AS n1, unnest(a2) AS n2`` as PostgreSQL 10+ and
    DuckDB run it: arrays advance in lockstep and the shorter one is padded with
    NULL; a NULL array counts as empty; a row whose arrays are all empty
    produces no output.

    ``arrays_zip`` pads like that; the NULL -> empty coalesce is needed because
    ``arrays_zip`` of a NULL array is NULL (Spark would otherwise drop the row).
    Two chained ``explode``s would be a per-row cross product — never do that.
    ``ignore_padding=True`` instead emits each array separately (no NULL pads).
    """
    schema = {f.name: f.dataType for f in df.schema.fields}
    names = list(arrays)
    if ignore_padding:
        parts = []
        for out, src in arrays.items():
            other = {n: F.lit(None).cast(schema[arrays[n]].elementType) for n in names if n != out}
            parts.append(
                df.select(*keep, F.explode(src).alias(out)).select(*keep, *[
                    F.col(n) if n == out else other[n].alias(n) for n in names
                ])
            )
        out_df = parts[0]
        for p in parts[1:]:
            out_df = out_df.unionByName(p)
        return out_df
    zipped = F.arrays_zip(*[F.coalesce(F.col(src), _empty_like(schema[src])).alias(out) for out, src in arrays.items()])
    exploded = df.select(*keep, F.explode(zipped).alias("_z"))
    fields = exploded.schema["_z"].dataType.names
    return exploded.select(*keep, *[F.col("_z")[f].alias(n) for f, n in zip(fields, names)])


def explode_records(df: DataFrame, array_col: str, keep: list[str] | None = None) -> DataFrame:
    """``json_normalize(doc, record_path=[array_col])``: one row per element,
    struct fields become columns; a missing/empty array yields no rows."""
    return df.select(*(keep or []), F.inline(F.col(array_col)))


def quantity_to_int(c: str | Column) -> Column:
    """``"2x"`` -> 2 (leading digits); no digits -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.regexp_extract(col, r"^\s*([0-9]+)", 1), F.lit("")).cast("int")
