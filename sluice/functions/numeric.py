"""Rounding helpers with explicit, documented tie rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even_np(c: str | Column, digits: int = 2) -> Column:
    """numpy/pandas ``round(x, digits)``: ``rint(x * 10**d) / 10**d``.

    numpy scales in binary floating point and rounds half-to-even, so e.g.
    1.015 -> 1.01 (1.015*100 is 101.49999...).  Spark's ``round`` (HALF_UP on
    the decimal text) and ``bround`` (HALF_EVEN on the decimal text) both give
    1.02, hence this expression.  Stays inside whole-stage codegen.
    """
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)
