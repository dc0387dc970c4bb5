"""String helpers that keep Python/pandas string semantics on the JVM side."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's ``str.strip()`` removes every character for which ``str.isspace()``
# is true, not only ASCII blanks; Spark's ``trim`` removes spaces only.  The set
# is derived from the running interpreter's Unicode tables.
PY_WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: str | Column) -> Column:
    """``str.strip()``: remove leading/trailing whitespace of every kind.

    Built with the Column API on purpose: inside a SQL string literal ``\\f``
    and ``\\v`` are not escapes, so a SQL ``btrim(x, '...')`` would strip the
    letters ``f``/``v`` instead.
    """
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def normalized(c: str | Column) -> Column:
    """``str.strip().lower()``."""
    return F.lower(py_strip(c))


def join_list(c: str | Column, sep: str = ", ") -> Column:
    """``sep.join(list)`` for list values; NULL stays NULL and ``[]`` gives ``''``.

    ``array_join`` (not ``concat_ws``, which turns NULL into ``''``).
    """
    return F.array_join(_col(c), sep)


def blank_to_null(c: str | Column) -> Column:
    """Absent or whitespace-only text becomes NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def text_to_double(c: str | Column, lenient: bool = False) -> Column:
    """Text -> double, NULL for absent/empty; junk raises unless ``lenient``.

    ``"0"`` stays ``0.0``.
    """
    v = blank_to_null(c)
    return v.try_cast("double") if lenient else v.cast("double")


def xml_escape(c: str | Column) -> Column:
    """Escape the three characters that matter inside XML text and attributes."""
    v = F.replace(_col(c), F.lit("&"), F.lit("&amp;"))
    v = F.replace(v, F.lit("<"), F.lit("&lt;"))
    v = F.replace(v, F.lit(">"), F.lit("&gt;"))
    return F.replace(v, F.lit('"'), F.lit("&quot;"))
