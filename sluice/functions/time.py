"""Date-time parsing and differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# strftime directive -> Spark datetime pattern.  Python's %d/%m/%H/%M accept
# one- or two-digit fields when parsing, which single letters (d, M, H, m) do in
# Spark; ``dd`` would reject "1-2-2018".
STRFTIME_TO_SPARK = {
    "%d": "d",
    "%m": "M",
    "%Y": "yyyy",
    "%y": "yy",
    "%H": "H",
    "%M": "m",
    "%S": "s",
    "%f": "SSSSSS",
    "%%": "%",
}


def strftime_pattern(fmt: str) -> str:
    """Translate a strftime format into a Spark parse pattern."""
    out, i = [], 0
    while i < len(fmt):
        tok = fmt[i : i + 2]
        if tok in STRFTIME_TO_SPARK:
            out.append(STRFTIME_TO_SPARK[tok])
            i += 2
        else:
            ch = fmt[i]
            out.append(f"'{ch}'" if ch.isalpha() else ch)
            i += 1
    return "".join(out)


def parse_datetime(c: str | Column, fmt: str = "%d-%m-%Y %H:%M", lenient: bool = False) -> Column:
    """``pd.to_datetime(c, format=fmt)``; junk raises (ANSI) unless ``lenient``."""
    pattern = strftime_pattern(fmt)
    return F.try_to_timestamp(_col(c), F.lit(pattern)) if lenient else F.to_timestamp(_col(c), pattern)


def parse_iso(c: str | Column, lenient: bool = False) -> Column:
    """ISO-8601 text -> UTC wall clock (timestamp without zone), whatever the session's
    zone.  Text without a zone is UTC."""
    text = _col(c)
    # the usual "...Z" is the wall clock itself: one parse, no zone
    plain = text.try_cast("timestamp_ntz") if lenient else text.cast("timestamp_ntz")
    return F.when(text.rlike(_UTC_TEXT), plain).otherwise(_with_zone(text, lenient))


_UTC_TEXT = r"\A\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d{1,6})?Z\z"


def _with_zone(text: Column, lenient: bool) -> Column:
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})\s*$"), text).otherwise(F.concat(text, F.lit("Z")))
    instant = F.try_to_timestamp(zoned) if lenient else F.to_timestamp(zoned)
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")))


def micros_between(start: str | Column, end: str | Column) -> Column:
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """``(end - start).total_seconds() / 60`` with the fraction kept; NULL in -> NULL."""
    return micros_between(start, end) / F.lit(60_000_000.0)


def hours_between(start: str | Column, end: str | Column) -> Column:
    """``(end - start).total_seconds() / 3600``."""
    return micros_between(start, end) / F.lit(3_600_000_000.0)
