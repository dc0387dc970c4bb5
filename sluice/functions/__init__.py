from sluice.functions.numeric import round_half_even_np
from sluice.functions.text import (
    PY_WHITESPACE,
    blank_to_null,
    join_list,
    normalized,
    py_strip,
    text_to_double,
)
from sluice.functions.time import (
    hours_between,
    minutes_between,
    parse_datetime,
    parse_iso,
    strftime_pattern,
)
from sluice.functions.json import from_json_message, to_json_message

__all__ = [
    "PY_WHITESPACE", "blank_to_null", "from_json_message", "hours_between",
    "join_list", "minutes_between", "normalized", "parse_datetime", "parse_iso", "py_strip",
    "round_half_even_np", "strftime_pattern", "text_to_double", "to_json_message",
]
