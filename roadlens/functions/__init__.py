"""Column expressions (built-in Spark SQL only, no Python UDF)."""

from roadlens.functions.dates import (
    after, before, date_hour, date_of, format_date, format_date_key, format_time,
    format_time_minute, lenient_seconds, minus_seconds, parse_date_key, parse_time,
    range_label, seconds_text, today, yesterday,
)
from roadlens.functions.numbers import format_double, format_double_binary, half_up_ratio, to_int
from roadlens.functions.text import (
    is_empty, is_not_empty, kv_field, kv_map, kv_set_field, pad2, pad_id, trim_comma,
)

__all__ = [
    "after", "before", "date_hour", "date_of", "format_date", "format_date_key",
    "format_time", "format_time_minute", "lenient_seconds", "minus_seconds",
    "parse_date_key", "parse_time", "range_label", "seconds_text", "today", "yesterday",
    "format_double", "format_double_binary", "half_up_ratio", "to_int",
    "is_empty", "is_not_empty", "kv_field", "kv_map", "kv_set_field", "pad2", "pad_id",
    "trim_comma",
]
