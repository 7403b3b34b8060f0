"""Column expressions. All of them are built from Spark's own functions."""

from tidewatch.functions.numbers import percent, round_half_even, safe_ratio
from tidewatch.functions.text import is_blank, normalize_label, strip_text
from tidewatch.functions.typed import calendar_day, exact_text, to_number, to_utc_timestamp

__all__ = [
    "calendar_day",
    "exact_text",
    "is_blank",
    "normalize_label",
    "percent",
    "round_half_even",
    "safe_ratio",
    "strip_text",
    "to_number",
    "to_utc_timestamp",
]
