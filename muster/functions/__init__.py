"""Column helpers that pin down null, rounding and week rules; all stay inside JVM codegen."""

from .aggregates import max_na, min_na, n_distinct, pct, sum_or_zero
from .dates import date_text, month_stamp, parse_date, week_floor
from .grid import bng_to_wgs84
from .text import has_prefix, label, recode, short_label

__all__ = [
    "bng_to_wgs84",
    "date_text",
    "has_prefix",
    "label",
    "max_na",
    "min_na",
    "month_stamp",
    "n_distinct",
    "parse_date",
    "pct",
    "recode",
    "short_label",
    "sum_or_zero",
    "week_floor",
]
