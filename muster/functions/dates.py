"""Date parsing, week starts and date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading part that must look like a date, and the pattern to read it with. Text after it is ignored.
_STYLES = {
    "dmy": (r"^\s*(\d{1,2}/\d{1,2}/\d{4})", "d/M/yyyy"),
    "ymd": (r"^\s*(\d{4}-\d{1,2}-\d{1,2})", "yyyy-M-d"),
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(col: Column | str, style: str) -> Column:
    """Text to date; ``style`` is ``dmy`` or ``ymd``. Unreadable text becomes NULL, never an error."""
    shape, fmt = _STYLES[style]
    return F.try_to_date(F.nullif(F.regexp_extract(_col(col), shape, 1), F.lit("")), fmt)


def week_floor(col: Column | str) -> Column:
    """The Sunday on or before the date."""
    c = _col(col)
    return F.date_sub(c, F.dayofweek(c) - F.lit(1))


def date_text(col: Column | str) -> Column:
    return F.date_format(_col(col), "yyyy-MM-dd")


def month_stamp(col: Column | str) -> Column:
    """Month name and year run together, e.g. ``December2023``."""
    return F.date_format(_col(col), "MMMMyyyy")
