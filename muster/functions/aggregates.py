"""Aggregate and ratio expressions with explicit NULL rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def n_distinct(col: Column | str) -> Column:
    """Distinct values, NULL counting as one value; 0 on empty input.

    For several distinct counts in one aggregate prefer ``operators.joins.distinct_counts``, which
    removes duplicates first and so avoids the row expansion of multiple distinct aggregates.
    """
    c = _col(col)
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("long")), F.lit(0).cast("long"))


def sum_or_zero(col: Column | str) -> Column:
    """Sum over the non-NULL values, 0 when there is none."""
    return F.coalesce(F.sum(_col(col)), F.lit(0))


def _strict(agg, col: Column | str, na_rm: bool) -> Column:
    c = _col(col)
    if na_rm:
        return agg(c)
    return F.when(F.count(F.lit(1)) == F.count(c), agg(c))


def max_na(col: Column | str, na_rm: bool = False) -> Column:
    """Maximum that is NULL as soon as one value is NULL, unless ``na_rm``."""
    return _strict(F.max, col, na_rm)


def min_na(col: Column | str, na_rm: bool = False) -> Column:
    """Minimum that is NULL as soon as one value is NULL, unless ``na_rm``."""
    return _strict(F.min, col, na_rm)


def pct(n: Column | str, d: Column | str, digits: int) -> Column:
    """``n / d`` as a percentage, rounded half to even; NULL when ``d`` is 0 or either side is NULL."""
    return F.bround(F.try_divide(_col(n).cast("double"), _col(d).cast("double")) * F.lit(100.0), digits)
