"""Text labels, recodes and prefix tests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _shown(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit("NA"))


def label(code: Column | str, name: Column | str) -> Column:
    """``code: name``, a missing part being written as the text NA."""
    return F.concat(_shown(code), F.lit(": "), _shown(name))


def recode(col: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace the mapped codes; every other value, NULL included, stays."""
    c = _col(col)
    replaced = [F.when(c == F.lit(old), F.lit(new)) for old, new in mapping.items()]
    return F.coalesce(*replaced, c)


def short_label(col: Column | str, mapping: Mapping[str, str], other: str) -> Column:
    """Mapped label, ``other`` for unlisted values, NULL for NULL."""
    c = _col(col)
    chain = F.when(c.isNull(), F.lit(None).cast("string"))
    for value, text in mapping.items():
        chain = chain.when(c == F.lit(value), F.lit(text))
    return chain.otherwise(F.lit(other))


def has_prefix(col: Column | str, prefix: str) -> Column:
    """Case-insensitive prefix test."""
    return F.lower(F.substring(_col(col), 1, len(prefix))) == F.lit(prefix.lower())
