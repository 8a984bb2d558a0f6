"""A stored order for tables that are written in many files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.plans.staging import Staging

#: Low bits of ``monotonically_increasing_id``: the place of a row in its partition.
_PLACE = (1 << 33) - 1


def with_position(df: DataFrame, groups: Sequence[str], order: Sequence[Column], staging: Staging, name: str) -> DataFrame:
    """``df`` with ``position``: 1, 2, 3 ... under ``order`` inside each of ``groups``, however large a group is.

    The rows are dealt by range and written once, so that every reader sees the same ranges; a range's rows know their place
    in it, and the counts of the ranges (a row for each range and group) give what comes before it. No group is brought into
    one task. Rows that tie under ``order`` take their positions in any order.
    """
    ranged = df.repartitionByRange(*[F.col(g).asc_nulls_last() for g in groups], *order) if groups else df.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(*[F.col(g).asc_nulls_last() for g in groups], *order)
    place = F.monotonically_increasing_id()
    marked = ranged.withColumns({"__range": F.shiftright(place, 33), "__place": place.bitwiseAND(F.lit(_PLACE))})
    kept = staging.keep(marked, name)
    counts = kept.groupBy("__range", *groups).agg(F.count(F.lit(1)).alias("__n"), F.min("__place").alias("__first"))
    before = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    offsets = offsets.select(*[F.col(c).alias(f"__{c}") for c in ("__range", *groups)], "__first", "__before")
    same = F.lit(True)
    for c in ("__range", *groups):
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    placed = kept.join(offsets, same)
    position = F.col("__place") - F.col("__first") + F.col("__before") + 1
    return placed.select(*df.columns, position.alias("position"))
