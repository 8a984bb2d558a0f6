"""Null-exact joins, keyed de-duplication and distinct counting.

No join here carries a broadcast hint: Spark picks a broadcast only when a side is below
``spark.sql.autoBroadcastJoinThreshold`` (by file size, or by measured shuffle size under AQE), which ``tune``
lowers, and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Keys = str | Sequence[str | tuple[str, str]]
_TMP = "__right_"


def _pairs(on: Keys) -> list[tuple[str, str]]:
    keys = [on] if isinstance(on, str) else list(on)
    return [(k, k) if isinstance(k, str) else k for k in keys]


def _prepared(right: DataFrame, pairs: list[tuple[str, str]]) -> tuple[DataFrame, Column]:
    right = right.withColumnsRenamed({r: _TMP + r for _, r in pairs})
    cond = F.lit(True)
    for i, (l, r) in enumerate(pairs):
        same = F.col(l).eqNullSafe(F.col(_TMP + r))
        cond = same if i == 0 else cond & same
    return right, cond


def na_join(left: DataFrame, right: DataFrame, on: Keys, how: str = "left", hot_keys: bool = False) -> DataFrame:
    """Equi-join in which NULL keys match each other; the result has one copy of each key.

    ``on`` is a column name, or a list of names and ``(left, right)`` pairs. ``how`` is one of ``inner``,
    ``left``, ``right``, ``full``, ``left_semi``, ``left_anti``. Other columns must not clash.

    ``hot_keys=True`` is for joins whose *right* rows may pile up on a few keys. Spark can split an
    oversized partition on the right only in inner joins, so ``left`` and ``full`` are then put together
    from an inner join and anti joins on distinct keys. The rows are the same either way.
    """
    pairs = _pairs(on)
    right_keys = {r for _, r in pairs}
    clash = (set(left.columns) & set(right.columns)) - right_keys
    clash |= {r for l, r in pairs if l != r and r in left.columns}
    if how in ("left_semi", "left_anti"):
        return _membership(left, right, pairs, how)
    if clash:
        raise ValueError(f"columns on both sides of the join: {sorted(clash)}")
    if hot_keys and how in ("left", "full"):
        return _split_outer(left, right, pairs, how)

    keyed, cond = _prepared(right, pairs)
    joined = left.join(keyed, cond, how)
    temp = [_TMP + r for _, r in pairs]
    if how in ("right", "full"):
        # On either side a NULL key may be a missing row or a matched NULL; coalescing is right for both.
        joined = joined.withColumns({l: F.coalesce(F.col(l), F.col(_TMP + r)) for l, r in pairs})
    return joined.drop(*temp)


def _common_type(left: DataFrame, l: str, right: DataFrame, r: str) -> T.DataType:
    """The type in which Spark compares the two columns by value."""
    return left.select(F.col(l).alias("k")).union(right.select(F.col(r).alias("k"))).schema["k"].dataType


def _default(kind: T.DataType) -> Column:
    """Any value of the type, to stand where a NULL flag already tells NULL apart."""
    if isinstance(kind, T.BinaryType):
        return F.lit(b"")
    text = {T.StringType: "", T.BooleanType: "false", T.DateType: "1970-01-01"}
    text |= {T.TimestampType: "1970-01-01", T.TimestampNTZType: "1970-01-01"}
    if type(kind) in text:
        return F.lit(text[type(kind)]).cast(kind)
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    raise TypeError(f"keys of type {kind.simpleString()} are not supported")


def _membership(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], how: str) -> DataFrame:
    """Semi or anti join by value, in the common type of both keys, where NULL matches NULL.

    The right side folds to its distinct (value, is NULL) pairs, map side first, so however often a key repeats
    it is moved once per task. For keys that can be NULL the join reuses the partitioning of that fold. Where a
    right key cannot be NULL the flag is a constant and the folded keys are shuffled once more, by value alone:
    then both sides of the join are plain shuffles and adaptive execution can split a hot key on the left.
    """
    names, cond = [], F.lit(True)
    for l, r in pairs:
        kind = _common_type(left, l, right, r)
        for i, side in enumerate((lambda c: F.coalesce(c, _default(kind)), lambda c: c.isNull())):
            alias = f"{_TMP}{r}_{i}"
            names.append(side(F.col(r).cast(kind)).alias(alias))
            cond = cond & (side(F.col(l).cast(kind)) == F.col(alias))
    return left.join(right.select(*names).distinct(), cond, how)


def _split_outer(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], how: str) -> DataFrame:
    parts = [
        na_join(left, right, pairs, "inner"),
        na_join(left, right, pairs, "left_anti"),
    ]
    if how == "full":
        flipped = [(r, l) for l, r in pairs]
        only_right = na_join(right, left, flipped, "left_anti")
        parts.append(only_right.withColumnsRenamed({r: l for l, r in pairs}))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def distinct_counts(df: DataFrame, by: Sequence[str], member: str, name: str) -> DataFrame:
    """Distinct ``member`` values per group, a NULL member counting once.

    Duplicates are removed (map side first) before the group count, so neither a repeated member nor a
    dominant group ever moves its raw rows through one task.
    """
    distinct = df.select(*by, member).distinct()
    counts = [F.count(F.lit(1)).alias(name)]
    return distinct.groupBy(*by).agg(*counts) if by else distinct.agg(*counts)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key under ``order`` (NULLs last).

    Spark trims each map task to its own first row per key before the shuffle, so a hot key is cheap.
    """
    ordering = [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df`` after checking that no key repeats (runs a job); raise ``ValueError`` otherwise."""
    sample = duplicate_keys(df, keys).limit(3).collect()
    if sample:
        shown = [tuple(row[k] for k in keys) for row in sample]
        raise ValueError(f"repeated keys {list(keys)}: {shown}")
    return df
