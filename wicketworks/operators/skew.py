"""Separating groups that are too large for one task from those that fit.

Grouped windows put each group into one task. That is the cheapest plan while groups
are small, and it breaks down when one key holds a large share of the rows. Operators
therefore ask ``split_hot`` once (one column-pruned count with map-side combine) and
treat the hot groups, if there are any, with a plan that divides them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketworks.session import materialize

# Rows of one group that a single task may be asked to sort.
GROUP_ROWS = 1_000_000
# Given as ``group_rows`` where every group is known to fit into a task, so that no operator looks again.
BOUNDED = 2**62


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on same-named keys in which null equals null, as in windows and groupings.

    Keys are kept once, from the left; other names must differ. The sides may share a source.
    """
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    pairs = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_right_{k}`")) for k in keys]
    return left.join(renamed, reduce(lambda a, b: a & b, pairs), how).drop(*[f"_right_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], group_rows: int) -> DataFrame:
    """Keys with more than ``group_rows`` rows; at most count / group_rows of them."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.where(F.col("_rows") > group_rows).drop("_rows")


def group_limit(df: DataFrame, keys: Sequence[str], rows: int | None = None, group_rows: int | None = None) -> int:
    """``BOUNDED`` if every group of a stored table fits into a task, else the limit above which it does not.

    One look for all operators that work on these groups; and none if the table's ``rows``, counted when it was written, are
    too few for any group to exceed the limit.
    """
    limit = GROUP_ROWS if group_rows is None else group_rows
    if rows is not None and rows <= limit:
        return BOUNDED
    if not keys or not hot_keys(df, keys, limit).isEmpty():
        return limit
    return BOUNDED


def split_hot(
    df: DataFrame, keys: Sequence[str], group_rows: int | None = None
) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of bounded groups and rows of hot groups; ``None`` for an absent part. ``BOUNDED`` takes no look."""
    limit = GROUP_ROWS if group_rows is None else group_rows
    if limit >= BOUNDED and keys:
        return df, None
    if not keys:  # a whole table is no group that anyone has looked at
        limit = GROUP_ROWS if limit >= BOUNDED else limit
        return (None, df) if df.count() > limit else (df, None)
    hot = hot_keys(df, keys, limit)
    if hot.isEmpty():
        return df, None
    hot = materialize(hot, "hot-keys")
    return join_keys(df, hot, keys, "left_anti"), join_keys(df, hot, keys, "left_semi")


def union_parts(parts: Sequence[DataFrame | None]) -> DataFrame:
    """Union of the parts that exist."""
    return reduce(lambda a, b: a.unionByName(b), [p for p in parts if p is not None])
