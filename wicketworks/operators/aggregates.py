"""Counts, de-duplication and ordered sequences per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.functions.cleaning import null_or_nan
from wicketworks.operators.skew import join_keys, split_hot, union_parts
from wicketworks.operators.windows import row_numbers

# Rows per array. A match has a few hundred balls, so it is one chunk; larger groups
# continue in further chunks instead of growing one cell without bound.
CHUNK_ROWS = 4096


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def distinct_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct combinations, nulls included, as ``select(...).distinct().count()``.

    Distinct with map-side combine, then a plain count: no task sees all the values.
    """
    return df.select(*columns).distinct().agg(F.count(F.lit(1)).alias("n_distinct"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``: an aggregation with map-side combine, without a sort of the rows.

    Nulls come first, as in an ordering.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return first.select("_row.*")


def null_counts(df: DataFrame, count_nan: bool = True) -> DataFrame:
    """Missing values per column in one pass; NaN counts as missing in float columns."""
    types = dict(df.dtypes)
    return df.select(
        *[
            F.count_if(null_or_nan(f"`{c}`", types[c] if count_nan else "")).alias(c)
            for c in df.columns
        ]
    )


def total_nulls(df: DataFrame) -> DataFrame:
    """Nulls over all columns, in one pass."""
    flags = [F.col(f"`{c}`").isNull().cast("bigint") for c in df.columns]
    total = reduce(lambda a, b: a + b, flags)
    return df.agg(F.coalesce(F.sum(total), F.lit(0)).alias("total_nulls"))


def sequences(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    features: Sequence[str],
    chunk_rows: int = CHUNK_ROWS,
    group_rows: int | None = None,
) -> DataFrame:
    """Ordered feature rows per key: (keys, chunk, start, rows).

    ``rows`` is an array of feature vectors, ``start`` the number of rows in earlier chunks.
    """
    vector = F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    numbered = row_numbers(df, keys, order, "_pos", group_rows)
    chunk = F.floor((F.col("_pos") - 1) / chunk_rows).cast("int")
    packed = (
        numbered.select(*keys, chunk.alias("chunk"), F.struct("_pos", vector.alias("v")).alias("_row"))
        .groupBy(*keys, "chunk")
        .agg(F.array_sort(F.collect_list("_row")).alias("_rows"))
    )
    return packed.select(
        *keys,
        "chunk",
        (F.col("chunk") * chunk_rows).alias("start"),
        F.transform("_rows", lambda r: r["v"]).alias("rows"),
    )


def first_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, name: str) -> DataFrame:
    """Value of ``column`` in the first row of each key."""
    return df.groupBy(*keys).agg(F.min_by(column, F.struct(*order)).alias(name))


def drop_last_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, group_rows: int | None = None
) -> DataFrame:
    """All rows except the last ``n`` of each key; exactly ``n``, even when rows tie on ``order``."""
    bounded, hot = split_hot(df, keys, group_rows)
    parts = []
    if bounded is not None:  # number and size in one exchange and one sort
        group = W.partitionBy(*keys)
        placed = bounded.withColumns({"_pos": F.row_number().over(group.orderBy(*order)), "_size": F.count(F.lit(1)).over(group)})
        parts.append(placed.where(F.col("_pos") <= F.col("_size") - n).drop("_pos", "_size"))
    if hot is not None:
        numbered = row_numbers(hot, keys, order, "_pos", group_rows)
        sizes = hot.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
        placed = join_keys(numbered, sizes, keys)
        parts.append(placed.where(F.col("_pos") <= F.col("_size") - n).drop("_pos", "_size").select(*df.columns))
    return union_parts(parts)


def last_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows of each key."""
    spec = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_n", F.row_number().over(spec)).where(F.col("_n") <= n).drop("_n")


def counts_by(df: DataFrame, column: str, total_label: str = "total") -> DataFrame:
    """Rows per value of ``column``, plus a total row."""
    label = F.when(F.grouping(column) == 1, F.lit(total_label)).otherwise(F.col(column))
    return df.rollup(column).agg(label.alias("group"), F.count(F.lit(1)).alias("n")).select("group", "n")
