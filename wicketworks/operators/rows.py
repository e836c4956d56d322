"""Projection, guards, row filters and quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def pick(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column subset in the given order."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename by map; absent names are ignored."""
    return df.withColumnsRenamed(names)


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "table") -> DataFrame:
    """Fail before any job when a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
    return df


def require_rows(df: DataFrame, what: str = "table") -> DataFrame:
    """Fail when the table is empty; reads no more than one row."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows")
    return df


def lookup_table(spark: SparkSession, mapping: dict[str, str], key: str, value: str) -> DataFrame:
    """A fixed dictionary as a two-column table."""
    pairs = F.create_map(*[F.lit(x) for x in chain(*mapping.items())])
    return spark.range(1).select(F.explode(pairs).alias(key, value))


def replace_values(df: DataFrame, mapping: dict[str, str], columns: Sequence[str]) -> DataFrame:
    """Dictionary replacement; values outside the dictionary are kept."""
    return df.replace(mapping, subset=list(columns))


def keep_listed(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Whitelist for a short fixed list."""
    return df.where(F.col(column).isin(list(values)))


def keep_matching(df: DataFrame, keys: DataFrame, column: str, key: str | None = None) -> DataFrame:
    """Whitelist held in a table."""
    allowed = keys.select(F.col(key or column).alias("_key"))
    return df.join(allowed, F.col(column) == F.col("_key"), "left_semi")


def drop_listed(df: DataFrame, columns: Sequence[str], banned: DataFrame, key: str) -> DataFrame:
    """Blacklist on one or more columns. Null-safe: a null in the list removes nothing."""
    for column in columns:
        names = banned.select(F.col(key).alias("_banned"))
        df = df.join(names, F.col(column) == F.col("_banned"), "left_anti")
    return df


def map_codes(df: DataFrame, column: str, codes: dict[str, str]) -> DataFrame:
    """Keep rows whose code is known and replace the code by its name.

    The dictionary is a fixed literal, so broadcasting it is safe at any data size.
    """
    require_columns(df, [column])
    table = lookup_table(df.sparkSession, codes, "_code", "_name")
    joined = df.join(F.broadcast(table), F.col(column) == F.col("_code"))
    return joined.select(
        *[F.col("_name").alias(c) if c == column else F.col(f"`{c}`") for c in df.columns]
    )


def without_codes(codes: DataFrame, *excluded: DataFrame, key: str = "code") -> DataFrame:
    """Lookup table minus the keys of other lookup tables."""
    for other in excluded:
        codes = codes.join(other.select(key), key, "left_anti")
    return codes


def keep_equal(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == value)


def keep_containing(df: DataFrame, column: str, fragment: str) -> DataFrame:
    return df.where(F.col(column).contains(fragment))


def keep_kind(df: DataFrame, kind_column: str, kind: str, columns: Sequence[str]) -> DataFrame:
    """Rows of one kind, reduced to the columns that kind uses."""
    return df.where(F.col(kind_column) == kind).select(*columns)


def quarantine(df: DataFrame, reason: Column | str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows); a row is rejected when it has a reason."""
    if isinstance(reason, str):
        marked, name = df, reason
    else:
        marked, name = df.withColumn("reject_reason", reason), "reject_reason"
    accepted = marked.where(F.col(name).isNull()).drop(name)
    return accepted, marked.where(F.col(name).isNotNull())


def complete_groups(df: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Rows of the groups that have exactly ``size`` rows (count with map-side combine, then semi-join)."""
    return df.join(groups_of_size(df, keys, size), list(keys), "left_semi")


def groups_of_size(df: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Keys of the groups that have exactly ``size`` rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    return counts.where(F.col("_size") == size).drop("_size")
