"""Sorting, best records and sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Global order (a range shuffle): only in front of a sink or a limit."""
    return df.orderBy(*columns)


def best(df: DataFrame, metric: str, maximize: bool = True, k: int = 1, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The k-th best record; a missing metric ranks last in either direction."""
    metric_order = F.col(metric).desc_nulls_last() if maximize else F.col(metric).asc_nulls_last()
    top = df.orderBy(metric_order, *tiebreak).limit(k)
    # The k-th of the k rows: skip the k - 1 better ones.
    return top.orderBy(metric_order, *tiebreak).offset(k - 1)


def hash_unit(key: str | Column, seed: int, buckets: int = 10_000) -> Column:
    """A reproducible draw from 0 .. buckets-1 per key: md5 of 'seed:key'."""
    text = F.concat_ws(":", F.lit(str(seed)), (F.col(key) if isinstance(key, str) else key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


def bernoulli_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Independent sample by key; the same key is always drawn alike, on any cluster."""
    return df.where(hash_unit(key, seed) < int(round(fraction * 10_000)))


def any_key(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """One key of a sample of the distinct keys."""
    keys = bernoulli_sample(df.select(key).distinct(), key, fraction, seed)
    return keys.orderBy(hash_unit(key, seed + 1), key).limit(1)


def one_per_class(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """One random record of each class, by aggregation (no task holds a class)."""
    draw = F.struct(hash_unit(key, seed), F.col(key))
    rest = [c for c in df.columns if c != label]
    picked = df.groupBy(label).agg(F.min_by(F.struct(*rest), draw).alias("_r"))
    return picked.select(label, "_r.*")
