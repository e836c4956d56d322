"""Joins and set operations between keyed tables.

No hints except on fixed literals: sizes are only known at run time, so adaptive execution
chooses broadcast or sort-merge and splits oversized keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketworks.session import materialize


def inner_on(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Inner equi-join on same-named keys."""
    return left.join(right, [keys] if isinstance(keys, str) else list(keys), "inner")


def chain_inner(tables: Sequence[DataFrame], keys: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Inner joins on shared keys; names in ``drop`` are removed from every table first."""
    return reduce(lambda a, b: inner_on(a, b, keys), [t.drop(*drop) for t in tables])


def join_roles(
    facts: DataFrame,
    dimension: DataFrame,
    roles: Sequence[str],
    fact_period: str,
    entity: str,
    period: str,
    measures: Sequence[str],
) -> DataFrame:
    """Join one dimension once per role on (role column, period); measures get the role as suffix."""
    for role in roles:
        side = dimension.select(
            F.col(entity).alias("_entity"),
            F.col(period).alias("_period"),
            *[F.col(f"`{m}`").alias(f"{m} {role}") for m in measures],
        )
        matched = (F.col(role) == F.col("_entity")) & (F.col(fact_period) == F.col("_period"))
        facts = facts.join(side, matched, "inner").drop("_entity", "_period")
    return facts


def semi(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys, on, "left_semi")


def only_one_side(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Names on one side only, tagged with their side."""
    a = left.select(F.col(left_key).alias("name")).distinct()
    b = right.select(F.col(right_key).alias("name")).distinct()
    return (
        a.join(b, "name", "left_anti")
        .withColumn("side", F.lit("left"))
        .unionByName(b.join(a, "name", "left_anti").withColumn("side", F.lit("right")))
    )


def common_keys(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Distinct keys that occur in every table."""
    return reduce(lambda a, b: a.intersect(b), [t.select(key).distinct() for t in tables])


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have."""
    return left.select(key).subtract(right.select(key))


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """Union of tables with the same columns, matched by name."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def restrict_to_common(
    tables: Sequence[DataFrame], key: str, materialize_keys: bool = False, co_located: bool = False
) -> list[DataFrame]:
    """Each table limited to the keys all of them share.

    With ``materialize_keys`` the key set is written once instead of being derived per table. ``co_located`` tables are
    bucketed by the key: each one meets the keys of the others where it lies, without a key set and without an exchange.
    """
    if co_located:
        keyed = [t.select(key).distinct() for t in tables]
        return [reduce(lambda t, k: semi(t, k, key), keyed[:i] + keyed[i + 1 :], t) for i, t in enumerate(tables)]
    keys = common_keys(tables, key)
    if materialize_keys:
        keys = materialize(keys, "common-keys")
    return [semi(t, keys, key) for t in tables]
