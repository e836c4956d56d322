"""Queries of this subpackage over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(spark, directory)`` under ``name``."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file; the operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)
