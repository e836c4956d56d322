"""Registered queries over the given tables, each with its SQL equivalent where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


class Tables:
    """The tables of one directory, as attributes; ``sql`` runs over ``{table}`` placeholders."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark = spark
        self.directory = directory.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        # Kept, so that a query looks up the schema of a table once.
        self.__dict__[name] = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        return self.__dict__[name]

    def sql(self, text: str) -> DataFrame:
        used = {n: getattr(self, n) for n in NAMES if f"{{{n}}}" in text}
        # Both engines read this text; Spark quotes names with backticks.
        return self.spark.sql(text.replace('"', "`"), **used)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name``; ``sql`` uses the same placeholders."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, directory: build(Tables(spark, directory))
        if sql is not None:
            text = sql
            for table in NAMES:
                text = text.replace(f"{{{table}}}", table)
            ORACLES[name] = text
        return build

    return register


def rounded(expression: str, digits: int = 2) -> str:
    """SQL for rounding half up on the decimal value, as Spark rounds doubles."""
    return f"CAST(round(CAST(({expression}) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"
