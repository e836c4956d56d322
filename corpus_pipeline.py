"""A corpus made ready for training: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wicketworks.llm import simhash
from wicketworks.llm.common import free_name
from wicketworks.llm.language import keep_identified
from wicketworks.llm.line_dedup import dedup_lines
from wicketworks.llm.mixing import mixture
from wicketworks.llm.packing import pack
from wicketworks.llm.registry import table, tokenizer
from wicketworks.llm.similar import drop_similar
from wicketworks.session import materialize


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or in no language that is told with some confidence go."""
    return keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents that had nothing else."""
    deduped = dedup_lines(docs)
    n_removed = F.col(free_name(docs, "n_removed"))
    cut = deduped.where((n_removed == 0) | (F.length(F.trim("text")) > 0))
    n_chars = F.when(n_removed > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", n_chars).select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links or a five-word similarity of 0.8 or more joins stays."""
    texts = docs.select(F.xxhash64("text").alias("th"), "text")
    groups = simhash.near_duplicates(texts, doc_id="th")
    return drop_similar(docs, links=groups.select(F.col("component_id").alias("a"), F.col("th").alias("b")).where("a <> b"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares, documents repeated as the mix repeats them."""
    return mixture(docs).select(*_columns(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix in sequences of at most 2,048 tokens."""
    return pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

# A learned model, fingerprints and a tokenizer are beyond SQL: tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
