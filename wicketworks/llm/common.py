"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wicketworks.session import materialize


def salted_buckets(rows: int, rows_per_bucket: int = 50_000, least: int = 256) -> int:
    """Buckets for dividing one group: enough that even all rows in one group stay near ``rows_per_bucket``."""
    return max(least, -(-rows // rows_per_bucket))


def keyed_hash(seed: int, *columns: Column) -> Column:
    """60 bits of md5 over the seed and the columns as text: the same on any engine."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("null")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def whole_row(docs: DataFrame) -> Column:
    """A row in one struct, so that no column of it meets the names an operator uses; ``select("name.*")`` unpacks it."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until ``docs`` has no such column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def release_memory() -> None:
    """Give memory that a worker has freed back to the system, where its C library can."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(made: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``made``, after whose last batch the worker, which stays for later tasks, gives its memory back."""

    @wraps(made)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from made(batches)  # its frame, and all that it remembered, is gone behind this
        finally:
            release_memory()

    return run


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges`` (a long, b long): ``node`` and ``root``, one row per node.

    The root is the component's smallest node. Each round every node hooks onto its smallest
    neighbour, hooks are followed twice, and the graph is contracted: edges inside a
    component vanish, so the graph shrinks geometrically. All state lives in written tables; the
    driver only learns whether edges are left. A node with very many neighbours is
    pre-aggregated by the minimum and its edges are an ordinary skewed join.
    """
    ordered = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    ordered = materialize(ordered, f"{name}-edges")
    known: DataFrame | None = None
    while not ordered.isEmpty():
        both = ordered.union(ordered.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).where("to < node")
        hooks = materialize(_follow(_follow(hooks)), f"{name}-hooks")
        if known is None:
            # Every node is in the first graph; a local minimum is its own root so far.
            nodes = ordered.select(F.col("a").alias("node")).union(ordered.select(F.col("b").alias("node"))).distinct()
            known = nodes.select("node", F.col("node").alias("root"))
        known = materialize(_moved(known, "root", hooks), f"{name}-roots")
        moved = _moved(_moved(ordered, "a", hooks), "b", hooks).where("a <> b")
        moved = moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        ordered = materialize(moved, f"{name}-edges")
    if known is None:
        return ordered.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return known


def _follow(hooks: DataFrame) -> DataFrame:
    """Each hook moved on to where its target hooks."""
    return _moved(hooks, "to", hooks)


def _moved(rows: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    target = hooks.select(F.col("node").alias("_from"), F.col("to").alias("_onto"))
    joined = rows.join(target, F.col(column) == F.col("_from"), "left")
    return joined.withColumn(column, F.coalesce("_onto", column)).select(*rows.columns)
