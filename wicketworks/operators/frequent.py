"""Frequent values and correlations of whole tables, from summaries that tasks make and Spark adds up."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.operators.profile import numeric_columns, top_values
from wicketworks.session import materialize

# Counters that a task keeps for a column: its counts are too low by at most its rows divided by this.
CAPACITY = 4096


def _summaries(capacity: int):
    """Per task and column: values with counts that are at most ``error`` too low, and one row with that error."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        counters: list[dict] = []
        errors: list[int] = []
        for batch in batches:
            if not counters:
                counters = [{} for _ in batch.columns]
                errors = [0] * len(counters)
            for i, values in enumerate(batch.columns):
                own = counters[i]
                found = pc.value_counts(values)
                for value, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist()):
                    own[value] = own.get(value, 0) + n
                if len(own) > capacity:
                    cut = sorted(own.values(), reverse=True)[capacity]
                    errors[i] += cut
                    counters[i] = {value: n - cut for value, n in own.items() if n > cut}
        for i, own in enumerate(counters):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i] * (len(own) + 1), pa.int32()),
                    pa.array([*own, None], pa.string()),
                    pa.array([False] * len(own) + [True], pa.bool_()),
                    pa.array([*own.values(), errors[i]], pa.int64()),
                ],
                ["at", "value", "error", "n"],
            )

    return count


def frequent_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 5, capacity: int = CAPACITY) -> DataFrame:
    """The ``k`` most frequent values of each column, exactly: (column, value, n, rank), ties to the smaller text.

    Tasks summarise their rows in at most ``capacity`` counters a column, so the exchange holds summaries, not values.
    Where no counter was dropped the sums are the counts. Elsewhere a value that could be among the first
    k has a sum of at least the k-th sum less the total error; if that error is below the k-th sum no value without
    a counter can be, and the candidates are counted in a second pass. Columns without such a proof, such as
    keys, have all their values counted. Null is a value; an empty table gives no rows.
    """
    names = list(columns) if columns is not None else df.columns
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(names)])
    parts = texts.mapInArrow(_summaries(capacity), "at int, value string, error boolean, n bigint")
    sums = materialize(parts.groupBy("at", "error", "value").agg(F.sum("n").alias("n")), "frequent")
    ranked = sums.withColumn("place", F.row_number().over(W.partitionBy("at", "error").orderBy(F.desc("n"))))
    firsts = ranked.where((F.col("place") <= k) | F.col("error"))
    # One row per column of the table.
    bounds = firsts.groupBy("at").agg(
        F.max(F.when(F.col("error"), F.col("n"))).alias("most"),
        F.min(F.when(~F.col("error") & (F.col("place") == k), F.col("n"))).alias("least"),
    ).collect()
    known = {b["at"] for b in bounds if b["most"] == 0}
    proven = {b["at"]: b["least"] - b["most"] for b in bounds if b["at"] not in known and (b["least"] or 0) > b["most"]}
    open_columns = [names[b["at"]] for b in bounds if b["at"] not in known and b["at"] not in proven]

    values = sums.where(~F.col("error"))
    counts = values.where(F.col("at").isin(*known)).select("at", "value", "n")
    if proven:
        floor = F.create_map(*[F.lit(x) for pair in proven.items() for x in pair])
        wanted = values.where(F.col("at").isin(*proven)).where(F.col("n") >= floor[F.col("at")])
        pairs = F.array(*[F.struct(F.lit(i).alias("at"), F.col(f"c{i}").alias("value")) for i in proven])
        wanted = wanted.select(F.col("at").alias("_at"), F.col("value").alias("_value"))
        there = texts.select(F.inline(pairs)).join(wanted, (F.col("at") == F.col("_at")) & F.col("value").eqNullSafe(F.col("_value")), "left_semi")
        counts = counts.union(there.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n")))
    named = counts.select(F.array(*[F.lit(c) for c in names])[F.col("at")].alias("column"), "value", "n")
    order = W.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    out = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.union(top_values(df, open_columns, k)) if open_columns else out


def _moments(centres: list[float]):
    """Per task: for every pair of columns the number of rows that have both, and sums, squares and products over them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        width = len(centres)
        left, right = np.triu_indices(width, 1)
        total = np.zeros((6, len(left)))
        for batch in batches:
            there = np.stack([np.asarray(c.is_valid()) for c in batch.columns], 1)
            x = np.stack([np.asarray(c.fill_null(0.0)) for c in batch.columns], 1) - np.array(centres)
            x[~there] = 0.0
            if np.isfinite(x).all():
                m = there.astype(float)
                s, q, p, n = x.T @ m, (x * x).T @ m, x.T @ x, m.T @ m
                total += [n[left, right], s[left, right], s[right, left], q[left, right], q[right, left], p[left, right]]
                continue
            # A value that is no number must reach only the pairs whose rows have it.
            for at, (i, j) in enumerate(zip(left, right)):
                both = there[:, i] & there[:, j]
                a, b = x[both, i], x[both, j]
                with np.errstate(invalid="ignore"):
                    total[:, at] += [len(a), a.sum(), b.sum(), (a * a).sum(), (b * b).sum(), (a * b).sum()]
        columns = [pa.array(left, pa.int32()), pa.array(right, pa.int32()), *[pa.array(t) for t in total]]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    return add


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None, digits: int | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns over the rows that have both: (left_column, right_column, corr).

    Each Arrow batch gives the products of all pairs as one matrix; a task hands on one row a pair.
    Values are taken from the column's mean first, which a pass of its own finds, so that large values with a small spread
    keep their digits. Null where fewer than two rows have both or one column is constant on them.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    finite = [F.when(F.abs(c) < float("inf"), c) for c in map(F.col, numbers.columns)]
    means = numbers.agg(*[F.coalesce(F.avg(c), F.lit(0.0)) for c in finite]).first()
    sums = numbers.mapInArrow(
        _moments(list(means)), "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    ).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])

    def spread(squares: str, total: str, at: str) -> Column:
        """Squared deviations; null where they are no more than the rounding of the mean."""
        rounding = F.array(*[F.lit((1e-13 * m) ** 2) for m in means])[F.col(at)]
        value = F.col(squares) - F.col(total) * F.col(total) / F.col("n")
        return F.when(value > rounding * F.col("n"), value)

    corr = (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / F.sqrt(spread("sxx", "sx", "i") * spread("syy", "sy", "j"))
    corr = F.when(F.col("n") > 1, corr)
    named = F.array(*[F.lit(c) for c in names])
    return sums.select(
        named[F.col("i")].alias("left_column"),
        named[F.col("j")].alias("right_column"),
        (F.round(corr, digits) if digits is not None else corr).alias("corr"),
    )
