"""Column profiles in a fixed number of passes."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.session import materialize

# Steps of a sketch of quantiles that one task may hold for every column.
SKETCH_STEPS = 10_000
QUARTILES = [0.25, 0.5, 0.75]
_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def numeric_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind.startswith(_NUMERIC)]


def column_profile(
    df: DataFrame, exact_distinct: bool = False, accuracy: int = 10_000, digits: int | None = None
) -> DataFrame:
    """One row per column: type, count, missing, distinct, min, max, mean, stddev, quartiles.

    One aggregation over the table. Distinct values are sketched in it by default; with
    ``exact_distinct`` they are counted in one more pass: pairs of column and value are made distinct,
    combined on the map side, and counted by column. Quartiles are sketched in up to ``accuracy`` steps; more
    steps than ``SKETCH_STEPS``, which would hold much of a large table in one task, are replaced by exact quartiles.
    """
    types = dict(df.dtypes)
    numeric = set(numeric_columns(df))
    exact = exact_quantiles(df, numeric_columns(df), QUARTILES) if accuracy > SKETCH_STEPS else None

    def quartiles_of(name: str, number: Column) -> Sequence[Column]:
        if name not in numeric:
            return [F.lit(None).cast("double")] * len(QUARTILES)
        if exact is not None:
            return [F.lit(value).cast("double") for value in exact[name]]
        sketch = F.percentile_approx(number, QUARTILES, accuracy)
        return [sketch[i] for i in range(len(QUARTILES))]

    def shown(value: Column) -> Column:
        return F.round(value, digits) if digits is not None else value

    def summary(name: str) -> Column:
        c = F.col(f"`{name}`")
        number = c.cast("double") if name in numeric else F.lit(None).cast("double")
        text = c.cast("string")
        distinct = F.lit(None).cast("bigint") if exact_distinct else F.approx_count_distinct(c)
        quartiles = [q.alias(n) for q, n in zip(quartiles_of(name, number), ("q1", "median", "q3"))]
        return F.struct(
            F.lit(name).alias("column"),
            F.lit(types[name]).alias("type"),
            F.count(c).alias("n"),
            F.count_if(c.isNull()).alias("missing"),
            distinct.alias("n_distinct"),
            F.min(text if name not in numeric else number).cast("string").alias("min_value"),
            F.max(text if name not in numeric else number).cast("string").alias("max_value"),
            shown(F.avg(number)).alias("mean"),
            shown(F.stddev(number)).alias("stddev"),
            *quartiles,
        )

    summaries = df.agg(F.array(*[summary(c) for c in df.columns]).alias("_columns"))
    profile = summaries.select(F.inline("_columns"))
    if not exact_distinct:
        return profile
    # The text of a value tells it from all others of its column; doubles print all their digits.
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("_v")) for c in df.columns])
    counts = df.select(F.inline(pairs)).distinct().groupBy("column").agg(F.count("_v").alias("_d"))
    joined = profile.join(counts, "column", "left")
    return joined.withColumn("n_distinct", F.coalesce("_d", F.lit(0))).drop("_d")


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], steps: int = SKETCH_STEPS) -> dict[str, list[float | None]]:
    """For each column the values at the ranks ceil(share * n), at least 1, of its non-null values as doubles; NaN is the largest.

    A sketch of ``steps`` steps brackets every quantile. One pass counts what lies below each bracket and the
    values inside it, which are few; the counts prove that the rank lies inside, or the bracket is widened and
    counted again. Bounds of all columns are fixed in number, so the driver holds as many as there are quantiles.
    """
    if not columns:
        return {}
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    wide = sorted({min(max(p + d, 0.0), 1.0) for p in shares for d in (0.0, *(s * k / steps for k in (2, 64, 2048) for s in (-1, 1)))} | {0.0, 1.0})
    sketched = numbers.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(numbers.columns)],
        *[F.percentile_approx(c, wide, steps).alias(f"s{i}") for i, c in enumerate(numbers.columns)],
        *[F.struct(F.min(c), F.max(c)).alias(f"m{i}") for i, c in enumerate(numbers.columns)],
    ).first()
    found: dict[str, list[float | None]] = {c: [None] * len(shares) for c in columns}
    open_ones = [(i, j, max(1, _rank(p, sketched[f"n{i}"]))) for i in range(len(columns)) for j, p in enumerate(shares) if sketched[f"n{i}"]]
    for reach in (2, 64, 2048, None):
        if not open_ones:
            break
        brackets = []
        for i, j, rank in open_ones:
            low, high = sketched[f"m{i}"]
            if reach is not None:
                low, high = (sketched[f"s{i}"][wide.index(min(max(shares[j] + s * reach / steps, 0.0), 1.0))] for s in (-1, 1))
            brackets.append((i, j, rank, low, high))
        open_ones = _select(numbers, brackets, found, columns)
    return found


def _rank(share: float, n: int) -> int:
    return int(ceil(Fraction(str(share)) * n))


def _select(numbers: DataFrame, brackets: list[tuple], found: dict[str, list[float | None]], columns: Sequence[str]) -> list[tuple]:
    """Fill in the quantiles whose bracket holds their rank; returns the others (column, quantile, rank)."""
    below = numbers.agg(*[F.count_if(F.col(f"c{i}") < F.lit(low)).alias(f"b{at}") for at, (i, _, _, low, _) in enumerate(brackets)]).first()
    inside = [
        F.when(F.col(f"c{i}").between(F.lit(low), F.lit(high)), F.struct(F.lit(at).alias("at"), F.col(f"c{i}").alias("value")))
        for at, (i, _, _, low, high) in enumerate(brackets)
    ]
    near = numbers.select(F.explode(F.array_compact(F.array(*inside))).alias("_x")).select("_x.*")
    counts = materialize(near.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n")), "quantiles")
    wanted = F.create_map(*[x for at, (_, _, rank, _, _) in enumerate(brackets) for x in (F.lit(at), F.lit(rank - below[f"b{at}"]).cast("bigint"))])
    # Values inside a bracket, each once: a small share of the table, ordered in one task per bracket.
    upto = F.sum("n").over(W.partitionBy("at").orderBy("value"))
    reached = counts.withColumn("upto", upto).where((F.col("upto") >= wanted[F.col("at")]) & (wanted[F.col("at")] >= 1))
    values = {r["at"]: r["value"] for r in reached.groupBy("at").agg(F.min("value").alias("value")).collect()}
    for at, value in values.items():
        found[columns[brackets[at][0]]][brackets[at][1]] = value
    return [(i, j, rank) for at, (i, j, rank, _, _) in enumerate(brackets) if at not in values]


def top_values(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """The ``k`` most frequent values of each column.

    Counts combine on the map side, and ``row_number <= k`` becomes a per-task limit, so a
    column with very many values still reaches its final task as k rows per input task.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    )
    counts = df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.withColumn(
        "rank", F.row_number().over(W.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("value")))
    )
    return ranked.where(F.col("rank") <= k)


def correlations(df: DataFrame, columns: Sequence[str] | None = None, digits: int | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, in one aggregation."""
    names = list(columns) if columns else numeric_columns(df)
    pairs = []
    for a, b in combinations(names, 2):
        value = F.corr(F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double"))
        value = F.round(value, digits) if digits is not None else value
        pairs.append(F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"), value.alias("corr")))
    return df.agg(F.array(*pairs).alias("_pairs")).select(F.inline("_pairs"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with their count."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
