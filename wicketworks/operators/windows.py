"""Running values inside a key.

``running`` is the one primitive: running sum, count, min, max and last non-null value,
with a ROWS or RANGE frame, including or excluding the current row. Bounded groups use
one ordinary window. Hot groups are cut into ordered blocks whose totals are carried
forward, so no task ever holds a whole hot group and the result is the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.operators.skew import GROUP_ROWS, join_keys, split_hot, union_parts
from wicketworks.session import materialize


class Running(NamedTuple):
    """One running value: ``kind`` is sum, count, min, max or last (non-null)."""

    kind: str
    column: str | None
    name: str


_OVER = {
    "sum": lambda c: F.sum(c),
    "count": lambda c: F.count(F.lit(1)),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "last": lambda c: F.last(c, ignorenulls=True),
}


def _frame(spec: WindowSpec, frame: str, inclusive: bool) -> WindowSpec:
    if frame == "range":
        if not inclusive:
            raise ValueError("a RANGE frame always includes the current row")
        return spec.rangeBetween(W.unboundedPreceding, W.currentRow)
    return spec.rowsBetween(W.unboundedPreceding, W.currentRow if inclusive else -1)


def _windowed(df, keys, order, measures, frame, inclusive) -> DataFrame:
    spec = _frame(W.partitionBy(*keys).orderBy(*order), frame, inclusive)
    return df.withColumns({m.name: _OVER[m.kind](m.column).over(spec) for m in measures})


def _merge(kind: str, carried: Column, local: Column) -> Column:
    if kind in ("sum", "count"):
        return F.coalesce(carried + local, local, carried)
    if kind == "last":
        return F.coalesce(local, carried)
    return (F.greatest if kind == "max" else F.least)(carried, local)


def _blocked(df, keys, order, measures, inclusive, group_rows) -> DataFrame:
    """ROWS frame over hot groups: order the rows over tasks, then carry block totals.

    The row number within its input task breaks all ties, exact copies included. It and
    the block number are written out before use: both must stay fixed if a task is rerun.
    There are as many blocks as keep each near the rows allowed for one task.
    """
    numbered = materialize(df.withColumn("_seq", F.monotonically_increasing_id()), "numbered")
    total_order = [*order, "_seq"]
    n_blocks = ceil(numbered.count() / (group_rows or GROUP_ROWS)) + 1
    ranges = numbered.repartitionByRange(n_blocks, *keys, *total_order)
    ranged = materialize(ranges.withColumn("_block", F.spark_partition_id()), "blocks")
    inside = [m._replace(name=f"_in_{m.name}") for m in measures]
    local = _windowed(ranged, [*keys, "_block"], total_order, inside, "rows", inclusive)

    position = F.struct(*total_order)
    total = {
        "sum": lambda c: F.sum(c),
        "count": lambda c: F.count(F.lit(1)),
        "min": lambda c: F.min(c),
        "max": lambda c: F.max(c),
        "last": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), position)),
    }
    blocks = ranged.groupBy(*keys, "_block").agg(
        *[total[m.kind](m.column).alias(f"_upto_{m.name}") for m in measures]
    )
    # One row per key and block: the window below sees at most as many rows as there are blocks.
    before = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    again = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    carried = blocks.select(
        *keys,
        "_block",
        *[
            (
                F.last(f"_upto_{m.name}", ignorenulls=True)
                if m.kind == "last"
                else again[m.kind](f"_upto_{m.name}")
            )
            .over(before)
            .alias(f"_upto_{m.name}")
            for m in measures
        ],
    )
    joined = join_keys(local, carried, [*keys, "_block"], "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[
            _merge(m.kind, F.col(f"`_upto_{m.name}`"), F.col(f"`_in_{m.name}`")).alias(m.name)
            for m in measures
        ],
    )


def _range_by_points(df, keys, order, measures, group_rows) -> DataFrame:
    """RANGE frame over hot groups: peers share one value, so run over distinct points.

    The points are pre-aggregated on the map side; the rows are joined back to them on the
    full (key, order) pair, where adaptive execution splits an oversized pair.
    """
    at_point = {"sum": F.sum, "min": F.min, "max": F.max}
    aggs, steps = [], []
    for m in measures:
        if m.kind == "last":
            raise ValueError("last needs a ROWS frame")
        value = F.count(F.lit(1)) if m.kind == "count" else at_point[m.kind](m.column)
        aggs.append(value.alias(f"_at_{m.name}"))
        steps.append(Running("sum" if m.kind == "count" else m.kind, f"_at_{m.name}", m.name))
    points = df.groupBy(*keys, *order).agg(*aggs)
    upto = running(points, keys, order, steps, group_rows=group_rows)
    upto = upto.select(*keys, *order, *[F.col(f"`{m.name}`") for m in measures])
    return join_keys(df, upto, [*keys, *order])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Sequence[Running],
    frame: str = "rows",
    inclusive: bool = True,
    group_rows: int | None = None,
) -> DataFrame:
    """Add the running values in ``measures``; ``order`` holds column names, ascending.

    With a ROWS frame the order should be total, or tied rows are numbered arbitrarily.
    """
    bounded, hot = split_hot(df, keys, group_rows)
    parts = []
    if bounded is not None:
        parts.append(_windowed(bounded, keys, order, measures, frame, inclusive))
    if hot is not None:
        parts.append(
            _range_by_points(hot, keys, order, measures, group_rows)
            if frame == "range"
            else _blocked(hot, keys, order, measures, inclusive, group_rows)
        )
    return union_parts(parts)


def attach_group(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: dict[str, Column],
    group_rows: int | None = None,
) -> DataFrame:
    """Give every row the aggregates of its group.

    ``aggregates`` maps a new column name to an aggregate expression. Hot groups are
    aggregated with map-side combine and joined back instead of being windowed.
    """
    bounded, hot = split_hot(df, keys, group_rows)
    parts = []
    if bounded is not None:
        spec = W.partitionBy(*keys)
        parts.append(bounded.withColumns({n: a.over(spec) for n, a in aggregates.items()}))
    if hot is not None:
        parts.append(join_group(hot, keys, aggregates))
    return union_parts(parts)


def join_group(df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column]) -> DataFrame:
    """``attach_group`` by aggregation and join, whatever the group sizes."""
    totals = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    return join_keys(df, totals, keys)


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "row_num",
    group_rows: int | None = None,
) -> DataFrame:
    """1-based position of each row inside its key."""
    return running(df, keys, order, [Running("count", None, name)], group_rows=group_rows)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: dict[str, str],
    group_rows: int | None = None,
) -> DataFrame:
    """Running totals where rows tied on ``order`` share the total of all of them."""
    measures = [Running("sum", source, name) for name, source in totals.items()]
    return running(df, keys, order, measures, frame="range", group_rows=group_rows)


def running_max(df, keys, order, column: str, name: str, group_rows: int | None = None) -> DataFrame:
    """Largest value so far; rows tied on ``order`` are peers."""
    return running(df, keys, order, [Running("max", column, name)], "range", group_rows=group_rows)


def forward_fill(df, keys, order, column: str, name: str | None = None, group_rows: int | None = None) -> DataFrame:
    """Replace nulls by the last non-null value before them in the key."""
    filled = running(df, keys, order, [Running("last", column, "_filled")], group_rows=group_rows)
    return filled.withColumn(name or column, F.col("_filled")).drop("_filled")


class Weighted(NamedTuple):
    """Weighted mean of ``value`` by ``weight``, zero unless the running ``gate`` is non-zero."""

    value: str
    weight: str
    gate: str | None = None


class Ratio(NamedTuple):
    """Ratio of two running sums, zero where the denominator is zero."""

    numerator: str
    denominator: str


def exclusive_cumulative(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, str],
    means: dict[str, Weighted] | None = None,
    ratios: dict[str, Ratio] | None = None,
    digits: int = 2,
    group_rows: int | None = None,
) -> DataFrame:
    """Statistics of everything *before* the current row; the first row of a key gets 0.

    ``sums`` maps result to source column. All running sums share one window.
    """
    means, ratios = means or {}, ratios or {}
    products = {n: F.col(m.value) * F.col(m.weight) for n, m in means.items()}
    base = df.withColumns({f"_wx_{n}": p for n, p in products.items()}) if products else df
    needed = set(sums.values())
    needed |= {c for m in means.values() for c in (m.weight, m.gate or m.weight)}
    needed |= {c for r in ratios.values() for c in r}
    measures = [Running("count", None, "_earlier")]
    measures += [Running("sum", c, f"_sum_{c}") for c in sorted(needed)]
    measures += [Running("sum", f"_wx_{n}", f"_sum_wx_{n}") for n in means]
    base = running(base, keys, order, measures, inclusive=False, group_rows=group_rows)

    def total(column: str) -> Column:
        return F.col(f"`_sum_{column}`")

    def guarded(gate: Column, value: Column) -> Column:
        return F.round(F.when(gate != 0, value).otherwise(0.0), digits)

    results = {name: total(source) for name, source in sums.items()}
    for name, m in means.items():
        value = F.try_divide(F.col(f"`_sum_wx_{name}`"), total(m.weight))
        results[name] = guarded(total(m.gate or m.weight), value)
    for name, r in ratios.items():
        value = F.try_divide(total(r.numerator), total(r.denominator))
        results[name] = guarded(total(r.denominator), value)
    first = F.col("_earlier") == 0
    return base.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.when(first, F.lit(0)).otherwise(v).alias(n) for n, v in results.items()],
    )
