"""Column expressions for dirty statistics tables.

Sentinel columns are read as strings; every cast is a ``try_cast`` and every division a
``try_divide``, so ANSI mode never aborts a job over one bad cell.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTINEL = "-"


def to_number(column: str | Column, kind: str) -> Column:
    """Numeric text to ``int`` or ``double``; text such as '12.0' is accepted as an int."""
    c = F.col(column) if isinstance(column, str) else column
    number = c.cast("string").try_cast("double")
    return number if kind == "double" else number.try_cast(kind)


def dash_to_zero(column: str, kind: str = "double") -> Column:
    """'-' becomes 0, null stays null, anything else is cast."""
    text = F.col(column).cast("string")
    return F.when(text == SENTINEL, F.lit(0).cast(kind)).otherwise(to_number(text, kind))


def dash_to_ratio(column: str, numerator: str | Column, denominator: str | Column) -> Column:
    """'-' becomes numerator / denominator (null when the denominator is 0)."""
    text = F.col(column).cast("string")
    n = F.col(numerator) if isinstance(numerator, str) else numerator
    d = F.col(denominator) if isinstance(denominator, str) else denominator
    ratio = F.try_divide(n.cast("double"), d.cast("double"))
    return F.when(text == SENTINEL, ratio).otherwise(to_number(text, "double"))


def null_to_zero_int(column: str) -> Column:
    """Null text becomes 0, other text is cast to int."""
    return to_number(F.coalesce(F.col(column).cast("string"), F.lit("0")), "int")


def presence_flag(column: str) -> Column:
    """1 when the column holds anything, 0 when it is null."""
    return F.col(column).isNotNull().cast("int")


def binary_code(column: str, zero_value: str) -> Column:
    """0 for ``zero_value``, 1 for everything else, null included."""
    return F.when(F.col(column) == zero_value, 0).otherwise(1)


def null_safe_sum(*columns: str) -> Column:
    """Row-wise sum in which a null counts as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


def ratio_or_numerator(numerator: str, denominator: str, digits: int = 2) -> Column:
    """numerator / denominator, or the numerator itself where the denominator is 0."""
    n, d = F.col(numerator).cast("double"), F.col(denominator).cast("double")
    return F.round(F.when(d == 0, n).otherwise(n / d), digits)


def ratio_or_zero(numerator: str, denominator: str) -> Column:
    """numerator / denominator, 0 where the denominator is 0 or null."""
    n, d = F.col(numerator).cast("double"), F.col(denominator).cast("double")
    return F.when(d != 0, n / d).otherwise(F.lit(0.0))


def required_rate(target: str, score: str, overs: str, innings: str, innings_overs: int = 20) -> Column:
    """Runs still needed per remaining over; 0 in the first innings, null with no over left."""
    missing = (F.col(target) - F.col(score)).cast("double")
    left = (F.lit(innings_overs) - F.col(overs)).cast("double")
    return F.when(F.col(innings) == 1, F.lit(0.0)).otherwise(F.try_divide(missing, left))


def completed_overs(ball: str) -> Column:
    """Whole overs of a ball number: 19.6 is in over 19 (truncation toward zero)."""
    return F.col(ball).cast("int")


def null_or_nan(column: str, data_type: str) -> Column:
    """True for null, and for NaN where the type has one."""
    c = F.col(column)
    return c.isNull() | F.isnan(c) if data_type in ("double", "float") else c.isNull()


def won_by_batting_side(batting: str, winner: str) -> Column:
    """1 where the side batting on this row won the match."""
    return F.when(F.col(batting) == F.col(winner), 1).otherwise(0)


def won_by_chasing_side(batting: str, bowling: str, winner: str, innings: str) -> Column:
    """1 on every row of a match won by the side that bats second."""
    chase = (F.col(batting) == F.col(winner)) & (F.col(innings) == 2)
    defence = (F.col(bowling) == F.col(winner)) & (F.col(innings) == 1)
    return F.when(chase | defence, 1).otherwise(0)
