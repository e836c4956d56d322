"""Prefix, padding and length of array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefix(array: Column, length: Column | int) -> Column:
    """The first ``length`` elements, the whole array when it is shorter."""
    n = F.lit(length) if isinstance(length, int) else length
    return F.slice(array, F.lit(1), F.greatest(n, F.lit(0)))


def suffix(array: Column, length: int) -> Column:
    """The last ``length`` elements, the whole array when it is shorter."""
    n = F.least(F.size(array), F.lit(length))
    return F.slice(array, F.size(array) - n + 1, n)


def pad(array: Column, length: Column, filler: Column) -> Column:
    """Append ``filler`` until the array has ``length`` elements."""
    missing = F.greatest(length - F.size(array), F.lit(0))
    return F.concat(array, F.array_repeat(filler, missing))
