"""Parts of labels such as ``A Name (IND) [12]``; an absent part gives ''."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that cut a player label.
IN_PARENTHESES = r"\((.*?)\)"
IN_BRACKETS = r"\[(.*?)\]"
BEFORE_PARENTHESIS = r"^(.*?)\s\("


def label_country(column: str) -> Column:
    return F.regexp_extract(F.col(column), IN_PARENTHESES, 1)


def label_id(column: str) -> Column:
    return F.regexp_extract(F.col(column), IN_BRACKETS, 1)


def label_name(column: str) -> Column:
    return F.regexp_extract(F.col(column), BEFORE_PARENTHESIS, 1)
