"""Ragged key-value match files: one attribute per line, order significant."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wicketworks import schemas
from wicketworks.sources.tables import file_key, only_files

_FIELDS = [field.split()[0] for field in schemas.INFO_LINE.split(", ")]


# Attributes of a match, and characters that an empty line may have.
MATCH_ATTRIBUTES = ["gender", "season", "winner"]
BLANK = " \n"


def parse_lines(lines: DataFrame) -> DataFrame:
    """(match_id, pos, line) to (match_id, pos, type, attribute, value, player, code).

    Short lines are filled with nulls on the right; spaces after a comma are skipped. Only lines
    with a quote need the CSV parser, all others are split at their commas.
    """
    quoted = F.from_csv("line", schemas.INFO_LINE, {"ignoreLeadingWhiteSpace": "true"})
    # An empty field is null, as in the CSV parser.
    part = [F.nullif(F.ltrim(F.get("_parts", F.lit(i))), F.lit("")) for i in range(len(_FIELDS))]
    plain = F.struct(*[p.alias(n) for p, n in zip(part, _FIELDS)])
    parsed = F.when(F.contains("line", F.lit('"')), quoted).otherwise(plain)
    return (
        lines.where(F.trim("line") != "")
        .select("match_id", "pos", "line", F.split("line", ",").alias("_parts"))
        .select("match_id", "pos", parsed.alias("_p"))
        .select("match_id", "pos", "_p.*")
    )


def read_match_info(spark: SparkSession, directory: str) -> DataFrame:
    """All info files of a directory as parsed lines.

    The text scan stays splittable: a line's place in its file is the start of its split,
    then its order inside the task, so no file is ever held whole.
    """
    lines = only_files(spark.read.text(directory), info=True).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.struct(
            F.col("_metadata.file_block_start").alias("split_start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("pos"),
        F.col("value").alias("line"),
    )
    return parse_lines(lines.withColumn("match_id", file_key()))


def split_text(files: DataFrame) -> DataFrame:
    """(file_name, text) to parsed lines, for texts that are already in a table."""
    return parse_lines(_text_lines(files))


def _text_lines(files: DataFrame) -> DataFrame:
    """(match_id, pos, line); lines end with a line feed, a carriage return before it or not."""
    return files.select(file_key().alias("match_id"), F.posexplode(F.split(_unix("text"), "\n")).alias("pos", "line"))


def _unix(text: str) -> Column:
    return F.replace(text, F.lit("\r\n"), F.lit("\n"))


def first_of(lines: DataFrame, attributes: list[str]) -> DataFrame:
    """One row per match that has any of the attributes: the first value of each, as columns."""
    chosen = lines.where(F.col("attribute").isin(attributes))
    return chosen.groupBy("match_id").agg(
        *[F.min_by("value", F.when(F.col("attribute") == a, F.col("pos"))).alias(a) for a in attributes]
    )


def wide_matches(lines: DataFrame) -> DataFrame:
    """One row per match with ``reject_reason``; null means accepted.

    Pure aggregation with map-side combine over the few lines that matter. The two ``team``
    lines become team1 and team2 in line order; for a repeated attribute the first line counts.
    """
    teams = lines.where(F.col("attribute") == "team").groupBy("match_id").agg(
        F.min_by("value", "pos").alias("team1"),
        F.max_by("value", "pos").alias("team2"),
        F.count(F.lit(1)).alias("_teams"),
    )
    rest = first_of(lines, MATCH_ATTRIBUTES)
    return _with_reason(lines.select("match_id").distinct().join(teams, "match_id", "left").join(rest, "match_id", "left"))


def _with_reason(wide: DataFrame) -> DataFrame:
    reason = (
        F.when(F.coalesce("_teams", F.lit(0)) != 2, F.lit("teams"))
        .when(F.col("gender").isNull(), F.lit("gender"))
        .when(F.col("season").isNull(), F.lit("season"))
        .when(F.col("winner").isNull(), F.lit("winner"))
    )
    return wide.select(
        "match_id", "team1", "team2", "gender", "season", "winner", reason.alias("reject_reason")
    )


def wide_texts(files: DataFrame) -> DataFrame:
    """``wide_matches`` of the lines of (file_name, text), in one pass: for texts that are costly to read again.

    Of a text only lines are parsed that may hold a wanted attribute, since its name or a quote is in them, and the first, so
    that every match with a line that is not blank has a row.
    """
    written = files.where(F.translate(_unix("text"), BLANK, "") != "")
    may_hold = [F.contains("line", F.lit(a)) for a in ("team", *MATCH_ATTRIBUTES, '"')]
    kept = _text_lines(written).where(reduce(lambda a, b: a | b, may_hold, F.col("pos") == 0))
    # The first line stands for its match even if it is blank, so it must not be left out as blank lines are.
    named = parse_lines(kept.withColumn("line", F.when(F.trim("line") == "", F.lit("-")).otherwise(F.col("line"))))
    # A text whose name has no number belongs to no match: it has a row, and nothing is known of it.
    at = {a: F.when((F.col("attribute") == a) & F.col("match_id").isNotNull(), F.col("pos")) for a in ("team", *MATCH_ATTRIBUTES)}
    return _with_reason(
        named.groupBy("match_id").agg(
            F.min_by("value", at["team"]).alias("team1"),
            F.max_by("value", at["team"]).alias("team2"),
            F.count(at["team"]).alias("_teams"),
            *[F.min_by("value", at[a]).alias(a) for a in MATCH_ATTRIBUTES],
        )
    )
