"""Deliveries, matches and rosters from the raw match files."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks import schemas
from wicketworks.functions.cleaning import null_to_zero_int, presence_flag
from wicketworks.operators.aggregates import keep_first
from wicketworks.operators.rows import quarantine, require_columns, require_rows
from wicketworks.operators.skew import split_hot, union_parts
from wicketworks.sources.match_info import first_of, wide_matches

# Columns of the narrow form of the cleaned deliveries.
NARROW = [
    "match_id", "season", "innings", "ball", "batting_team", "bowling_team", "runs_off_bat", "extras",
    "wides", "noballs", "byes", "legbyes", "penalty", "wicket_type", "player_dismissed",
    "other_wicket_type", "other_player_dismissed",
]
DISMISSALS = ["wicket_type", "player_dismissed", "other_wicket_type", "other_player_dismissed"]
# Fixed value: players of both sides of a complete match.
ROSTER_SIZE = 22


def clean_deliveries(deliveries: DataFrame, narrow: bool = False, check_rows: bool = True) -> DataFrame:
    """Numeric nulls become 0, text counts become ints, dismissal columns become 0/1 flags."""
    require_columns(deliveries, schemas.DELIVERIES_REQUIRED, "deliveries")
    if check_rows:
        require_rows(deliveries, "deliveries")
    cleaned = deliveries.fillna(0).withColumns(
        {
            **{c: null_to_zero_int(c) for c in ("noballs", "penalty")},
            **{c: presence_flag(c) for c in DISMISSALS},
        }
    )
    return cleaned.select(*NARROW) if narrow else cleaned


class Matches(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def matches_from_info(lines: DataFrame) -> Matches:
    """One row per match; a match without two teams, gender, season or winner is rejected."""
    return Matches(*quarantine(wide_matches(lines)))


class Rosters(NamedTuple):
    match_players: DataFrame
    players: DataFrame
    rejected: DataFrame


def rosters_from_info(lines: DataFrame, by_season: bool = True, group_rows: int | None = None) -> Rosters:
    """Players of each match with their registry ids, from matches with exactly 22 matched players.

    How many pairs a match would give is worked out from counts per (match, player), so
    only accepted matches are ever paired. Ordinary matches: one exchange of the roster lines by match serves counts
    and pairs. Oversized ones are counted with map-side combine and joined. ``by_season`` keeps the first season in
    the list of distinct players; otherwise that list has no season.
    """
    named = lines.where(F.col("attribute").isin("player", "registry") & F.col("player").isNotNull())
    pairs = named.groupBy("match_id", "player").agg((F.count_if(_is("player")) * F.count_if(_is("registry"))).alias("_pairs"))
    sizes = pairs.groupBy("match_id").agg(F.sum("_pairs").alias("_size"))
    checked = (
        lines.select("match_id").distinct()
        .join(sizes, "match_id", "left")
        .join(first_of(lines, ["season"]), "match_id", "left")
        .select("match_id", "season", F.coalesce("_size", F.lit(0)).alias("roster_size"))
    )
    complete = (F.col("roster_size") == ROSTER_SIZE) & F.col("season").isNotNull()

    wanted = lines.where((F.col("attribute").isin("player", "registry") & F.col("player").isNotNull()) | _is("season"))
    season_pos = F.when(_is("season"), F.col("pos"))
    wanted = wanted.where(F.col("match_id").isNotNull()).select(
        "match_id", "attribute", F.when(F.col("attribute") != "season", F.col("player")).alias("player"),
        F.when(_is("registry"), F.col("code")).otherwise(F.col("value")).alias("text"), season_pos.alias("pos"),
    )
    bounded, hot = split_hot(wanted, ["match_id"], group_rows)
    parts = [None if bounded is None else _paired(bounded), None if hot is None else _paired_by_joins(hot)]
    match_players = union_parts(parts)
    players = distinct_players(match_players, by_season)
    return Rosters(match_players, players, checked.where(~complete))


def _is(attribute: str) -> Column:
    return F.col("attribute") == attribute


def _paired(wanted: DataFrame) -> DataFrame:
    """Rosters of matches that fit into a task: the lines of a match meet once, and windows count and pair them."""
    of_player, of_match = W.partitionBy("match_id", "player"), W.partitionBy("match_id")
    counted = wanted.repartition("match_id").withColumns({"_listed": F.count_if(_is("player")).over(of_player), "_coded": F.count_if(_is("registry")).over(of_player)})
    sized = counted.withColumns(
        {
            "_size": F.sum(F.when(_is("player"), F.col("_coded"))).over(of_match),
            "season": F.min_by("text", "pos").over(of_match),
        }
    )
    accepted = (F.col("_size") == ROSTER_SIZE) & F.col("season").isNotNull()
    # A listed player of an accepted match has no more codes than the roster has places.
    codes = F.collect_list(F.when(_is("registry") & accepted & (F.col("_listed") > 0), F.struct(F.col("text").alias("player_id")))).over(of_player)
    paired = sized.withColumn("_codes", codes).where(_is("player") & accepted)
    return paired.select(F.col("text").alias("country"), "player", F.inline("_codes"), "season", "match_id")


def _paired_by_joins(wanted: DataFrame) -> DataFrame:
    """Rosters of any match: counts with map-side combine, then joins of what is accepted."""
    named = wanted.where("attribute <> 'season'")
    pairs = named.groupBy("match_id", "player").agg((F.count_if(_is("player")) * F.count_if(_is("registry"))).alias("_pairs"))
    sizes = pairs.groupBy("match_id").agg(F.sum("_pairs").alias("_size")).where(F.col("_size") == ROSTER_SIZE)
    seasons = first_of(wanted.withColumnRenamed("text", "value"), ["season"]).where("season IS NOT NULL")
    listed = named.where(_is("player")).join(sizes, "match_id").join(seasons, "match_id")
    registry = named.where(_is("registry")).select("match_id", "player", F.col("text").alias("player_id"))
    return (
        listed.select("match_id", "player", F.col("text").alias("country"), "season")
        .join(registry, ["match_id", "player"])
        .select("country", "player", "player_id", "season", "match_id")
    )


def distinct_players(match_players: DataFrame, by_season: bool = True) -> DataFrame:
    """Players with their team and id: with the first season they were listed in, or without season."""
    if by_season:
        keys = ["player", "country", "player_id"]
        return keep_first(match_players, keys, ["season", "match_id"]).drop("match_id")
    return match_players.select("player", "country", "player_id").distinct()
