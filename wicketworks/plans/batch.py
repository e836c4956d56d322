"""The whole batch: raw tables to the three filtered tables, one Parquet layer after another.

Each layer is written once and read back, so later steps neither recompute nor depend on the
executors that produced it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from wicketworks.operators.skew import BOUNDED, group_limit
from wicketworks.plans import match_files, merge, season_stats
from wicketworks.sources.checked import read_match_files
from wicketworks.sources.layers import Layer, Watch, write_bucketed, write_layer
from wicketworks.sources.tables import layer_path, read_text_columns

# Raw tables of the statistics pages and the directory of the match files.
RAW_STATS = {
    "batting": "t20_batting_stats.csv",
    "bowling": "t20_bowling_stats.csv",
    "fielding": "t20_fielding_stats.csv",
    "team": "t20_team_stats.csv",
}
MATCH_FILES = "t20s_csv2"
# Files over which the rows of one bucket are dealt where a match is too large for a task.
HOT_FILES = 32


class RawTables(NamedTuple):
    info_lines: DataFrame
    deliveries: DataFrame
    batting: DataFrame
    bowling: DataFrame
    fielding: DataFrame
    team: DataFrame
    rejected: DataFrame | None = None


def read_raw(spark: SparkSession, base: str) -> RawTables:
    """The raw layer below ``base``; lines of match files that are broken are kept apart."""
    files = read_match_files(spark, layer_path(base, "raw", MATCH_FILES))
    stats = {k: read_text_columns(spark, layer_path(base, "raw", name)) for k, name in RAW_STATS.items()}
    return RawTables(files.info_lines, files.deliveries, **stats, rejected=files.rejected)


def process(raw: RawTables, base: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """Write the processed, merged and filtered layers below ``base``; returns the filtered tables.

    Empty raw tables are refused by watches in the passes that write what is made of them. The merged and
    the filtered layers are bucketed by match, so merging, filtering and sampling meet without an exchange.
    """

    def stored(layer: str, table: str, df: DataFrame, guards: Sequence[Watch] = (), keys: Sequence[str] = ()) -> Layer:
        return write_layer(df, layer_path(base, layer, table), guards, keys)

    def bucketed(layer: str, table: str, df: DataFrame, **options) -> Layer:
        return write_bucketed(df, layer_path(base, layer, table), ["match_id"], buckets=buckets, **options)

    def seasons(table: str, make: Callable[..., DataFrame], rows: DataFrame) -> DataFrame:
        watch = Watch(table)
        return stored("processed", table, make(watch.over(rows), check_rows=False, group_rows=_season_groups(rows)), [watch]).frame

    if raw.rejected is not None:
        stored("processed", "rejected_lines", raw.rejected)
    lines = stored("processed", "match_info", raw.info_lines).frame
    matches = stored("processed", "matches", match_files.matches_from_info(lines).accepted).frame
    rosters = match_files.rosters_from_info(lines)
    roster = stored("processed", "match_players", rosters.match_players).frame
    stored("processed", "players", match_files.distinct_players(roster))
    # A match that is too large for a task is dealt over several files of its bucket, and merged as any hot group.
    hot = group_limit(raw.deliveries, ["match_id"], raw.deliveries.count()) < BOUNDED
    watch = Watch("deliveries")
    cleaned = match_files.clean_deliveries(watch.over(raw.deliveries), check_rows=False)
    deliveries = bucketed("processed", "deliveries", cleaned, guards=[watch], spread=HOT_FILES if hot else 1)

    bat = seasons("batting_data", season_stats.batting, raw.batting)
    bowl = seasons("bowling_data", season_stats.bowling, raw.bowling)
    field = seasons("fielding_data", season_stats.fielding, raw.fielding)
    teams = seasons("team_stats", season_stats.teams, raw.team)
    players = stored("processed", "player_stats", season_stats.combine_players(bat, bowl, field)).frame

    ball_rows = merge.ball_by_ball(deliveries.frame, matches, group_rows=deliveries.group_rows, co_located=not hot)
    deal = {"order": ["innings", "ball"], "spread": HOT_FILES if hot else 1, "in_place": not hot}
    balls = bucketed("merged", "ball_by_ball", ball_rows, **deal)
    team_rows = bucketed("merged", "team_stats", merge.match_teams(matches, teams))
    player_rows = bucketed("merged", "players_stats", merge.match_players(roster, players))

    common = merge.common_matches(team_rows.frame, balls.frame, player_rows.frame, co_located=True)
    deals = {"team12_stats": {"in_place": True}, "ball_to_ball": deal, "players_stats": {"in_place": True}}
    return {name: bucketed("filtered", name, table, **deals[name]).frame for name, table in zip(deals, common)}


def _season_groups(rows: DataFrame) -> int | None:
    """Season tables of the pages are small files: counting them tells whether to look for large groups."""
    n = rows.count()
    return season_stats.player_groups(rows, n) if "Player" in rows.columns else group_limit(rows, ["Team"], n)


def run_batch(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Read the raw layer and produce all others."""
    return process(read_raw(spark, base), base)
