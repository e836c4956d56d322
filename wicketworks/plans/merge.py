"""Match-keyed feature tables: ball by ball, teams, players, and their common matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.functions.cleaning import (
    binary_code,
    completed_overs,
    null_safe_sum,
    ratio_or_zero,
    required_rate,
    won_by_batting_side,
    won_by_chasing_side,
)
from wicketworks.lookups import TEAM_NAMES
from wicketworks.operators.joins import inner_on, join_roles, restrict_to_common, semi
from wicketworks.operators.rows import complete_groups, replace_values
from wicketworks.operators.skew import split_hot, union_parts
from wicketworks.operators.windows import attach_group, join_group, running_totals
from wicketworks.plans.match_files import ROSTER_SIZE

# The columns added up to the runs of a ball, by variant.
ALL_RUN_COLUMNS = ["runs_off_bat", "extras", "wides", "noballs", "byes", "legbyes", "penalty"]
PLAIN_RUN_COLUMNS = ["runs_off_bat", "extras", "penalty"]
# Column order of the ball table and the team measures.
BALL_COLUMNS = [
    "match_id", "innings", "ball", "runs", "wickets", "curr_score", "curr_wickets", "overs",
    "run_rate", "required_run_rate", "target", "won",
]
TEAM_MEASURES = [
    "Cumulative Won", "Cumulative Lost", "Cumulative Tied", "Cumulative W/L", "Cumulative AveRPW",
    "Cumulative AveRPO",
]

_TOTALS = {"curr_score": "runs", "curr_wickets": "wickets"}


def score_balls(balls: DataFrame, group_rows: int | None = None, co_located: bool = False) -> DataFrame:
    """Running score and wickets per innings, and the first-innings total of the match.

    Matches of ordinary size: one exchange and one sort on match_id serve both windows; no exchange if
    ``co_located``, for balls of a layer bucketed by match.
    Oversized matches: totals over distinct balls with map-side combine, joined back to the rows.
    """
    bounded, hot = split_hot(balls, ["match_id"], group_rows)
    innings = W.partitionBy("match_id", "innings").orderBy("ball").rangeBetween(W.unboundedPreceding, 0)
    scored = (bounded if co_located else bounded.repartition("match_id")).withColumns(
        {name: F.sum(source).over(innings) for name, source in _TOTALS.items()}
    )
    match = W.partitionBy("match_id")
    first_total = F.max(F.when(F.col("innings") == 1, F.col("curr_score")))
    parts = [scored.withColumn("first_total", first_total.over(match))]
    if hot is not None:
        totals = running_totals(hot, ["match_id", "innings"], ["ball"], _TOTALS, group_rows)
        parts.append(join_group(totals, ["match_id"], {"first_total": first_total}))
    return union_parts(parts)


def ball_by_ball(
    deliveries: DataFrame,
    matches: DataFrame,
    run_columns: Sequence[str] = ALL_RUN_COLUMNS,
    label: str = "batting",
    target_bonus: int = 0,
    group_rows: int | None = None,
    co_located: bool = False,
) -> DataFrame:
    """Ball table with running score, rates, target and label.

    ``label`` is "batting" (1 where the side batting on the row wins) or "chasing" (1 on all
    rows of a match won by the side batting second). ``target_bonus`` is added to the
    first-innings total to give the target. ``co_located`` deliveries are bucketed by match.
    """
    balls = deliveries.select(
        "match_id",
        "innings",
        "ball",
        "batting_team",
        "bowling_team",
        null_safe_sum(*run_columns).alias("runs"),
        null_safe_sum("player_dismissed", "other_player_dismissed").alias("wickets"),
    )
    scored = inner_on(score_balls(balls, group_rows, co_located), matches.select("match_id", "winner"), "match_id")
    won = (
        won_by_batting_side("batting_team", "winner")
        if label == "batting"
        else won_by_chasing_side("batting_team", "bowling_team", "winner", "innings")
    )
    target = F.when(F.col("innings") == 1, F.lit(0)).otherwise(F.col("first_total") + target_bonus)
    return (
        scored.withColumns({"won": won, "overs": completed_overs("ball"), "target": target})
        .withColumns(
            {
                "run_rate": ratio_or_zero("curr_score", "overs"),
                "required_run_rate": required_rate("target", "curr_score", "overs", "innings"),
            }
        )
        .select(*BALL_COLUMNS)
    )


def match_teams(
    matches: DataFrame, teams: DataFrame, map_before_filter: bool = False, winners: DataFrame | None = None
) -> DataFrame:
    """One row per match: gender code and the earlier results of both sides.

    Only teams named alike on both sides take part: present in the statistics and winner of
    some match. With ``map_before_filter`` short names are mapped first, so they can match.
    ``winners`` has the winner of every match where ``matches`` are only some of them.
    """
    named = ["team1", "team2", "winner"]

    def mapped() -> tuple[DataFrame, DataFrame]:
        return replace_values(matches, TEAM_NAMES, named), replace_values(teams, TEAM_NAMES, ["Team"])

    won = matches if winners is None else winners
    if map_before_filter:
        matches, teams = mapped()
        won = replace_values(won, TEAM_NAMES, ["winner"])
    winners = won.where(F.col("winner").isNotNull()).select(F.col("winner").alias("Team")).distinct()
    teams = semi(teams, winners, "Team")
    # Matches with any other team drop out in the joins below.
    if not map_before_filter:
        matches, teams = mapped()
    joined = join_roles(matches, teams, ["team1", "team2"], "season", "Team", "Season", TEAM_MEASURES)
    return joined.select(
        "match_id",
        binary_code("gender", "male").alias("gender"),
        *[F.col(f"`{m} {role}`") for role in ("team1", "team2") for m in TEAM_MEASURES],
    )


def match_players(roster: DataFrame, player_stats: DataFrame, require_full_roster: bool = False) -> DataFrame:
    """Measures of every rostered player of a match known before its season.

    ``require_full_roster`` keeps only matches for which all 22 players have statistics.
    """
    keyed = roster.select(
        "match_id",
        F.col("player").alias("Player"),
        F.col("country").alias("Country"),
        F.col("season").alias("Season"),
    )
    measures = [c for c in player_stats.columns if c not in ("Player", "Country", "Season")]
    joined = inner_on(keyed, player_stats, ["Player", "Country", "Season"])
    rows = joined.select("match_id", *[F.col(f"`{m}`") for m in measures])
    return complete_groups(rows, ["match_id"], ROSTER_SIZE) if require_full_roster else rows


def common_matches(
    teams: DataFrame,
    balls: DataFrame,
    players: DataFrame,
    with_overs: bool = True,
    materialize_keys: bool = False,
    co_located: bool = False,
) -> list[DataFrame]:
    """The three tables limited to the matches all of them have; ``co_located`` ones are bucketed by match."""
    columns = [c for c in BALL_COLUMNS if with_overs or c != "overs"]
    return restrict_to_common([teams, balls.select(*columns), players], "match_id", materialize_keys, co_located)


def chase_target(
    balls: DataFrame, score: str = "curr_score", bonus: int = 0, group_rows: int | None = None
) -> DataFrame:
    """The target alone: 0 in the first innings, then the first-innings total (plus ``bonus``)."""
    first_total = F.max(F.when(F.col("innings") == 1, F.col(score)))
    attached = attach_group(balls, ["match_id"], {"_first": first_total}, group_rows)
    target = F.when(F.col("innings") == 1, F.lit(0)).otherwise(F.col("_first") + bonus)
    return attached.withColumn("target", target).drop("_first")
