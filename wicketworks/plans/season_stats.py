"""Leak-free season statistics of players and teams: everything known before a season."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketworks import schemas
from wicketworks.functions.cleaning import dash_to_ratio, dash_to_zero, ratio_or_numerator, to_number
from wicketworks.functions.text import label_country, label_id, label_name
from wicketworks.lookups import COUNTRY_CODES
from wicketworks.operators.joins import chain_inner, inner_on
from wicketworks.operators.rows import require_columns, require_rows
from wicketworks.operators.skew import group_limit
from wicketworks.operators.windows import Ratio, Weighted, exclusive_cumulative

KEYS = ["Player", "Country", "Season"]


def _checked(df: DataFrame, required: list[str], what: str, check_rows: bool) -> DataFrame:
    require_columns(df, required, what)
    if check_rows:
        require_rows(df, what)
    return df


def _cumulative(df, sums, means=None, ratios=None, codes=None, group_rows=None) -> DataFrame:
    """Split the player label, accumulate over earlier seasons, name the country.

    Rows with an unknown code are removed before the window: the code is part of its key, so no
    result changes, and labels without a country are never shuffled. The name replaces the code
    only afterwards, because two codes can stand for one country.
    """
    labelled = df.withColumns(
        {"Country": label_country("Player"), "player_id": label_id("Player"), "Player": label_name("Player")}
    )
    name = "Country"
    if codes is not None:
        named = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
        labelled = labelled.withColumn("_name", F.try_element_at(named, F.col("Country"))).where(F.col("_name").isNotNull())
        name = "_name"
    measured = [*sums.values(), *(m.value for m in (means or {}).values())]
    tiebreak = ["player_id", *dict.fromkeys(measured)]
    result = exclusive_cumulative(
        labelled, ["Player", "Country"], ["Season", *tiebreak], sums, means, ratios, group_rows=group_rows
    )
    measures = [*sums, *(means or {}), *(ratios or {})]
    return result.select("Player", F.col(name).alias("Country"), "Season", *[F.col(f"`{m}`") for m in measures])


def batting(
    raw: DataFrame,
    codes: dict[str, str] | None = COUNTRY_CODES,
    fill_all: bool = False,
    check_rows: bool = True,
    group_rows: int | None = None,
) -> DataFrame:
    """Cumulative matches, innings, runs, and innings-weighted average and strike rate.

    ``fill_all`` replaces every numeric null by 0, not only a missing average.
    """
    _checked(raw, schemas.BATTING_REQUIRED, "batting", check_rows)
    runs, inns = dash_to_zero("Runs", "int"), dash_to_zero("Inns", "int")
    cleaned = raw.select(
        "Player",
        "Season",
        to_number("Mat", "int").alias("Mat"),
        inns.alias("Inns"),
        runs.alias("Runs"),
        dash_to_zero("SR").alias("SR"),
        F.coalesce(dash_to_ratio("Ave", runs, inns), F.lit(0.0)).alias("Ave"),
    )
    return _cumulative(
        cleaned.fillna(0) if fill_all else cleaned,
        sums={"Cum Mat Total": "Mat", "Cum Inns Total": "Inns", "Cum Runs Total": "Runs"},
        means={"Cum Batting Ave": Weighted("Ave", "Inns"), "Cum SR": Weighted("SR", "Inns")},
        codes=codes,
        group_rows=group_rows,
    )


def bowling(
    raw: DataFrame,
    codes: dict[str, str] | None = COUNTRY_CODES,
    maidens: bool = False,
    check_rows: bool = True,
    group_rows: int | None = None,
) -> DataFrame:
    """Cumulative matches, innings, overs, runs, wickets and innings-weighted economy.

    Overs such as 3.4 are added as plain decimals. ``maidens`` keeps that column as well.
    """
    counted = ["Inns", "Overs", *(["Mdns"] if maidens else []), "Runs", "Wkts"]
    _checked(raw, schemas.BOWLING_REQUIRED + (["Mdns"] if maidens else []), "bowling", check_rows)
    cleaned = raw.select(
        "Player",
        "Season",
        to_number("Mat", "int").alias("Mat"),
        *[dash_to_zero(c).alias(c) for c in counted],
        dash_to_ratio("Econ", dash_to_zero("Runs"), dash_to_zero("Inns")).alias("Econ"),
    ).fillna(0)
    return _cumulative(
        cleaned,
        sums={f"Cumulative {c}": c for c in ["Mat", *counted]},
        means={"Cumulative Econ": Weighted("Econ", "Inns")},
        codes=codes,
        group_rows=group_rows,
    )


def fielding(
    raw: DataFrame,
    codes: dict[str, str] | None = COUNTRY_CODES,
    check_rows: bool = True,
    group_rows: int | None = None,
) -> DataFrame:
    """Cumulative matches, innings, dismissals, catches, stumpings and dismissals per innings."""
    _checked(raw, schemas.FIELDING_REQUIRED, "fielding", check_rows)
    counted = ["Inns", "Dis", "Ct", "St"]
    cleaned = raw.select(
        "Player", "Season", to_number("Mat", "int").alias("Mat"), *[dash_to_zero(c).alias(c) for c in counted]
    ).fillna(0)
    return _cumulative(
        cleaned,
        sums={f"Cumulative {c}": c for c in ["Mat", *counted]},
        ratios={"Cumulative D/I": Ratio("Dis", "Inns")},
        codes=codes,
        group_rows=group_rows,
    )


def team_seasons(raw: DataFrame) -> DataFrame:
    """Season rows of teams with win/loss ratio and numeric averages."""
    return raw.select(
        "Team",
        "Season",
        *[to_number(c, "int").alias(c) for c in ("Mat", "Won", "Lost", "Tied", "NR")],
        dash_to_zero("Ave").alias("AveRPW"),
        dash_to_zero("RPO").alias("AveRPO"),
    ).withColumn("W/L", ratio_or_numerator("Won", "Lost"))


def teams(
    raw: DataFrame, no_result: bool = False, check_rows: bool = True, group_rows: int | None = None
) -> DataFrame:
    """Cumulative results of teams; runs per wicket count only after a win, runs per over after a loss."""
    _checked(raw, schemas.TEAM_REQUIRED, "team", check_rows)
    counted = ["Won", "Lost", "Tied", *(["NR"] if no_result else [])]
    seasons = team_seasons(raw)
    sums = {f"Cumulative {c}": c for c in counted}
    ratios = {"Cumulative W/L": Ratio("Won", "Lost")}
    means = {
        "Cumulative AveRPW": Weighted("AveRPW", "Mat", gate="Won"),
        "Cumulative AveRPO": Weighted("AveRPO", "Mat", gate="Lost"),
    }
    order = ["Season", "Mat", "Won", "Lost", "Tied", "NR"]
    result = exclusive_cumulative(seasons, ["Team"], order, sums, means, ratios, group_rows=group_rows)
    return result.select("Team", "Season", *sums, *ratios, *means)


def player_groups(raw: DataFrame, rows: int | None = None, group_rows: int | None = None) -> int:
    """What batting, bowling and fielding over the stored ``raw`` take as ``group_rows``: one look for all three."""
    keyed = raw.select(label_name("Player").alias("_name"), label_country("Player").alias("_country"))
    return group_limit(keyed, ["_name", "_country"], rows, group_rows)


def combine_players(bat: DataFrame, bowl: DataFrame, field: DataFrame) -> DataFrame:
    """One row per player and season with the 11 measures of all three disciplines."""
    renamed = bowl.withColumnRenamed("Cumulative Runs", "Cumulative Bowling Runs")
    joined = chain_inner(
        [
            bat.select(*KEYS, "Cum Mat Total", "Cum Runs Total", "Cum SR"),
            renamed.drop("Cumulative Mdns"),
            field,
        ],
        KEYS,
        drop=["Cumulative Mat", "Cumulative Inns"],
    )
    return joined.select(*KEYS, *PLAYER_MEASURES)


# Order of the player measures.
PLAYER_MEASURES = [
    "Cum Mat Total", "Cum Runs Total", "Cum SR", "Cumulative Overs", "Cumulative Bowling Runs",
    "Cumulative Wkts", "Cumulative Econ", "Cumulative Dis", "Cumulative Ct", "Cumulative St",
    "Cumulative D/I",
]


def combine_rostered(bat: DataFrame, bowl: DataFrame, field: DataFrame, match_players: DataFrame) -> DataFrame:
    """The variant that keeps only rostered player seasons, once per player id, with maidens.

    The roster is reduced to distinct player seasons before joining, so the rows are not
    multiplied by the matches of a season and need no de-duplication afterwards.
    """
    roster = match_players.select(
        F.col("player").alias("Player"), F.col("country").alias("Country"), F.col("season").alias("Season"), "player_id"
    ).distinct()
    stats = chain_inner(
        [
            bat.select(*KEYS, "Cum Mat Total", "Cum Runs Total", "Cum SR"),
            bowl.withColumnRenamed("Cumulative Runs", "Cumulative Bowling Runs"),
            field,
        ],
        KEYS,
        drop=["Cumulative Mat", "Cumulative Inns"],
    )
    return inner_on(stats, roster, KEYS).drop("player_id")


def rostered(stats: DataFrame, match_players: DataFrame) -> DataFrame:
    """Statistics of rostered players with their id, one row per match the player was listed for."""
    roster = match_players.select(
        "player_id",
        F.col("player").alias("Player"),
        F.col("country").alias("Country"),
        F.col("season").alias("Season"),
    )
    measures = [c for c in stats.columns if c not in KEYS]
    return inner_on(stats, roster, KEYS).select("player_id", *KEYS, *[F.col(f"`{m}`") for m in measures])
