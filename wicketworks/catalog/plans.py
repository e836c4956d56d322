"""Composite plans with their variants."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from wicketworks import schemas
from wicketworks.catalog import proxies as P
from wicketworks.catalog.modeling import _COUNTS, _SCORES, _round8, _staged_sql, fit_groups, grouped_orders, grouped_sql
from wicketworks.catalog.registry import query, rounded
from wicketworks.catalog.sources import customer_archives, info_texts, split_sql
from wicketworks.lookups import TEAM_NAMES
from wicketworks.operators import metrics, samples
from wicketworks.operators.modeling import load_model, save_model, score
from wicketworks.operators.skew import BOUNDED
from wicketworks.plans import batch, landing, match_files, merge, modeling, season_stats
from wicketworks.session import materialize, scratch_path
from wicketworks.sources.layers import Watch, store, write_bucketed
from wicketworks.sources.match_info import split_text

_DELIVERIES = f"({P.DELIVERIES})"
# Any short name that stands for a long one.
SHORT_NAME, LONG_NAME = next((k, v) for k, v in TEAM_NAMES.items() if k != v and "'" not in k + v)
_MATCHES = f"({P.MATCHES})"
_COUNT_COLUMNS = ["runs_off_bat", "extras", "wides", "byes", "legbyes"]


def clean_sql(columns):
    shown = []
    for c in columns:
        if c in _COUNT_COLUMNS:
            shown.append(f"coalesce({c}, 0) AS {c}")
        elif c in ("noballs", "penalty"):
            shown.append(f"CAST(coalesce({c}, '0') AS INTEGER) AS {c}")
        elif c in match_files.DISMISSALS:
            shown.append(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END AS {c}")
        else:
            shown.append(c)
    return f"SELECT {', '.join(shown)} FROM {_DELIVERIES} AS d"


_ALL = [field.split()[0] for field in schemas.DELIVERIES.split(", ")]


def cleaned(t, narrow=False):
    return match_files.clean_deliveries(t.sql(P.DELIVERIES), narrow=narrow)


@query("c01_clean_deliveries", clean_sql(_ALL))
def _(t):
    return cleaned(t)


@query("c01_clean_deliveries_narrow", clean_sql(match_files.NARROW))
def _(t):
    return cleaned(t, narrow=True)


_OPEN = f"({P.OPEN_MATCHES}) AS m"


def _lines(t):
    """Parsed info lines as a stored table, as the batch leaves them."""
    return materialize(split_text(info_texts(t)), "match_info")

_ACCEPTED = f"SELECT match_id, team1, team2, gender, season, winner FROM {_OPEN} WHERE winner IS NOT NULL"


@query("c02_matches", _ACCEPTED)
def _(t):
    return match_files.matches_from_info(_lines(t)).accepted


@query("c02_matches_rejected", f"SELECT match_id, 'winner' AS reject_reason FROM {_OPEN} WHERE winner IS NULL")
def _(t):
    return match_files.matches_from_info(_lines(t)).rejected.select("match_id", "reject_reason")


@query("c03_match_players", f"SELECT country, player, player_id, season, match_id FROM ({P.INFO_ROSTER}) AS r")
def _(t):
    return match_files.rosters_from_info(_lines(t)).match_players


@query(
    "c03_players_first_season",
    f"SELECT country, player, player_id, min(season) AS season FROM ({P.INFO_ROSTER}) AS r GROUP BY country, player, player_id",
)
def _(t):
    return match_files.rosters_from_info(_lines(t)).players


@query("c03_players_without_season", f"SELECT DISTINCT player, country, player_id FROM ({P.INFO_ROSTER}) AS r")
def _(t):
    return match_files.rosters_from_info(_lines(t), by_season=False).players


@query("c03_rosters_rejected", "SELECT o_orderkey AS match_id, 21 AS roster_size FROM {orders} WHERE o_custkey % 9 = 0")
def _(t):
    rejected = match_files.rosters_from_info(_lines(t)).rejected
    return rejected.select("match_id", F.col("roster_size").cast("int").alias("roster_size"))


def _zero(column, kind):
    return f"CASE WHEN \"{column}\" = '-' THEN CAST(0 AS {kind}) ELSE CAST(\"{column}\" AS {kind}) END"


def _or_ratio(column):
    runs, inns = _zero("Runs", "DOUBLE"), _zero("Inns", "DOUBLE")
    return (
        f"CASE WHEN \"{column}\" = '-' THEN coalesce({runs} / nullif({inns}, 0), 0) ELSE CAST(\"{column}\" AS DOUBLE) END"
    )


def cumulative_sql(raw, columns, sums, means=None, ratios=None):
    """``columns``: name to SQL; ``sums``: result to column; ``means``: result to (value, weight)."""
    means, ratios = means or {}, ratios or {}
    tie = list(dict.fromkeys([*sums.values(), *(v for v, _ in means.values())]))
    over = "OVER (PARTITION BY player, code ORDER BY season, pid, " + ", ".join(f'"{c}"' for c in tie)
    over += " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

    def ratio(a, b):
        value = rounded(f"CAST(sum({a}) {over} AS DOUBLE) / nullif(CAST(sum({b}) {over} AS DOUBLE), 0)")
        return f"CASE WHEN coalesce(sum({b}) {over}, 0) = 0 THEN CAST(0 AS DOUBLE) ELSE {value} END"

    kind = {c: ("BIGINT" if "AS INTEGER" in e and "DOUBLE" not in e else "DOUBLE") for c, e in columns.items()}
    shown = [f'CAST(coalesce(sum("{c}") {over}, 0) AS {kind[c]}) AS "{n}"' for n, c in sums.items()]
    shown += [ratio(f'"{v}" * "{w}"', f'"{w}"') + f' AS "{n}"' for n, (v, w) in means.items()]
    shown += [ratio(f'"{a}"', f'"{b}"') + f' AS "{n}"' for n, (a, b) in ratios.items()]
    inner = ", ".join(f'{e} AS "{c}"' for c, e in columns.items())
    return f"""SELECT player AS "Player", country_name AS "Country", season AS "Season", {', '.join(shown)}
        FROM (SELECT regexp_extract("Player", '^(.*?)\\s\\(', 1) AS player, "Season" AS season,
                     regexp_extract("Player", '\\((.*?)\\)', 1) AS code, regexp_extract("Player", '\\[(.*?)\\]', 1) AS pid,
                     {inner} FROM ({raw}) AS r) AS q JOIN {P.KNOWN_CODES_SQL} USING (code)"""


def _mat():
    return {"Mat": 'CAST("Mat" AS INTEGER)'}


def _doubles(*names):
    return {n: _zero(n, "DOUBLE") for n in names}


BAT_SQL = cumulative_sql(
    P.PLAYER_SEASONS,
    {**_mat(), "Inns": _zero("Inns", "INTEGER"), "Runs": _zero("Runs", "INTEGER"), "SR": _zero("SR", "DOUBLE"), "Ave": _or_ratio("Ave")},
    {"Cum Mat Total": "Mat", "Cum Inns Total": "Inns", "Cum Runs Total": "Runs"},
    {"Cum Batting Ave": ("Ave", "Inns"), "Cum SR": ("SR", "Inns")},
)


def bowl_sql(maidens=False):
    counted = ["Inns", "Overs", *(["Mdns"] if maidens else []), "Runs", "Wkts"]
    return cumulative_sql(
        P.PLAYER_SEASONS,
        {**_mat(), **_doubles(*counted), "Econ": _or_ratio("Econ")},
        {f"Cumulative {c}": c for c in ["Mat", *counted]},
        {"Cumulative Econ": ("Econ", "Inns")},
    )


FIELD_SQL = cumulative_sql(
    P.PLAYER_SEASONS,
    {**_mat(), **_doubles("Inns", "Dis", "Ct", "St")},
    {f"Cumulative {c}": c for c in ["Mat", "Inns", "Dis", "Ct", "St"]},
    ratios={"Cumulative D/I": ("Dis", "Inns")},
)


def _seasons(t):
    return t.sql(P.PLAYER_SEASONS)


def _bat(t, **options):
    return season_stats.batting(_seasons(t), **options)


def _bowl(t, **options):
    return season_stats.bowling(_seasons(t), **options)


@query("c04_batting", BAT_SQL)
def _(t):
    return _bat(t)


# Every third match count is missing, so that a sum over missing ones alone tells the variants apart.
_GAPS = f"""SELECT "Player", "Season", CASE WHEN "Mat" % 3 <> 0 THEN "Mat" END AS "Mat", "Inns", "Runs", "SR", "Ave" FROM ({P.PLAYER_SEASONS}) AS full_rows"""
_FILLED = BAT_SQL.replace(f"({P.PLAYER_SEASONS})", "(" + _GAPS.replace("END AS", "ELSE 0 END AS", 1) + ")")
_KEPT = re.sub(
    r'coalesce\(sum\("Mat"\) (OVER \([^)]*\)), 0\)', r'CASE WHEN count(*) \1 = 0 THEN 0 ELSE sum("Mat") \1 END',
    BAT_SQL.replace(f"({P.PLAYER_SEASONS})", f"({_GAPS})"),
).replace('pid, "Mat"', 'pid, "Mat" NULLS FIRST')


@query("c04_batting_all_nulls_filled", _FILLED)
def _(t):
    return season_stats.batting(t.sql(_GAPS), fill_all=True)


@query("c04_batting_nulls_kept", _KEPT)
def _(t):
    return season_stats.batting(t.sql(_GAPS))


_ROSTERED = """SELECT r.player_id, b."Player", b."Country", b."Season", b."Cum Mat Total", b."Cum Runs Total", b."Cum SR"
    FROM ({bat}) AS b JOIN ({roster}) AS r
    ON b."Player" = r.player AND b."Country" = r.country AND b."Season" = r.season"""


@query("c04_batting_of_rosters", _ROSTERED.replace("{bat}", BAT_SQL).replace("{roster}", P.ROSTER))
def _(t):
    stats = _bat(t, fill_all=True).select("Player", "Country", "Season", "Cum Mat Total", "Cum Runs Total", "Cum SR")
    return season_stats.rostered(stats, t.sql(P.ROSTER))


@query("c05_bowling", bowl_sql())
def _(t):
    return _bowl(t)


@query("c05_bowling_with_maidens", bowl_sql(maidens=True))
def _(t):
    return _bowl(t, maidens=True)


@query("c06_fielding", FIELD_SQL)
def _(t):
    return season_stats.fielding(_seasons(t))


def teams_sql(no_result=False):
    over = (
        'OVER (PARTITION BY "Team" ORDER BY "Season", "Mat", "Won", "Lost", "Tied", "NR" '
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )

    def gated(a, b, gate):
        value = rounded(f"CAST(sum({a}) {over} AS DOUBLE) / nullif(CAST(sum({b}) {over} AS DOUBLE), 0)")
        return f"CASE WHEN coalesce(sum({gate}) {over}, 0) = 0 THEN CAST(0 AS DOUBLE) ELSE {value} END"

    counted = ["Won", "Lost", "Tied", *(["NR"] if no_result else [])]
    shown = [f'CAST(coalesce(sum("{c}") {over}, 0) AS BIGINT) AS "Cumulative {c}"' for c in counted]
    shown.append(gated('"Won"', '"Lost"', '"Lost"') + ' AS "Cumulative W/L"')
    shown.append(gated(f'{_zero("Ave", "DOUBLE")} * "Mat"', '"Mat"', '"Won"') + ' AS "Cumulative AveRPW"')
    shown.append(gated(f'{_zero("RPO", "DOUBLE")} * "Mat"', '"Mat"', '"Lost"') + ' AS "Cumulative AveRPO"')
    return f'SELECT "Team", "Season", {", ".join(shown)} FROM ({P.TEAM_SEASONS}) AS s'


@query("c07_teams", teams_sql())
def _(t):
    return season_stats.teams(t.sql(P.TEAM_SEASONS))


@query("c07_teams_with_no_result", teams_sql(no_result=True))
def _(t):
    return season_stats.teams(t.sql(P.TEAM_SEASONS), no_result=True)


_ON_KEYS = 'ON {a}."Player" = {b}."Player" AND {a}."Country" = {b}."Country" AND {a}."Season" = {b}."Season"'


def combined_sql(maidens=False):
    overs = 'w."Cumulative Overs"' + (', w."Cumulative Mdns"' if maidens else "")
    return f"""SELECT b."Player", b."Country", b."Season", b."Cum Mat Total", b."Cum Runs Total", b."Cum SR", {overs},
        w."Cumulative Runs" AS "Cumulative Bowling Runs", w."Cumulative Wkts", w."Cumulative Econ", f."Cumulative Dis",
        f."Cumulative Ct", f."Cumulative St", f."Cumulative D/I"
        FROM ({BAT_SQL}) AS b JOIN ({bowl_sql(maidens)}) AS w {_ON_KEYS.format(a='b', b='w')}
        JOIN ({FIELD_SQL}) AS f {_ON_KEYS.format(a='b', b='f')}"""


def _stored_seasons(t):
    """The season rows of the players, stored once for all three disciplines, and the size of their groups."""
    watch = Watch("player seasons")
    layer = store(watch.over(_seasons(t)), "player-seasons", [watch])
    return layer.frame, {"check_rows": False, "group_rows": season_stats.player_groups(layer.frame, layer.rows)}


def _players(t):
    raw, known = _stored_seasons(t)
    return season_stats.combine_players(
        season_stats.batting(raw, **known), season_stats.bowling(raw, **known), season_stats.fielding(raw, **known)
    )


@query("c08_player_stats", combined_sql())
def _(t):
    return _players(t)


@query(
    "c08_player_stats_of_rosters",
    f"""SELECT p.* FROM ({combined_sql(maidens=True)}) AS p
        JOIN (SELECT DISTINCT player, country, season, player_id FROM ({P.ROSTER}) AS r0) AS r
        ON p."Player" = r.player AND p."Country" = r.country AND p."Season" = r.season""",
)
def _(t):
    raw, known = _stored_seasons(t)
    bowl = season_stats.bowling(raw, maidens=True, **known)
    bat, field = season_stats.batting(raw, **known), season_stats.fielding(raw, **known)
    return season_stats.combine_rostered(bat, bowl, field, t.sql(P.ROSTER))


def balls_sql(matches=_MATCHES, run_columns=merge.ALL_RUN_COLUMNS, label="batting", bonus=0):
    runs = " + ".join(run_columns)
    won = (
        "d.batting_team = m.winner"
        if label == "batting"
        else "(d.batting_team = m.winner AND innings = 2) OR (d.bowling_team = m.winner AND innings = 1)"
    )
    peers = "OVER (PARTITION BY match_id, innings ORDER BY ball RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""SELECT match_id, innings, ball, runs, wickets, curr_score, curr_wickets, overs,
        CASE WHEN overs <> 0 THEN round(CAST(curr_score AS DOUBLE) / overs, 6) ELSE CAST(0 AS DOUBLE) END AS run_rate,
        CASE WHEN innings = 1 THEN CAST(0 AS DOUBLE)
             ELSE round(CAST(target - curr_score AS DOUBLE) / nullif(20 - overs, 0), 6) END AS required_run_rate, target, won
        FROM (SELECT match_id, innings, ball, runs, wickets, curr_score, curr_wickets, CAST(floor(ball) AS INTEGER) AS overs,
                     CASE WHEN innings = 1 THEN CAST(0 AS BIGINT) ELSE CAST(max(CASE WHEN innings = 1 THEN curr_score END)
                          OVER (PARTITION BY match_id) + {bonus} AS BIGINT) END AS target, won
              FROM (SELECT match_id, innings, ball, runs, wickets, won, CAST(sum(runs) {peers} AS BIGINT) AS curr_score,
                           CAST(sum(wickets) {peers} AS BIGINT) AS curr_wickets
                    FROM (SELECT d.match_id, innings, ball, {runs} AS runs, player_dismissed + other_player_dismissed AS wickets,
                                 CASE WHEN {won} THEN 1 ELSE 0 END AS won
                          FROM ({clean_sql(match_files.NARROW)}) AS d JOIN {matches} AS m ON d.match_id = m.match_id) AS r
              ) AS s) AS u"""


def _rates(df):
    return df.withColumns({c: F.round(c, 6) for c in ("run_rate", "required_run_rate")})


def _balls(t, **options):
    return merge.ball_by_ball(cleaned(t), t.sql(P.MATCHES), **options)


@query("c09_ball_by_ball", balls_sql())
def _(t):
    return _rates(_balls(t))


@query(
    "c09_ball_by_ball_chasing_variant",
    balls_sql(run_columns=merge.PLAIN_RUN_COLUMNS, label="chasing", bonus=1),
)
def _(t):
    return _rates(_balls(t, run_columns=merge.PLAIN_RUN_COLUMNS, label="chasing", target_bonus=1))


def match_teams_sql(matches=_MATCHES):
    sides = [
        f'{alias}."{m}" AS "{m} {role}"' for alias, role in (("a", "team1"), ("b", "team2")) for m in merge.TEAM_MEASURES
    ]
    return f"""WITH teams AS (SELECT * FROM ({teams_sql()}) AS s WHERE "Team" IN (SELECT winner FROM {matches} AS w))
        SELECT m.match_id, CASE WHEN gender = 'male' THEN 0 ELSE 1 END AS gender, {', '.join(sides)}
        FROM {matches} AS m JOIN teams AS a ON m.team1 = a."Team" AND m.season = a."Season"
        JOIN teams AS b ON m.team2 = b."Team" AND m.season = b."Season" """


def _match_teams(t, **options):
    return merge.match_teams(t.sql(P.MATCHES), season_stats.teams(t.sql(P.TEAM_SEASONS)), **options)


@query("c10_match_teams", match_teams_sql())
def _(t):
    return _match_teams(t)


# One team bears its long name in the statistics and its short one in the matches, so only mapping first keeps its matches.
_LONG = "CASE WHEN {c} = 'TEAM_7' THEN '" + LONG_NAME + "' ELSE {c} END"
_SHORT = "CASE WHEN {c} = 'TEAM_7' THEN '" + SHORT_NAME + "' ELSE {c} END"
_NAMED_SEASONS = f"""SELECT {_LONG.format(c='"Team"')} AS "Team", "Season", "Mat", "Won", "Lost", "Tied", "NR", "Ave", "RPO" FROM ({P.TEAM_SEASONS}) AS s0"""
_SIDES = ("team1", "team2", "winner")
_NAMED_MATCHES = f"SELECT match_id, gender, season, {', '.join(f'{_SHORT.format(c=c)} AS {c}' for c in _SIDES)} FROM {_MATCHES} AS m0"
_MAPPED_MATCHES = f"(SELECT match_id, gender, season, {', '.join(f'{_LONG.format(c=c)} AS {c}' for c in _SIDES)} FROM {_MATCHES} AS m0)"


def _named_teams(t, **options):
    return merge.match_teams(t.sql(_NAMED_MATCHES), season_stats.teams(t.sql(_NAMED_SEASONS)), **options)


@query("c10_match_teams_mapped_first", match_teams_sql(_MAPPED_MATCHES).replace(P.TEAM_SEASONS, _NAMED_SEASONS))
def _(t):
    return _named_teams(t, map_before_filter=True)


@query(
    "c10_match_teams_mapped_last",
    match_teams_sql(_MAPPED_MATCHES).replace(P.TEAM_SEASONS, f"SELECT * FROM ({_NAMED_SEASONS}) AS n WHERE \"Team\" <> '{LONG_NAME}'"),
)
def _(t):
    return _named_teams(t)


_MEASURES = ", ".join(f'p."{m}"' for m in season_stats.PLAYER_MEASURES)


def match_players_sql(roster=P.ROSTER):
    return f"""SELECT r.match_id, {_MEASURES} FROM ({roster}) AS r JOIN ({combined_sql()}) AS p
        ON r.player = p."Player" AND r.country = p."Country" AND r.season = p."Season" """


@query("c11_match_players", match_players_sql())
def _(t):
    return merge.match_players(t.sql(P.ROSTER), _players(t))


@query(
    "c11_match_players_full_roster",
    f"""SELECT * FROM ({match_players_sql(P.INFO_ROSTER)}) AS q WHERE match_id IN (
        SELECT match_id FROM ({match_players_sql(P.INFO_ROSTER)}) AS k GROUP BY match_id HAVING count(*) = 22)""",
)
def _(t):
    roster = match_files.rosters_from_info(_lines(t)).match_players
    return merge.match_players(roster, _players(t), require_full_roster=True)


_KEYS3 = f"""SELECT match_id FROM ({match_teams_sql()}) AS a INTERSECT SELECT match_id FROM ({balls_sql()}) AS b
    INTERSECT SELECT match_id FROM ({match_players_sql()}) AS c"""


def _merged(t):
    """The merged layer as the batch leaves it: teams, balls, players, bucketed by match."""
    seen = Watch("team seasons")
    seasons = store(seen.over(t.sql(P.TEAM_SEASONS)), "team-seasons", [seen], ["Team"])
    teams = season_stats.teams(seasons.frame, check_rows=False, group_rows=seasons.group_rows)
    players = merge.match_players(t.sql(P.ROSTER), _players(t))

    def bucketed(df, name, **options):
        return write_bucketed(df, scratch_path(t.spark, name), ["match_id"], **options)

    watch = Watch("deliveries")
    cleaned_balls = match_files.clean_deliveries(watch.over(t.sql(P.DELIVERIES)), narrow=True, check_rows=False)
    deliveries = bucketed(cleaned_balls, "deliveries", guards=[watch])
    near = deliveries.group_rows >= BOUNDED
    balls = merge.ball_by_ball(deliveries.frame, t.sql(P.MATCHES), group_rows=deliveries.group_rows, co_located=near)
    return [
        bucketed(merge.match_teams(t.sql(P.MATCHES), teams), "team_stats"),
        bucketed(balls, "ball_by_ball", order=["innings", "ball"], in_place=near),
        bucketed(players, "players_stats"),
    ]


def _common(t, **options):
    """Keys and rows come from the stored layer: three scans that meet where they lie."""
    return merge.common_matches(*[layer.frame for layer in _merged(t)], co_located=True, **options)


@query("c12_common_team_rows", f"SELECT * FROM ({match_teams_sql()}) AS q WHERE match_id IN ({_KEYS3})")
def _(t):
    return _common(t)[0]


@query("c12_common_balls", f"SELECT * FROM ({balls_sql()}) AS q WHERE match_id IN ({_KEYS3})")
def _(t):
    return _rates(_common(t)[1])


@query("c12_common_balls_without_overs", f"SELECT * EXCLUDE (overs) FROM ({balls_sql()}) AS q WHERE match_id IN ({_KEYS3})")
def _(t):
    return _rates(_common(t, with_overs=False)[1])


@query("c12_common_players", f"SELECT * FROM ({match_players_sql()}) AS q WHERE match_id IN ({_KEYS3})")
def _(t):
    return _common(t)[2]


def samples_sql(drop):
    order = "ORDER BY innings, ball, runs, wickets"
    return f"""SELECT match_id, label, n_balls, score, n_players, {split_sql('match_id')} AS split
        FROM (SELECT match_id, max(CASE WHEN pos = 1 THEN won END) AS label, greatest(max(total) - {drop}, 0) AS n_balls,
                     CAST(sum(CASE WHEN pos <= total - {drop} THEN runs ELSE 0 END) AS BIGINT) AS score
              FROM (SELECT *, row_number() OVER (PARTITION BY match_id {order}) AS pos,
                           count(*) OVER (PARTITION BY match_id) AS total FROM ({balls_sql()}) AS b0) AS b
              GROUP BY match_id) AS balls
        JOIN (SELECT match_id, count(*) AS n_players FROM ({match_players_sql()}) AS p0 GROUP BY match_id) AS p USING (match_id)
        WHERE match_id IN (SELECT match_id FROM ({match_teams_sql()}) AS t0)"""


def _samples(t, **options):
    teams, balls, players = _merged(t)
    limit = min(balls.group_rows, players.group_rows)
    return modeling.match_samples(balls.frame, teams.frame, players.frame, group_rows=limit, **options)


def _summary(df):
    score = F.aggregate("balls", F.lit(0.0), lambda acc, row: acc + row[modeling.BALL_FEATURES.index("runs")])
    return df.select(
        "match_id", "label", "n_balls", score.cast("bigint").alias("score"),
        F.size("players").cast("bigint").alias("n_players"), "split",
    )


@query("c13_match_samples", samples_sql(1))
def _(t):
    return _summary(_samples(t))


@query("c13_match_samples_drop_30", samples_sql(30))
def _(t):
    return _summary(_samples(t, drop_last=30))


@query(
    "c13_split_sizes",
    f"""SELECT split AS "group", count(*) AS n FROM ({samples_sql(1)}) AS q GROUP BY split
        UNION ALL SELECT 'total', count(*) FROM ({samples_sql(1)}) AS q""",
)
def _(t):
    from wicketworks.operators.aggregates import counts_by

    return counts_by(_samples(t).where("chunk = 0"), "split")


@query(
    "c14_augmented_evaluation",
    f"""SELECT CAST("window" AS STRING) || ' overs' AS stage, {_SCORES} FROM ({_staged_sql(samples.EARLY_WINDOW_OVERS)}) AS c
        UNION ALL SELECT 'Overall', {_SCORES} FROM (SELECT {_COUNTS} FROM
          (SELECT doc_id, label, CASE WHEN probability > 0.5 THEN 1 ELSE 0 END AS prediction FROM ({P.SCORED}) AS s1) AS s) AS d""",
)
def _(t):
    return _round8(modeling.evaluate(t.sql(P.SCORED), ["doc_id"], samples.EARLY_WINDOW_OVERS).scores)


def _widths():
    return {"team_width": 13, "player_width": len(season_stats.PLAYER_MEASURES), "ball_width": len(modeling.BALL_FEATURES)}


# With an intercept and without a penalty the mean probability of the fitted rows is their mean label.
_FIT = {"maxIter": 1000, "tol": 1e-9}
_TRAINED = f"""SELECT count(*) FILTER (WHERE split = 'test') AS n_test, round(avg(label) FILTER (WHERE split = 'train'), 3) AS train_mean
    FROM ({samples_sql(1)}) AS q"""


@query(
    "c14_augmented_training",
    f"""SELECT w.k AS "window", n_test, train_mean FROM ({_TRAINED}) AS x
        CROSS JOIN (VALUES {', '.join(f'({w})' for w in samples.WINDOW_OVERS)}) AS w(k) WHERE n_test > 0""",
)
def _(t):
    trained = modeling.train_and_score(_samples(t), **_widths(), **_FIT)
    mean = trained.train.agg(F.round(F.avg("probability"), 3)).first()[0]
    return trained.scored.groupBy("window").agg(F.count("probability").alias("n_test"), F.lit(mean).alias("train_mean"))


@query("c15_plain_training", _TRAINED)
def _(t):
    trained = modeling.train_and_score(_samples(t), **_widths(), windows=None, **_FIT)
    mean = trained.train.agg(F.round(F.avg("probability"), 3)).first()[0]
    return trained.scored.agg(F.count("probability").alias("n_test"), F.lit(mean).alias("train_mean"))


_RUN_GROUPS = (2, 3, 5)


def _run_sql(k):
    return f"SELECT 'groups-{k}' AS run_id, * FROM ({grouped_sql(k)}) AS g{k}"


@query(
    "c16_best_run_report",
    f"""WITH o AS ({' UNION ALL '.join(_run_sql(k) for k in _RUN_GROUPS)}),
        m AS (SELECT run_id, g, avg(label) AS p FROM o WHERE split = 'train' GROUP BY run_id, g),
        s AS (SELECT o.run_id, o.split, o.label, m.p FROM o JOIN m ON o.run_id = m.run_id AND o.g = m.g),
        r AS (SELECT run_id FROM s WHERE split = 'val' GROUP BY run_id
              ORDER BY avg(-(label * ln(p) + (1 - label) * ln(1 - p))), run_id LIMIT 1)
        SELECT r.run_id, e.a AS actual, e.p AS predicted, count(t.label) AS n, round(max(t.mean), 4) AS mean_probability
        FROM r CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS e(a, p)
        LEFT JOIN (SELECT run_id, label, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS predicted, avg(p * p) OVER (PARTITION BY run_id) AS mean
                   FROM s WHERE split = 'test') AS t
          ON t.run_id = r.run_id AND t.label = e.a AND t.predicted = e.p GROUP BY r.run_id, e.a, e.p""",
)
def _(t):
    runs = []
    for k in _RUN_GROUPS:
        data, features = grouped_orders(t, k)
        model = fit_groups(data, features)
        scored = score(model, data.where("split = 'val'"), ["label"])
        path = save_model(model, scratch_path(t.spark, f"run-{k}"))
        runs.append((f"groups-{k}", metrics.cross_entropy(scored).first()[0], path))
    table = t.spark.createDataFrame(runs, "run_id STRING, val_loss DOUBLE, path STRING")
    chosen = modeling.select_run(table, "val_loss", maximize=False).first()
    data, _ = grouped_orders(t, int(chosen["run_id"].split("-")[1]))
    test = data.where("split = 'test'")
    run_id, evaluation = modeling.evaluate_best_run(table, test, "val_loss", ["o_orderkey"], maximize=False)
    mean = score(load_model(chosen["path"]), test, []).agg(F.round(F.avg(F.col("probability") ** 2), 4)).first()[0]
    return evaluation.confusion.select(
        F.lit(run_id).alias("run_id"), "actual", "predicted", "n", F.when(F.col("n") > 0, F.lit(mean)).alias("mean_probability")
    )


@query("c16_second_best_run", f"SELECT run_id, metric FROM ({P.RUNS}) AS r ORDER BY metric DESC NULLS LAST, run_id LIMIT 1 OFFSET 1")
def _(t):
    return modeling.select_run(t.sql(P.RUNS), "metric", k=2)


@query(
    "c17_land_new_files",
    """SELECT CAST(c_custkey AS STRING) || '.csv' AS file_name, c_name AS text FROM {customer} WHERE c_mktsegment <> 'BUILDING'""",
)
def _(t):
    landed = t.customer.where("c_mktsegment = 'BUILDING'").select(
        F.concat(F.col("c_custkey").cast("string"), F.lit(".csv")).alias("file_name")
    )
    return landing.new_match_files(customer_archives(t), landed)


_PAGE_HEAD = "<tr><th>Team</th><th>Season</th><th>Mat</th><th>Won</th><th>Lost</th><th>Tied</th><th>NR</th><th>Ave</th><th>RPO</th><th>LS</th></tr>"


_SEASON_TEXT = ", ".join(f'CAST("{c}" AS STRING) AS "{c}"' for c in ["Team", "Season", "Mat", "Won", "Lost", "Tied", "NR", "Ave", "RPO"])


@query("c17_team_pages_to_table", f"SELECT {_SEASON_TEXT} FROM ({P.TEAM_SEASONS}) AS s")
def _(t):
    # One page per team: the seasons of a team are its rows, a closing row makes at least two.
    seasons = t.sql(P.TEAM_SEASONS)
    names = ["Team", "Season", "Mat", "Won", "Lost", "Tied", "NR", "Ave", "RPO"]
    cells = [F.concat(F.lit("<td>"), F.col(c).cast("string"), F.lit("</td>")) for c in names]
    line = F.struct("Season", F.concat(F.lit("<tr>"), *cells, F.lit("<td>0</td></tr>")).alias("html"))
    page = F.regexp_extract("Team", r"(\d+)$", 1).cast("bigint").alias("page")
    packed = seasons.groupBy(page).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    body = F.array_join(F.transform("lines", lambda x: x["html"]), "")
    opening = "<table><tr><td>a</td></tr></table><table><tr><td>b</td></tr></table><table>" + _PAGE_HEAD
    closing = "<tr><td>end</td><td></td></tr></table>"
    pages = packed.select("page", F.lit("team").alias("stat_type"), F.concat(F.lit(opening), body, F.lit(closing)).alias("html"))
    return landing.team_table(pages).where(F.col("Team") != "end").drop("LS")


def _accepted():
    return f"({_ACCEPTED})"


WHOLE_BATCH = f"""SELECT match_id, n_balls, score, n_players FROM
    (SELECT match_id, count(*) AS n_balls, CAST(sum(runs) AS BIGINT) AS score FROM ({balls_sql(_accepted())}) AS b0 GROUP BY match_id) AS b
    JOIN (SELECT match_id, count(*) AS n_players FROM ({match_players_sql(P.INFO_ROSTER)}) AS p0 GROUP BY match_id) AS p USING (match_id)
    JOIN ({match_teams_sql(_accepted())}) AS t USING (match_id)"""


def whole_batch(done):
    """Balls, score and players of every match of the filtered tables."""
    balls = done["ball_to_ball"].groupBy("match_id").agg(F.count(F.lit(1)).alias("n_balls"), F.sum("runs").alias("score"))
    players = done["players_stats"].groupBy("match_id").agg(F.count(F.lit(1)).alias("n_players"))
    return balls.join(players, "match_id").join(done["team12_stats"].select("match_id"), "match_id").select(
        "match_id", "n_balls", "score", "n_players"
    )


@query("c18_whole_batch", WHOLE_BATCH)
def _(t):
    seasons = _seasons(t)
    # Not stored here: the batch writes the lines as its first layer and reads them from there.
    raw = batch.RawTables(
        split_text(info_texts(t)), t.sql(P.DELIVERIES), seasons, seasons, seasons, t.sql(P.TEAM_SEASONS)
    )
    return whole_batch(batch.process(raw, scratch_path(t.spark, "batch")))
