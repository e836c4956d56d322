"""Match-shaped views of the given tables.

Each is a SELECT that both engines read, so the registered queries and their SQL start from
the same rows. Orders are matches, line items are balls and roster entries, order years are
seasons. Nulls and '-' sentinels are made by expression.
"""

from __future__ import annotations

_TEAM1 = "'TEAM_' || CAST({k} % 400 AS STRING)"
_TEAM2 = "'TEAM_' || CAST(({k} % 400 + 1 + {k} % 23) % 400 AS STRING)"


def _team(template: str, key: str) -> str:
    return template.replace("{k}", key)


DELIVERIES = f"""
SELECT l_orderkey AS match_id,
       CAST(year(l_shipdate) AS STRING) AS season,
       CAST(CAST(l_shipdate AS DATE) AS STRING) AS start_date,
       'Ground ' || CAST(l_suppkey % 10 AS STRING) AS venue,
       1 + l_linenumber % 2 AS innings,
       l_linenumber * 2 + (l_quantity % 6 + 1) / 10 AS ball,
       CASE WHEN l_linenumber % 2 = 0 THEN {_team(_TEAM1, 'l_orderkey')}
            ELSE {_team(_TEAM2, 'l_orderkey')} END AS batting_team,
       CASE WHEN l_linenumber % 2 = 0 THEN {_team(_TEAM2, 'l_orderkey')}
            ELSE {_team(_TEAM1, 'l_orderkey')} END AS bowling_team,
       'S' || CAST(l_partkey % 11 AS STRING) AS striker,
       'N' || CAST(l_partkey % 12 AS STRING) AS non_striker,
       'B' || CAST(l_suppkey % 13 AS STRING) AS bowler,
       CASE WHEN l_partkey % 13 <> 0 THEN CAST(l_quantity AS INTEGER) % 7 END AS runs_off_bat,
       CAST(l_suppkey % 3 AS INTEGER) AS extras,
       CASE WHEN l_suppkey % 5 = 0 THEN 1 END AS wides,
       CASE WHEN l_suppkey % 7 = 0 THEN '1' END AS noballs,
       CASE WHEN l_partkey % 9 = 0 THEN 2 END AS byes,
       CASE WHEN l_partkey % 8 = 0 THEN 1 END AS legbyes,
       CASE WHEN l_partkey % 50 = 0 THEN '5' END AS penalty,
       CASE WHEN l_returnflag = 'R' THEN 'caught' END AS wicket_type,
       CASE WHEN l_returnflag = 'R' THEN 'P' || CAST(l_partkey AS STRING) END AS player_dismissed,
       CASE WHEN l_returnflag = 'R' AND l_suppkey % 4 = 0 THEN 'retired' END AS other_wicket_type,
       CASE WHEN l_returnflag = 'R' AND l_suppkey % 4 = 0
            THEN 'Q' || CAST(l_partkey AS STRING) END AS other_player_dismissed
FROM {{lineitem}}"""

MATCHES = f"""
SELECT o_orderkey AS match_id,
       {_team(_TEAM1, 'o_orderkey')} AS team1,
       {_team(_TEAM2, 'o_orderkey')} AS team2,
       CASE WHEN o_orderstatus = 'P' THEN 'female' ELSE 'male' END AS gender,
       CAST(year(o_orderdate) AS STRING) AS season,
       CASE WHEN o_custkey % 2 = 0 THEN {_team(_TEAM1, 'o_orderkey')}
            ELSE {_team(_TEAM2, 'o_orderkey')} END AS winner
FROM {{orders}}"""

# Matches of which every tenth customer's have no winner.
OPEN_MATCHES = f"""
SELECT match_id, team1, team2, gender, season, CASE WHEN o_custkey % 10 <> 3 THEN winner END AS winner
FROM ({MATCHES}) AS m JOIN {{orders}} AS o ON m.match_id = o.o_orderkey"""

TEAM_SEASONS = f"""
SELECT team1 AS "Team", season AS "Season",
       CAST(count(*) AS INTEGER) AS "Mat",
       CAST(sum(CASE WHEN winner = team1 THEN 1 ELSE 0 END) AS INTEGER) AS "Won",
       CAST(sum(CASE WHEN winner <> team1 AND match_id % 3 > 0 THEN 1 ELSE 0 END) AS INTEGER) AS "Lost",
       CAST(sum(CASE WHEN winner <> team1 AND match_id % 3 = 0 THEN 1 ELSE 0 END) AS INTEGER) AS "Tied",
       CAST(sum(CASE WHEN match_id % 5 = 0 THEN 1 ELSE 0 END) AS INTEGER) AS "NR",
       CASE WHEN count(*) % 4 = 0 THEN '-' ELSE CAST(sum(match_id) % 40 AS STRING) || '.25' END AS "Ave",
       CASE WHEN count(*) % 5 = 0 THEN '-' ELSE CAST(sum(match_id) % 9 AS STRING) || '.5' END AS "RPO"
FROM ({MATCHES}) AS m GROUP BY team1, season"""

# Country of player number n by n % 8: two codes for one country, a composite and an unknown code.
CODES = ["IND", "AUS", "ENG", "PAK", "SWZ", "SWA", "ICC/PAK", "XX"]
COUNTRIES = ["India", "Australia", "England", "Pakistan", "Eswatini", "Eswatini", "none", "none"]


def _by_number(n: str, values: list[str]) -> str:
    return f"CASE {n} % 8 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def player_name(n: str) -> str:
    """Every hundredth player is a namesake, from the same country, of the one eight before."""
    return f"'Player ' || CAST(CASE WHEN {n} % 100 = 8 THEN {n} - 8 ELSE {n} END AS STRING)"


def player_code(n: str) -> str:
    return _by_number(n, CODES)


def player_country(n: str) -> str:
    return _by_number(n, COUNTRIES)


# The codes above that the code table knows.
KNOWN_CODES_SQL = (
    "(VALUES ('IND', 'India'), ('AUS', 'Australia'), ('ENG', 'England'), ('PAK', 'Pakistan'), "
    "('SWZ', 'Eswatini'), ('SWA', 'Eswatini')) AS codes(code, country_name)"
)

PLAYER_SEASONS = f"""
SELECT CASE WHEN n % 100 = 99 THEN 'No Country ' || CAST(n AS STRING)
            ELSE {player_name('n')} || ' (' || {player_code('n')} || ')' ||
                 CASE WHEN n % 3 = 0 THEN ' [' || CAST(n AS STRING) || ']' ELSE '' END END AS "Player",
       season AS "Season",
       CAST(mat AS INTEGER) AS "Mat",
       CASE WHEN inns = 0 THEN '-' ELSE CAST(inns AS STRING) END AS "Inns",
       CASE WHEN inns = 0 THEN '-' ELSE CAST(runs AS STRING) END AS "Runs",
       CASE WHEN inns = 0 THEN '-' ELSE CAST(mat * 10 AS STRING) || '.5' END AS "SR",
       CASE WHEN inns = 0 OR mat % 5 = 0 THEN '-' ELSE CAST(runs % 97 AS STRING) || '.25' END AS "Ave",
       CASE WHEN inns = 0 THEN '-' ELSE CAST(runs % 40 AS STRING) || '.5' END AS "Overs",
       CASE WHEN inns = 0 THEN '-' ELSE CAST(runs % 3 AS STRING) END AS "Mdns",
       CASE WHEN inns = 0 THEN '-' ELSE CAST(runs % 11 AS STRING) END AS "Wkts",
       CASE WHEN inns = 0 OR mat % 4 = 0 THEN '-' ELSE CAST(runs % 9 AS STRING) || '.75' END AS "Econ",
       CASE WHEN inns = 0 THEN '-' ELSE CAST(runs % 7 AS STRING) END AS "Dis",
       CASE WHEN inns = 0 THEN '-' ELSE CAST(runs % 5 AS STRING) END AS "Ct",
       CASE WHEN inns = 0 THEN '-' ELSE CAST(runs % 2 AS STRING) END AS "St",
       CASE WHEN inns = 0 OR mat % 3 = 0 THEN '-' ELSE '0.5' END AS "D/I"
FROM (SELECT o_custkey AS n, CAST(year(o_orderdate) AS STRING) AS season, count(*) AS mat,
             sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS inns,
             sum(CAST(floor(o_totalprice) AS BIGINT) % 200) AS runs
      FROM {{orders}} GROUP BY o_custkey, year(o_orderdate)) AS base"""

ROSTER = f"""
SELECT l_orderkey AS match_id, {player_name('l_partkey')} AS player, {player_country('l_partkey')} AS country,
       CAST(year(l_shipdate) AS STRING) AS season, 'id' || CAST(l_partkey AS STRING) AS player_id
FROM {{lineitem}}"""

SEQUENCES = "SELECT conv_id, turn, CAST(length(text) AS BIGINT) AS n_chars, role FROM {conversations}"

SCORED = """
SELECT d.doc_id, l.quality AS label, (CAST(d.n_chars % 1000 AS DOUBLE) + 0.5) / 1000 AS probability
FROM {documents} AS d JOIN {labels} AS l ON d.doc_id = l.doc_id"""

RUNS = """
SELECT s_suppkey AS run_id, CASE WHEN s_suppkey % 7 <> 0 THEN s_acctbal END AS metric FROM {supplier}"""

HISTORY = """
SELECT (CAST(day(ts) AS BIGINT) - 1) * 24 + hour(ts) AS epoch, count(*) % 37 + 10 AS val_loss
FROM {events} GROUP BY day(ts), hour(ts)"""


# The roster of the info texts: 22 of a hundred players with known codes, 21 for every ninth customer.
INFO_ROSTER = f"""
SELECT match_id, {player_country('n')} AS country, 'Player ' || CAST(n AS STRING) AS player,
       'id' || CAST(n AS STRING) AS player_id, season, i
FROM (SELECT match_id, season, i, CAST(floor(k / 6) AS BIGINT) * 8 + k % 6 AS n
      FROM (SELECT o_orderkey AS match_id, CAST(year(o_orderdate) AS STRING) AS season, i, (o_custkey * 22 + i) % 100 AS k
            FROM {{orders}}, (SELECT unnest(range(1, 23)) AS i) AS numbers WHERE o_custkey % 9 > 0) AS drawn) AS listed"""
