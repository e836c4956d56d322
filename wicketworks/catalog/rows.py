"""Projections, filters, cleaning and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from wicketworks.catalog import proxies as P
from wicketworks.catalog.registry import query, rounded
from wicketworks.functions import arrays, cleaning, text
from wicketworks.lookups import COUNTRY_CODES, MIXED_TEAM_CODES, OUTLIER_CODES
from wicketworks.operators import rows
from wicketworks.operators.aggregates import sequences
from wicketworks.plans.match_files import DISMISSALS


@query("p01_column_subset", "SELECT c_name, c_custkey, c_nationkey FROM {customer}")
def _(t):
    return rows.pick(t.customer, ["c_name", "c_custkey", "c_nationkey"])


@query("p02_drop_columns", "SELECT p_partkey, p_name, p_brand, p_type, p_size FROM {part}")
def _(t):
    return t.part.drop("p_retailprice", "no_such_column")


@query("p03_rename_by_map", "SELECT s_suppkey AS id, s_name AS name, s_nationkey FROM {supplier}")
def _(t):
    renamed = rows.rename(t.supplier, {"s_suppkey": "id", "s_name": "name", "absent": "ignored"})
    return renamed.select("id", "name", "s_nationkey")


@query(
    "p04_dash_to_zero",
    f"""SELECT "Player" AS player, "Season" AS season,
        CASE WHEN "Inns" = '-' THEN 0 ELSE CAST("Inns" AS INTEGER) END AS inns,
        CASE WHEN "SR" = '-' THEN CAST(0 AS DOUBLE) ELSE CAST("SR" AS DOUBLE) END AS sr
        FROM ({P.PLAYER_SEASONS}) AS s""",
)
def _(t):
    return t.sql(P.PLAYER_SEASONS).select(
        F.col("Player").alias("player"),
        F.col("Season").alias("season"),
        cleaning.dash_to_zero("Inns", "int").alias("inns"),
        cleaning.dash_to_zero("SR").alias("sr"),
    )


@query(
    "p05_dash_to_ratio",
    f"""SELECT "Player" AS player, "Season" AS season,
        CASE WHEN "Ave" <> '-' THEN CAST("Ave" AS DOUBLE)
             WHEN "Inns" = '-' THEN CAST(0 AS DOUBLE)
             ELSE {rounded('CAST(CAST("Runs" AS INTEGER) AS DOUBLE) / CAST("Inns" AS INTEGER)', 4)} END AS ave
        FROM ({P.PLAYER_SEASONS}) AS s""",
)
def _(t):
    runs, inns = cleaning.dash_to_zero("Runs", "int"), cleaning.dash_to_zero("Inns", "int")
    ave = F.coalesce(cleaning.dash_to_ratio("Ave", runs, inns), F.lit(0.0))
    return t.sql(P.PLAYER_SEASONS).select(
        F.col("Player").alias("player"), F.col("Season").alias("season"), F.round(ave, 4).alias("ave")
    )


_RAW = f"({P.DELIVERIES}) AS d"


@query(
    "p06_fill_nulls",
    f"""SELECT match_id, innings, ball, coalesce(wides, 0) AS wides, coalesce(byes, 0) AS byes, noballs
        FROM {_RAW}""",
)
def _(t):
    return t.sql(P.DELIVERIES).fillna(0).select("match_id", "innings", "ball", "wides", "byes", "noballs")


@query(
    "p07_null_text_to_int",
    f"""SELECT match_id, innings, ball, CAST(coalesce(noballs, '0') AS INTEGER) AS noballs,
        CAST(coalesce(penalty, '0') AS INTEGER) AS penalty FROM {_RAW}""",
)
def _(t):
    return t.sql(P.DELIVERIES).select(
        "match_id", "innings", "ball",
        *[cleaning.null_to_zero_int(c).alias(c) for c in ("noballs", "penalty")],
    )


@query(
    "p08_presence_flags",
    "SELECT match_id, innings, ball, "
    + ", ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END AS {c}" for c in DISMISSALS)
    + f" FROM {_RAW}",
)
def _(t):
    return t.sql(P.DELIVERIES).select(
        "match_id", "innings", "ball", *[cleaning.presence_flag(c).alias(c) for c in DISMISSALS]
    )


@query(
    "p09_binary_code",
    f"SELECT match_id, CASE WHEN gender = 'male' THEN 0 ELSE 1 END AS gender FROM ({P.MATCHES}) AS m",
)
def _(t):
    return t.sql(P.MATCHES).select("match_id", cleaning.binary_code("gender", "male").alias("gender"))


@query(
    "p10_dictionary_replace",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction' WHEN 'MACHINERY' THEN 'Machines'
       ELSE c_mktsegment END AS c_mktsegment FROM {customer}""",
)
def _(t):
    mapping = {"BUILDING": "Construction", "MACHINERY": "Machines"}
    return rows.replace_values(t.customer.select("c_custkey", "c_mktsegment"), mapping, ["c_mktsegment"])


@query("p11_whitelist", "SELECT o_orderkey, o_orderpriority FROM {orders} WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def _(t):
    return rows.keep_listed(t.orders, "o_orderpriority", ["1-URGENT", "5-LOW"]).select("o_orderkey", "o_orderpriority")


@query(
    "p11_whitelist_from_table",
    """SELECT o_orderkey, o_custkey FROM {orders}
       WHERE o_custkey IN (SELECT c_custkey FROM {customer} WHERE c_mktsegment = 'BUILDING')""",
)
def _(t):
    chosen = t.customer.where(F.col("c_mktsegment") == "BUILDING")
    return rows.keep_matching(t.orders.select("o_orderkey", "o_custkey"), chosen, "o_custkey", "c_custkey")


@query(
    "p12_blacklist",
    f"""SELECT match_id, team1, team2 FROM ({P.OPEN_MATCHES}) AS m
        WHERE team1 NOT IN (SELECT winner FROM ({P.OPEN_MATCHES}) AS w WHERE gender = 'female' AND winner IS NOT NULL AND match_id % 7 = 0)
          AND team2 NOT IN (SELECT winner FROM ({P.OPEN_MATCHES}) AS w WHERE gender = 'female' AND winner IS NOT NULL AND match_id % 7 = 0)""",
)
def _(t):
    matches = t.sql(P.OPEN_MATCHES)
    banned = matches.where((F.col("gender") == "female") & (F.col("match_id") % 7 == 0)).select("winner")
    return rows.drop_listed(matches.select("match_id", "team1", "team2"), ["team1", "team2"], banned, "winner")


@query(
    "p13_map_codes",
    f"""SELECT s."Player" AS player, s."Season" AS season, codes.country_name AS country
        FROM (SELECT "Player", "Season", regexp_extract("Player", '\\((.*?)\\)', 1) AS code
              FROM ({P.PLAYER_SEASONS}) AS p) AS s
        JOIN {P.KNOWN_CODES_SQL} ON s.code = codes.code""",
)
def _(t):
    seasons = t.sql(P.PLAYER_SEASONS).select(
        F.col("Player").alias("player"), F.col("Season").alias("season"), text.label_country("Player").alias("country")
    )
    return rows.map_codes(seasons, "country", COUNTRY_CODES)


@query(
    "p14_dictionary_minus_keys",
    """SELECT n.n_name AS code, n.n_name AS name FROM {nation} AS n
       WHERE n.n_name NOT IN (SELECT n_name FROM {nation} WHERE n_regionkey = 1)
         AND n.n_name NOT IN (SELECT n_name FROM {nation} WHERE n_regionkey = 3)""",
)
def _(t):
    codes = t.nation.select(F.col("n_name").alias("code"), F.col("n_name").alias("name"), "n_regionkey")
    excluded = [codes.where(F.col("n_regionkey") == k).select("code") for k in (1, 3)]
    return rows.without_codes(codes.drop("n_regionkey"), *excluded)


@query(
    "p14_player_codes_without_mixed_teams",
    f"""SELECT s."Player" AS player, s."Season" AS season, codes.country_name AS country
        FROM (SELECT "Player", "Season", regexp_extract("Player", '\\((.*?)\\)', 1) AS code
              FROM ({P.PLAYER_SEASONS}) AS p) AS s
        JOIN {P.KNOWN_CODES_SQL} ON s.code = codes.code""",
)
def _(t):
    # Labels with ICC/PAK are in the data: without the subtraction they would map to a country.
    every, mixed, outliers = (
        rows.lookup_table(t.spark, codes, "code", "name")
        for codes in ({**COUNTRY_CODES, **MIXED_TEAM_CODES, **OUTLIER_CODES}, MIXED_TEAM_CODES, OUTLIER_CODES)
    )
    plain = rows.without_codes(every, mixed, outliers)
    seasons = t.sql(P.PLAYER_SEASONS).select(
        F.col("Player").alias("player"), F.col("Season").alias("season"), text.label_country("Player").alias("country")
    )
    return seasons.join(plain, F.col("country") == F.col("code")).select("player", "season", F.col("name").alias("country"))


@query(
    "p15_equality_and_substring",
    "SELECT p_partkey, p_name FROM {part} WHERE p_type = 'ECONOMY' AND contains(p_name, 'ring')",
)
def _(t):
    economy = rows.keep_equal(t.part, "p_type", "ECONOMY")
    return rows.keep_containing(economy, "p_name", "ring").select("p_partkey", "p_name")


@query("p16_row_kind", "SELECT conv_id, turn, text FROM {conversations} WHERE role = 'user'")
def _(t):
    return rows.keep_kind(t.conversations, "role", "user", ["conv_id", "turn", "text"])


@query("p17_required_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders}")
def _(t):
    wanted = ["o_orderkey", "o_custkey", "o_totalprice"]
    return rows.require_columns(t.orders, wanted, "orders").select(*wanted)


@query("p18_non_empty", "SELECT s_suppkey, s_acctbal FROM {supplier}")
def _(t):
    return rows.require_rows(t.supplier, "supplier").select("s_suppkey", "s_acctbal")


_P19 = "CASE WHEN winner IS NULL THEN 'winner' WHEN gender = 'female' AND season = '1995' THEN 'season' END"


@query(
    "p19_quarantine_accepted",
    f"SELECT match_id, team1, team2, winner FROM ({P.OPEN_MATCHES}) AS m WHERE ({_P19}) IS NULL",
)
def _(t):
    return rows.quarantine(t.sql(P.OPEN_MATCHES), F.expr(_P19))[0].select("match_id", "team1", "team2", "winner")


@query(
    "p19_quarantine_rejected",
    f"SELECT match_id, {_P19} AS reject_reason FROM ({P.OPEN_MATCHES}) AS m WHERE ({_P19}) IS NOT NULL",
)
def _(t):
    return rows.quarantine(t.sql(P.OPEN_MATCHES), F.expr(_P19))[1].select("match_id", "reject_reason")


@query(
    "p20_groups_of_exact_size",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM {lineitem}
       WHERE l_orderkey IN (SELECT l_orderkey FROM {lineitem} GROUP BY l_orderkey HAVING count(*) = 4)""",
)
def _(t):
    return rows.complete_groups(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey"], 4)


_JOINED = f"({P.DELIVERIES}) AS d JOIN ({P.MATCHES}) AS m ON d.match_id = m.match_id"


@query(
    "p21_label_batting_side",
    f"""SELECT d.match_id, d.innings, d.ball, CASE WHEN d.batting_team = m.winner THEN 1 ELSE 0 END AS won
        FROM {_JOINED}""",
)
def _(t):
    joined = t.sql(P.DELIVERIES).join(t.sql(P.MATCHES).select("match_id", "winner"), "match_id")
    won = cleaning.won_by_batting_side("batting_team", "winner")
    return joined.select("match_id", "innings", "ball", won.alias("won"))


@query(
    "p22_label_chasing_side",
    f"""SELECT d.match_id, d.innings, d.ball,
        CASE WHEN (d.batting_team = m.winner AND d.innings = 2) OR (d.bowling_team = m.winner AND d.innings = 1)
             THEN 1 ELSE 0 END AS won FROM {_JOINED}""",
)
def _(t):
    joined = t.sql(P.DELIVERIES).join(t.sql(P.MATCHES).select("match_id", "winner"), "match_id")
    won = cleaning.won_by_chasing_side("batting_team", "bowling_team", "winner", "innings")
    return joined.select("match_id", "innings", "ball", won.alias("won"))


def _label_query(name, function, pattern):
    @query(
        name,
        f"""SELECT "Player" AS player, "Season" AS season, regexp_extract("Player", '{pattern}', 1) AS part
            FROM ({P.PLAYER_SEASONS}) AS s""",
    )
    def _(t):
        return t.sql(P.PLAYER_SEASONS).select(
            F.col("Player").alias("player"), F.col("Season").alias("season"), function("Player").alias("part")
        )


_label_query("f01_text_in_parentheses", text.label_country, r"\((.*?)\)")
_label_query("f02_text_in_brackets", text.label_id, r"\[(.*?)\]")
_label_query("f03_text_before_parenthesis", text.label_name, r"^(.*?)\s\(")


@query(
    "f04_null_safe_sum",
    f"""SELECT match_id, innings, ball, coalesce(runs_off_bat, 0) + coalesce(extras, 0) + coalesce(wides, 0)
        + coalesce(byes, 0) + coalesce(legbyes, 0) AS runs FROM {_RAW}""",
)
def _(t):
    runs = cleaning.null_safe_sum("runs_off_bat", "extras", "wides", "byes", "legbyes")
    return t.sql(P.DELIVERIES).select("match_id", "innings", "ball", runs.alias("runs"))


@query(
    "f05_ratio_or_numerator",
    f"""SELECT "Team" AS team, "Season" AS season,
        CASE WHEN "Lost" = 0 THEN CAST("Won" AS DOUBLE) ELSE {rounded('CAST("Won" AS DOUBLE) / "Lost"')} END AS wl
        FROM ({P.TEAM_SEASONS}) AS s""",
)
def _(t):
    return t.sql(P.TEAM_SEASONS).select(
        F.col("Team").alias("team"), F.col("Season").alias("season"), cleaning.ratio_or_numerator("Won", "Lost").alias("wl")
    )


@query(
    "f06_ratio_or_zero",
    """SELECT l_orderkey, l_linenumber, l_quantity,
       CASE WHEN l_suppkey % 4 <> 0 THEN round(l_quantity / (l_suppkey % 4), 6) ELSE CAST(0 AS DOUBLE) END AS rate
       FROM {lineitem}""",
)
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", (F.col("l_suppkey") % 4).alias("d"))
    rate = F.round(cleaning.ratio_or_zero("l_quantity", "d"), 6)
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", rate.alias("rate"))


@query(
    "f07_required_rate",
    f"""SELECT match_id, innings, ball,
        CASE WHEN innings = 1 THEN CAST(0 AS DOUBLE)
             ELSE round(CAST(150 - 3 * CAST(ball AS DOUBLE) AS DOUBLE) / (20 - CAST(floor(ball) AS INTEGER)), 6)
        END AS required FROM {_RAW}""",
)
def _(t):
    balls = t.sql(P.DELIVERIES).select(
        "match_id", "innings", "ball", F.lit(150).alias("target"), (3 * F.col("ball")).alias("score"),
        cleaning.completed_overs("ball").alias("overs"),
    )
    rate = F.round(cleaning.required_rate("target", "score", "overs", "innings"), 6)
    return balls.select("match_id", "innings", "ball", rate.alias("required"))


@query(
    "f08_truncating_cast",
    f"SELECT match_id, innings, ball, CAST(floor(ball) AS INTEGER) AS overs FROM {_RAW}",
)
def _(t):
    return t.sql(P.DELIVERIES).select("match_id", "innings", "ball", cleaning.completed_overs("ball").alias("overs"))


@query("f09_round_half_up", f"SELECT l_orderkey, l_linenumber, l_extendedprice, {rounded('l_extendedprice / 7')} AS seventh FROM {{lineitem}}")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", F.round(F.col("l_extendedprice") / 7, 2).alias("seventh")
    )


@query(
    "f10_numeric_casts",
    f"""SELECT "Player" AS player, "Season" AS season, coalesce(TRY_CAST("Runs" AS INTEGER), -1) AS runs,
        coalesce(TRY_CAST("SR" AS DOUBLE), CAST(-1 AS DOUBLE)) AS sr FROM ({P.PLAYER_SEASONS}) AS s""",
)
def _(t):
    return t.sql(P.PLAYER_SEASONS).select(
        F.col("Player").alias("player"),
        F.col("Season").alias("season"),
        F.coalesce(cleaning.to_number("Runs", "int"), F.lit(-1)).alias("runs"),
        F.coalesce(cleaning.to_number("SR", "double"), F.lit(-1.0)).alias("sr"),
    )


@query(
    "f11_null_or_nan",
    """SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 OR s_suppkey % 7 = 0 THEN true ELSE false END AS missing
       FROM {supplier}""",
)
def _(t):
    holed = t.supplier.select(
        "s_suppkey",
        F.when(F.col("s_suppkey") % 5 == 0, None)
        .when(F.col("s_suppkey") % 7 == 0, F.lit("NaN").cast("double"))
        .otherwise(F.col("s_acctbal")).alias("v"),
    )
    return holed.select("s_suppkey", cleaning.null_or_nan("v", "double").alias("missing"))


_SEQ = f"({P.SEQUENCES}) AS s"


@query(
    "f12_array_prefix_pad_length",
    f"""SELECT conv_id, CAST(count(*) AS INTEGER) AS length,
        CAST(sum(CASE WHEN pos <= 3 THEN n_chars ELSE 0 END) AS BIGINT) AS prefix_chars,
        CAST(sum(CASE WHEN pos > total - 2 THEN n_chars ELSE 0 END) AS BIGINT) AS suffix_chars,
        CAST(greatest(count(*), 6) AS INTEGER) AS padded_length
        FROM (SELECT conv_id, n_chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos,
                     count(*) OVER (PARTITION BY conv_id) AS total FROM {_SEQ}) AS n
        GROUP BY conv_id""",
)
def _(t):
    seq = sequences(t.sql(P.SEQUENCES), ["conv_id"], ["turn"], ["n_chars"])

    def chars(array):
        return F.aggregate(array, F.lit(0.0), lambda acc, row: acc + row[0]).cast("bigint")

    padded = arrays.pad(F.col("rows"), F.lit(6), F.array(F.lit(0.0)))
    return seq.select(
        "conv_id",
        F.size("rows").alias("length"),
        chars(arrays.prefix(F.col("rows"), 3)).alias("prefix_chars"),
        chars(arrays.suffix(F.col("rows"), 2)).alias("suffix_chars"),
        F.size(padded).alias("padded_length"),
    )
