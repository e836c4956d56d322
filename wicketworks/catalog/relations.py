"""Joins, set operations, aggregates, windows, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from wicketworks import schemas
from wicketworks.catalog import proxies as P
from wicketworks.catalog.registry import query, rounded
from wicketworks.operators import aggregates, joins, ordering, rows, windows
from wicketworks.operators.windows import Ratio, Running, Weighted

_RAW = f"({P.DELIVERIES}) AS d"


@query(
    "j01_inner_one_key",
    """SELECT l_orderkey, l_linenumber, l_quantity, o_custkey FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
)
def _(t):
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return joins.inner_on(lines, orders, "l_orderkey")


_STATS = f"""SELECT "Player" AS label, "Season" AS season, "Mat" AS mat,
    regexp_extract("Player", '^(.*?)\\s\\(', 1) AS player, regexp_extract("Player", '\\((.*?)\\)', 1) AS code
    FROM ({P.PLAYER_SEASONS}) AS p"""


@query(
    "j02_inner_three_keys",
    f"""SELECT r.match_id, r.player, r.country, r.season, s.mat
        FROM ({P.ROSTER}) AS r
        JOIN (SELECT q.player, q.season, q.mat, codes.country_name FROM ({_STATS}) AS q
              JOIN {P.KNOWN_CODES_SQL} ON q.code = codes.code) AS s
          ON r.player = s.player AND r.country = s.country_name AND r.season = s.season""",
)
def _(t):
    from wicketworks.functions import text
    from wicketworks.lookups import COUNTRY_CODES

    stats = t.sql(P.PLAYER_SEASONS).select(
        text.label_name("Player").alias("player"), text.label_country("Player").alias("country"),
        F.col("Season").alias("season"), F.col("Mat").alias("mat"),
    )
    stats = rows.map_codes(stats, "country", COUNTRY_CODES)
    roster = t.sql(P.ROSTER).select("match_id", "player", "country", "season")
    return joins.inner_on(roster, stats, ["player", "country", "season"])


def _per_customer_year(t, name, value):
    return t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("common"), value.alias(name)
    )


_YEARLY = "SELECT o_custkey, year(o_orderdate) AS year, {v} AS {n} FROM {{orders}} WHERE {w} GROUP BY o_custkey, year(o_orderdate)"


@query(
    "j03_chain_of_inner_joins",
    f"""SELECT a.o_custkey, a.year, a.n_orders, b.n_open, c.n_urgent
        FROM ({_YEARLY.format(v='count(*)', n='n_orders', w='true')}) AS a
        JOIN ({_YEARLY.format(v='count(*)', n='n_open', w="o_orderstatus = 'O'")}) AS b
          ON a.o_custkey = b.o_custkey AND a.year = b.year
        JOIN ({_YEARLY.format(v='count(*)', n='n_urgent', w="o_orderpriority = '1-URGENT'")}) AS c
          ON a.o_custkey = c.o_custkey AND a.year = c.year""",
)
def _(t):
    def yearly(orders, name):
        counted = orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias(name))
        return counted.withColumn("common", F.lit(1))

    tables = [
        yearly(t.orders, "n_orders"),
        yearly(t.orders.where("o_orderstatus = 'O'"), "n_open"),
        yearly(t.orders.where("o_orderpriority = '1-URGENT'"), "n_urgent"),
    ]
    return joins.chain_inner(tables, ["o_custkey", "year"], drop=["common"])


@query(
    "j04_role_playing_dimension",
    f"""SELECT m.match_id, a."Mat" AS "Mat team1", a."Won" AS "Won team1", b."Mat" AS "Mat team2", b."Won" AS "Won team2"
        FROM ({P.MATCHES}) AS m
        JOIN ({P.TEAM_SEASONS}) AS a ON m.team1 = a."Team" AND m.season = a."Season"
        JOIN ({P.TEAM_SEASONS}) AS b ON m.team2 = b."Team" AND m.season = b."Season" """,
)
def _(t):
    joined = joins.join_roles(
        t.sql(P.MATCHES), t.sql(P.TEAM_SEASONS), ["team1", "team2"], "season", "Team", "Season", ["Mat", "Won"]
    )
    return joined.select("match_id", "Mat team1", "Won team1", "Mat team2", "Won team2")


@query(
    "j05_rows_with_registry",
    f"""SELECT r.match_id, r.player, r.country, g.player_id
        FROM (SELECT DISTINCT match_id, player, country FROM ({P.ROSTER}) AS a) AS r
        JOIN (SELECT DISTINCT match_id, player, player_id FROM ({P.ROSTER}) AS b) AS g
          ON r.match_id = g.match_id AND r.player = g.player""",
)
def _(t):
    roster = t.sql(P.ROSTER)
    listed = roster.select("match_id", "player", "country").distinct()
    registry = roster.select("match_id", "player", "player_id").distinct()
    return joins.inner_on(listed, registry, ["match_id", "player"])


@query(
    "j06_semi_join",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM {lineitem}
       WHERE l_orderkey IN (SELECT o_orderkey FROM {orders} WHERE o_orderstatus = 'F')""",
)
def _(t):
    keys = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.semi(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), keys, "l_orderkey")


@query(
    "j07_two_sided_anti_join",
    """SELECT CAST(a.o_custkey AS BIGINT) AS name, 'left' AS side FROM (SELECT DISTINCT o_custkey FROM {orders}) AS a
       WHERE NOT EXISTS (SELECT 1 FROM {part} WHERE p_partkey + 60 = a.o_custkey)
       UNION ALL
       SELECT p_partkey + 60, 'right' FROM {part} WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = p_partkey + 60)""",
)
def _(t):
    # Shifted, so that each side has keys of its own at every scale.
    parts = t.part.select((F.col("p_partkey") + 60).alias("shifted"))
    return joins.only_one_side(t.orders, parts, "o_custkey", "shifted")


@query(
    "j08_align_on_common_keys",
    """SELECT d.doc_id, d.n_docs, l.quality, b.items FROM
       (SELECT doc_id, count(*) AS n_docs FROM {documents} GROUP BY doc_id) AS d
       JOIN (SELECT doc_id, max(quality) AS quality FROM {labels} GROUP BY doc_id) AS l ON d.doc_id = l.doc_id
       JOIN (SELECT vec_id AS doc_id, count(*) AS items FROM {embeddings} GROUP BY vec_id) AS b ON d.doc_id = b.doc_id""",
)
def _(t):
    from wicketworks.operators.samples import align

    docs = t.documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_docs"))
    labels = t.labels.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    items = t.embeddings.groupBy(F.col("vec_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("items"))
    return align([docs, labels, items], "doc_id")


@query("x01_intersection_of_keys", """SELECT l_orderkey AS k FROM {lineitem} INTERSECT
       SELECT o_orderkey FROM {orders} WHERE o_orderstatus <> 'P' INTERSECT SELECT doc_id FROM {documents}""")
def _(t):
    return joins.common_keys(
        [
            t.lineitem.select(F.col("l_orderkey").alias("k")),
            t.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k")),
            t.documents.select(F.col("doc_id").alias("k")),
        ],
        "k",
    )


@query("x02_union_by_name", """SELECT s_suppkey AS id, s_name AS name FROM {supplier} UNION ALL
       SELECT c_custkey, c_name FROM {customer} UNION ALL SELECT p_partkey, p_name FROM {part}""")
def _(t):
    return joins.union_all(
        [
            t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
            t.customer.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id")),
            t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")),
        ]
    )


@query("x03_set_difference", "SELECT o_custkey AS k FROM {orders} EXCEPT SELECT doc_id FROM {documents}")
def _(t):
    return joins.missing_keys(
        t.orders.select(F.col("o_custkey").alias("k")), t.documents.select(F.col("doc_id").alias("k")), "k"
    )


def _three(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("k"), "l_linenumber", "l_quantity")
    orders = t.orders.where("o_orderstatus <> 'O'").select(F.col("o_orderkey").alias("k"), "o_totalprice")
    events = t.events.select(F.col("event_id").alias("k"), "event_type")
    return joins.restrict_to_common([lines, orders, events], "k")


_COMMON = """SELECT l_orderkey FROM {lineitem} INTERSECT SELECT o_orderkey FROM {orders} WHERE o_orderstatus <> 'O'
    INTERSECT SELECT event_id FROM {events}"""


@query("x04_restrict_lines", f"SELECT l_orderkey AS k, l_linenumber, l_quantity FROM {{lineitem}} WHERE l_orderkey IN ({_COMMON})")
def _(t):
    return _three(t)[0]


@query("x04_restrict_orders", f"SELECT o_orderkey AS k, o_totalprice FROM {{orders}} WHERE o_orderkey IN ({_COMMON})")
def _(t):
    return _three(t)[1]


@query("x04_restrict_events", f"SELECT event_id AS k, event_type FROM {{events}} WHERE event_id IN ({_COMMON})")
def _(t):
    return _three(t)[2]


@query("a01_shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM {lineitem}")
def _(t):
    return aggregates.shape(t.lineitem)


@query(
    "a02_distinct_count",
    "SELECT count(*) AS n_distinct FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM {lineitem}) AS x",
)
def _(t):
    return aggregates.distinct_count(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("a03_group_count_having", "SELECT l_orderkey FROM {lineitem} GROUP BY l_orderkey HAVING count(*) = 5")
def _(t):
    return rows.groups_of_size(t.lineitem, ["l_orderkey"], 5)


@query("a04_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM {lineitem}")
def _(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@query(
    "a05_keep_first",
    """SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) AS n
         FROM {orders}) AS x WHERE n = 1""",
)
def _(t):
    first = aggregates.keep_first(t.orders, ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"])
    return first.select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")


_HOLED = [field.split()[0] for field in schemas.DELIVERIES.split(", ")]


@query(
    "a06_null_counts",
    "SELECT " + ", ".join(f"count(*) - count({c}) AS {c}" for c in _HOLED) + f" FROM {_RAW}",
)
def _(t):
    return aggregates.null_counts(t.sql(P.DELIVERIES).select(*_HOLED))


@query(
    "a07_total_nulls",
    "SELECT CAST(" + " + ".join(f"count(*) - count({c})" for c in _HOLED) + f" AS BIGINT) AS total_nulls FROM {_RAW}",
)
def _(t):
    return aggregates.total_nulls(t.sql(P.DELIVERIES).select(*_HOLED))


_SEQ = f"({P.SEQUENCES}) AS s"


@query(
    "a08_ordered_sequences",
    f"""SELECT conv_id, CAST(0 AS INTEGER) AS chunk, count(*) AS length,
        string_agg(CAST(n_chars AS STRING), ',' ORDER BY turn) AS chars FROM {_SEQ} GROUP BY conv_id""",
)
def _(t):
    seq = aggregates.sequences(t.sql(P.SEQUENCES), ["conv_id"], ["turn"], ["n_chars"])
    joined = F.array_join(F.transform("rows", lambda r: r[0].cast("bigint").cast("string")), ",")
    return seq.select("conv_id", "chunk", F.size("rows").cast("bigint").alias("length"), joined.alias("chars"))


@query(
    "a08_ball_sequences",
    """SELECT l_orderkey, count(*) AS length, CAST(sum(l_quantity) AS BIGINT) AS total,
       string_agg(CAST(CAST(l_quantity AS BIGINT) AS STRING), ',' ORDER BY l_linenumber, l_quantity) AS quantities
       FROM {lineitem} GROUP BY l_orderkey""",
)
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    seq = aggregates.sequences(lines, ["l_orderkey"], ["l_linenumber", "l_quantity"], ["l_quantity"])
    values = F.transform("rows", lambda r: r[0].cast("bigint"))
    return seq.select(
        "l_orderkey",
        F.size("rows").cast("bigint").alias("length"),
        F.aggregate(values, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("total"),
        F.array_join(F.transform(values, lambda v: v.cast("string")), ",").alias("quantities"),
    )


@query(
    "a09_label_of_first_row",
    """SELECT l_orderkey, l_linestatus AS label FROM (
         SELECT l_orderkey, l_linestatus, row_number() OVER (
           PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_linestatus) AS n
         FROM {lineitem}) AS x WHERE n = 1""",
)
def _(t):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_linestatus"]
    return aggregates.first_value(t.lineitem, ["l_orderkey"], order, "l_linestatus", "label")


def _drop_last(n):
    @query(
        f"a10_drop_last_{n}",
        f"""SELECT conv_id, turn, n_chars FROM (
              SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos,
                     count(*) OVER (PARTITION BY conv_id) AS total FROM {_SEQ}) AS x WHERE pos <= total - {n}""",
    )
    def _(t):
        kept = aggregates.drop_last_rows(t.sql(P.SEQUENCES), ["conv_id"], ["turn"], n)
        return kept.select("conv_id", "turn", "n_chars")


_drop_last(1)
_drop_last(3)


@query(
    "a11_counts_with_total",
    """SELECT role AS "group", count(*) AS n FROM {conversations} GROUP BY role
       UNION ALL SELECT 'total', count(*) FROM {conversations}""",
)
def _(t):
    return aggregates.counts_by(t.conversations, "role")


_EARLIER = "ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


@query(
    "w01_row_number",
    "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS row_num FROM {orders}",
)
def _(t):
    numbered = windows.row_numbers(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return numbered.select("o_custkey", "o_orderkey", "row_num")


@query(
    "w02_exclusive_sum",
    f"""SELECT o_custkey, o_orderkey, CAST(coalesce(sum(CAST(floor(o_totalprice) AS BIGINT))
        OVER (PARTITION BY o_custkey {_EARLIER}), 0) AS BIGINT) AS earlier FROM {{orders}}""",
)
def _(t):
    orders = t.orders.withColumn("price", F.floor("o_totalprice"))
    done = windows.exclusive_cumulative(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"earlier": "price"})
    return done.select("o_custkey", "o_orderkey", "earlier")


def _over(expression):
    return f"sum({expression}) OVER (PARTITION BY o_custkey {_EARLIER})"


_FILLED = "CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT)"
_PRICE = "CAST(floor(o_totalprice) AS BIGINT)"


def _status_orders(t):
    return t.orders.select(
        "o_custkey", "o_orderkey", "o_orderdate", F.floor("o_totalprice").alias("price"),
        (F.col("o_orderstatus") == "F").cast("bigint").alias("filled"),
        (F.col("o_orderkey") % 3).alias("third"),
    )


@query(
    "w03_exclusive_weighted_mean",
    f"""SELECT o_custkey, o_orderkey, CASE WHEN coalesce({_over(_FILLED)}, 0) = 0 THEN CAST(0 AS DOUBLE)
        ELSE {rounded(f'CAST({_over(f"{_FILLED} * {_PRICE}")} AS DOUBLE) / CAST({_over(_FILLED)} AS DOUBLE)')} END AS mean
        FROM {{orders}}""",
)
def _(t):
    done = windows.exclusive_cumulative(
        _status_orders(t), ["o_custkey"], ["o_orderdate", "o_orderkey"], {}, means={"mean": Weighted("price", "filled")}
    )
    return done.select("o_custkey", "o_orderkey", F.col("mean").cast("double").alias("mean"))


@query(
    "w04_exclusive_ratio",
    f"""SELECT o_custkey, o_orderkey, CASE WHEN coalesce({_over(_FILLED)}, 0) = 0 THEN CAST(0 AS DOUBLE)
        ELSE {rounded(f'CAST({_over("o_orderkey % 3")} AS DOUBLE) / CAST({_over(_FILLED)} AS DOUBLE)')} END AS ratio
        FROM {{orders}}""",
)
def _(t):
    done = windows.exclusive_cumulative(
        _status_orders(t), ["o_custkey"], ["o_orderdate", "o_orderkey"], {}, ratios={"ratio": Ratio("third", "filled")}
    )
    return done.select("o_custkey", "o_orderkey", F.col("ratio").cast("double").alias("ratio"))


@query(
    "w05_gated_weighted_mean",
    f"""SELECT o_custkey, o_orderkey, CASE WHEN coalesce({_over(_FILLED)}, 0) = 0 THEN CAST(0 AS DOUBLE)
        WHEN {_over("o_orderkey % 3")} = 0 THEN CAST(NULL AS DOUBLE)
        ELSE {rounded(f'CAST({_over(f"(o_orderkey % 3) * {_PRICE}")} AS DOUBLE) / CAST(nullif({_over("o_orderkey % 3")}, 0) AS DOUBLE)')}
        END AS mean FROM {{orders}}""",
)
def _(t):
    done = windows.exclusive_cumulative(
        _status_orders(t), ["o_custkey"], ["o_orderdate", "o_orderkey"], {},
        means={"mean": Weighted("price", "third", gate="filled")},
    )
    return done.select("o_custkey", "o_orderkey", F.col("mean").cast("double").alias("mean"))


_PEERS = "PARTITION BY l_orderkey ORDER BY l_linenumber RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


@query(
    "w06_running_total_with_ties",
    f"""SELECT l_orderkey, l_linenumber, l_quantity, sum(l_quantity) OVER ({_PEERS}) AS running_qty FROM {{lineitem}}""",
)
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return windows.running_totals(lines, ["l_orderkey"], ["l_linenumber"], {"running_qty": "l_quantity"})


@query(
    "w07_running_max",
    f"SELECT l_orderkey, l_linenumber, l_quantity, max(l_quantity) OVER ({_PEERS}) AS running_max FROM {{lineitem}}",
)
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return windows.running_max(lines, ["l_orderkey"], ["l_linenumber"], "l_quantity", "running_max")


@query(
    "w08_forward_fill",
    """SELECT event_id, user_id, coalesce(last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS)
       OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS last_click
       FROM {events}""",
)
def _(t):
    clicks = t.events.select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "click", F.col("value")).alias("click")
    )
    filled = windows.forward_fill(clicks, ["user_id"], ["ts", "event_id"], "click")
    return filled.select("event_id", "user_id", F.coalesce("click", F.lit(-1.0)).alias("last_click"))


@query(
    "w09_chase_target",
    f"""SELECT match_id, innings, ball, runs, CAST(CASE WHEN innings = 1 THEN 0 ELSE coalesce(max(CASE WHEN innings = 1 THEN curr_score END)
        OVER (PARTITION BY match_id), -1) END AS BIGINT) AS target
        FROM (SELECT match_id, innings, ball, runs, sum(runs) OVER (PARTITION BY match_id, innings ORDER BY ball
              RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS curr_score
              FROM (SELECT match_id, innings, ball, coalesce(runs_off_bat, 0) + extras AS runs FROM {_RAW}) AS r) AS s""",
)
def _(t):
    from wicketworks.plans.merge import chase_target

    balls = t.sql(P.DELIVERIES).select(
        "match_id", "innings", "ball", (F.coalesce("runs_off_bat", F.lit(0)) + F.col("extras")).alias("runs")
    )
    scored = windows.running_totals(balls, ["match_id", "innings"], ["ball"], {"curr_score": "runs"})
    target = F.coalesce("target", F.lit(-1)).cast("bigint")
    return chase_target(scored).select("match_id", "innings", "ball", "runs", target.alias("target"))


@query("o01_global_sort", "SELECT o_custkey, o_orderdate, o_orderkey FROM {orders} ORDER BY o_custkey, o_orderdate, o_orderkey")
def _(t):
    chosen = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    return ordering.sort_rows(chosen, ["o_custkey", "o_orderdate", "o_orderkey"])


@query("o02_first_rows", "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query(
    "o03_last_rows_of_sequence",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER
       (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM {events}) AS x WHERE n <= 5""",
)
def _(t):
    return aggregates.last_rows(t.events, ["user_id"], ["ts", "event_id"], 5).select("user_id", "event_id", "event_type")


@query("o04_best_run", f"SELECT run_id, metric FROM ({P.RUNS}) AS r ORDER BY metric DESC NULLS LAST, run_id LIMIT 1")
def _(t):
    return ordering.best(t.sql(P.RUNS), "metric", tiebreak=["run_id"])


@query("o04_lowest_run", f"SELECT run_id, metric FROM ({P.RUNS}) AS r ORDER BY metric ASC NULLS LAST, run_id LIMIT 1")
def _(t):
    return ordering.best(t.sql(P.RUNS), "metric", maximize=False, tiebreak=["run_id"])


@query("o05_second_best_run", f"SELECT run_id, metric FROM ({P.RUNS}) AS r ORDER BY metric DESC NULLS LAST, run_id LIMIT 1 OFFSET 1")
def _(t):
    return ordering.best(t.sql(P.RUNS), "metric", k=2, tiebreak=["run_id"])


def hash_sql(key: str, seed: int, buckets: int) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || CAST({key} AS STRING)), 1, 8) AS BIGINT) % {buckets}"


@query(
    "o06_sample_of_keys",
    f"SELECT DISTINCT l_orderkey FROM {{lineitem}} WHERE {hash_sql('l_orderkey', 42, 10000)} < 1000",
)
def _(t):
    return ordering.bernoulli_sample(t.lineitem.select("l_orderkey").distinct(), "l_orderkey", 0.1)


@query(
    "o06_one_sampled_key",
    f"""SELECT l_orderkey FROM (SELECT DISTINCT l_orderkey FROM {{lineitem}}) AS k
        WHERE {hash_sql('l_orderkey', 42, 10000)} < 1000
        ORDER BY {hash_sql('l_orderkey', 43, 10000)}, l_orderkey LIMIT 1""",
)
def _(t):
    return ordering.any_key(t.lineitem, "l_orderkey", 0.1)


@query(
    "o07_one_record_per_class",
    f"""SELECT label, doc_id, probability FROM (SELECT *, row_number() OVER (PARTITION BY label
        ORDER BY {hash_sql('doc_id', 42, 10000)}, doc_id) AS n FROM ({P.SCORED}) AS s) AS x WHERE n = 1""",
)
def _(t):
    return ordering.one_per_class(t.sql(P.SCORED), "label", "doc_id")
