"""Scans, sinks, archives, pages and match info files."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from wicketworks.catalog import proxies as P
from wicketworks.catalog.registry import query
from wicketworks.operators.samples import split_of
from wicketworks.plans.landing import PLAYER_TYPES
from wicketworks.session import scratch_path
from wicketworks.sources import archives, html_tables, match_info, tables


@query(
    "s01_csv_inferred_types",
    """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {customer}""",
)
def _(t):
    path = scratch_path(t.spark, "customer-csv")
    tables.write_csv(t.customer, path)
    read = tables.read_csv(t.spark, path)
    return read.withColumn("c_custkey", F.col("c_custkey").cast("int"))


_RAW = f"({P.DELIVERIES}) AS d"


@query(
    "s02_csv_fixed_schema",
    f"SELECT * FROM {_RAW}",
)
def _(t):
    path = scratch_path(t.spark, "deliveries-csv")
    tables.write_csv(t.sql(P.DELIVERIES), path)
    return tables.read_deliveries(t.spark, path)


_FILES = """SELECT CAST(o_orderkey AS STRING) || '_info.csv' AS file_name FROM {orders}
    UNION ALL SELECT CAST(o_orderkey AS STRING) || '.csv' FROM {orders}
    UNION ALL SELECT CAST(o_orderkey AS STRING) || '_information.txt' FROM {orders}"""


@query(
    "s03_split_files_by_name",
    f"""SELECT file_name, CASE WHEN file_name LIKE '%\\_info.csv' ESCAPE '\\' THEN true ELSE false END AS is_info,
        contains(file_name, 'info') AS is_info_loose FROM ({_FILES}) AS f""",
)
def _(t):
    name = F.col("file_name")
    return t.sql(_FILES).select(
        name, tables.is_info_file(name).alias("is_info"), tables.is_info_file(name, loose=True).alias("is_info_loose")
    )


@query("s04_key_from_file_name", "SELECT CAST(o_orderkey AS STRING) || '_info.csv' AS file_name, o_orderkey AS match_id FROM {orders}")
def _(t):
    files = t.orders.select(F.concat(F.col("o_orderkey").cast("string"), F.lit("_info.csv")).alias("file_name"))
    return files.select("file_name", tables.file_key().alias("match_id"))


def _roster_texts(first, size):
    """The player lines and the registry lines of ``size`` players from number ``first`` on."""
    countries = F.array(*[F.lit(c) for c in P.COUNTRIES])

    def number(i):
        k = (first + i) % 100
        return F.floor(k / 6) * 8 + k % 6

    def lines(make):
        return F.array_join(F.transform(F.sequence(F.lit(1), size), make), "\n")

    def name(i):
        return F.concat(F.lit("Player "), number(i).cast("string"))

    def country(i):
        return F.get(countries, (number(i) % 8).cast("int"))

    def code(i):
        return F.concat(F.lit("id"), number(i).cast("string"))

    return (
        lines(lambda i: F.concat(F.lit("info,player,"), country(i), F.lit(","), name(i))),
        lines(lambda i: F.concat(F.lit("info,registry,people,"), name(i), F.lit(","), code(i))),
    )


def info_texts(t):
    """One info text per order; every tenth customer's match has no winner, every ninth's only 21 players."""
    matches = t.sql(P.OPEN_MATCHES).join(
        t.orders.select(F.col("o_orderkey").alias("match_id"), "o_custkey"), "match_id"
    )
    size = F.when(F.col("o_custkey") % 9 == 0, 21).otherwise(22)
    first = F.col("o_custkey") * 22
    # The rosters repeat: a table of fixed size has those of all customers that are not negative, written out once.
    written = t.spark.range(200).select((F.col("id") % 100).alias("_first"), F.when(F.col("id") < 100, 21).otherwise(22).alias("_size"))
    written = written.select("*", *[x.alias(n) for x, n in zip(_roster_texts(F.col("_first"), F.col("_size")), ("_players", "_people"))])
    listed = (F.when(F.col("o_custkey") >= 0, first % 100) == F.col("_first")) & (size == F.col("_size"))
    matches = matches.join(F.broadcast(written), listed, "left")
    players, people = (F.coalesce(n, x) for n, x in zip(("_players", "_people"), _roster_texts(first, size)))

    text = F.concat_ws(
        "\n",
        F.lit("version,2.2.0"),
        F.lit("info,balls_per_over,6"),
        F.concat(F.lit("info,team,"), "team1"),
        F.concat(F.lit("info, team, "), "team2"),
        F.concat(F.lit("info,gender,"), "gender"),
        F.concat(F.lit("info,season,"), "season"),
        F.concat(F.lit("info,winner,"), "winner"),
        players,
        people,
    )
    file_name = F.concat(F.col("match_id").cast("string"), F.lit("_info.csv"))
    return matches.select(file_name.alias("file_name"), text.alias("text"))


_OPEN = f"({P.OPEN_MATCHES}) AS m"


# Players of the info texts: all that complete rosters list, and 21 of them where the roster is not complete.
_LISTED = P.INFO_ROSTER.replace("WHERE o_custkey % 9 > 0", "WHERE o_custkey % 9 > 0 OR i < 22")


@query(
    "s05_ragged_lines",
    f"""SELECT match_id, 'info' AS type, attribute, value, NULL AS player, NULL AS code FROM (
        SELECT match_id, 'balls_per_over' AS attribute, '6' AS value FROM {_OPEN}
        UNION ALL SELECT match_id, 'team', team1 FROM {_OPEN} UNION ALL SELECT match_id, 'team', team2 FROM {_OPEN}
        UNION ALL SELECT match_id, 'gender', gender FROM {_OPEN} UNION ALL SELECT match_id, 'season', season FROM {_OPEN}
        UNION ALL SELECT match_id, 'winner', winner FROM {_OPEN} WHERE winner IS NOT NULL) AS x
        UNION ALL SELECT match_id, 'version', '2.2.0', NULL, NULL, NULL FROM {_OPEN}
        UNION ALL SELECT match_id, 'info', 'player', country, player, NULL FROM ({_LISTED}) AS l
        UNION ALL SELECT match_id, 'info', 'registry', 'people', player, player_id FROM ({_LISTED}) AS r""",
)
def _(t):
    return match_info.split_text(info_texts(t)).select("match_id", "type", "attribute", "value", "player", "code")


@query(
    "s06_info_to_wide",
    f"""SELECT match_id, team1, team2, gender, season, coalesce(winner, '') AS winner,
        CASE WHEN winner IS NULL THEN 'winner' ELSE '' END AS reject_reason FROM {_OPEN}""",
)
def _(t):
    wide = match_info.wide_texts(info_texts(t))
    return wide.fillna("", subset=["winner", "reject_reason"])


def customer_archives(t):
    """Customers zipped by Spark tasks: one archive per batch, a CSV member per customer and a readme."""

    def pack(batches):
        for batch in batches:
            body = io.BytesIO()
            with zipfile.ZipFile(body, "w") as archive:
                archive.writestr("readme.txt", "not a table")
                for key, name, segment in zip(batch["c_custkey"], batch["c_name"], batch["c_mktsegment"]):
                    archive.writestr(f"nested/{segment}/{key}.csv", name)
            yield pd.DataFrame({"path": [f"{batch['c_custkey'].iloc[0]}.zip"], "content": [body.getvalue()]})

    chosen = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return chosen.mapInPandas(pack, "path STRING, content BINARY")


@query(
    "s07_unpack_archives",
    "SELECT CAST(c_custkey AS STRING) || '.csv' AS file_name, c_name AS text FROM {customer}",
)
def _(t):
    return archives.unpack_archives(customer_archives(t)).select("file_name", "text")


def stored_archives(t):
    """The customers' archives as files of the shared folder, a broken one among them; returns the folder."""
    folder = scratch_path(t.spark, "archives")

    def store(batches):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                for name, body in ((path, bytes(content)), (f"broken-{path}", bytes(content)[: len(content) // 2])):
                    with system.open_output_stream(f"{root}/{name}") as out:
                        out.write(body)
                    yield pd.DataFrame({"name": [name]})

    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    customer_archives(t).mapInPandas(store, "name STRING").count()
    return folder


@query(
    "s07_read_archive_files",
    "SELECT CAST(c_custkey AS STRING) || '.csv' AS file_name, c_name AS text FROM {customer}",
)
def _(t):
    return archives.read_archives(t.spark, stored_archives(t))[0].select("file_name", "text")


def _row(cells):
    parts = [F.concat(F.lit("<td>"), c.cast("string"), F.lit("</td>")) for c in cells]
    return F.concat(F.lit("<tr>"), *parts, F.lit("<td></td></tr>"))


_HEAD = "<tr><th>Key</th><th>Name</th><th>Size</th><th></th></tr>"
_BEFORE = (
    "<html><body><table><tr><td>menu</td></tr></table><p>text</p>"
    "<table><tr><td>filter</td></tr></table><table><thead>" + _HEAD + "</thead><tbody>"
)
_AFTER = "</tbody></table></body></html>"


def _render(rows):
    """(page, stat_type, key, name, size) to one page of three tables; a page holds 200 parts at most."""
    line = F.struct("key", _row([F.col("key"), F.col("name"), F.col("size")]).alias("html"))
    packed = rows.groupBy("page", "stat_type").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    body = F.array_join(F.transform("lines", lambda x: x["html"]), "")
    return packed.select("page", "stat_type", F.concat(F.lit(_BEFORE), body, F.lit(_AFTER)).alias("html"))


def _parts(t):
    return t.part.select(
        (F.floor(F.col("p_partkey") / 200) + 1).alias("page"),
        F.element_at(F.array(*[F.lit(k) for k in PLAYER_TYPES]), (F.col("p_partkey") % 3 + 1).cast("int")).alias("stat_type"),
        F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_size").alias("size"),
    )


@query(
    "s08_html_tables",
    """SELECT CAST(p_partkey AS STRING) AS "Key", p_name AS "Name", CAST(p_size AS STRING) AS "Size" FROM {part}""",
)
def _(t):
    rows = html_tables.extract_tables(_render(_parts(t)))
    return html_tables.table_columns(rows.where(F.col("row_no").isNotNull()), ["Key", "Name", "Size"]).select(
        "Key", "Name", "Size"
    )


@query(
    "s08_html_tables_with_spans",
    """SELECT CAST(p_partkey AS STRING) AS "Key", p_name AS "Name", CASE WHEN p_size % 2 = 0 THEN p_name ELSE CAST(p_size AS STRING) END AS "Size"
       FROM {part}
       UNION ALL SELECT CAST(p_partkey AS STRING), 'second', CAST(p_size + 1 AS STRING) FROM {part}""",
)
def _(t):
    """A head of plain cells, a name over two columns where the size is even, a key over two rows."""
    name, size = F.col("name"), F.col("size")
    wide = F.when(size % 2 == 0, F.concat(F.lit('<td colspan="2">'), name, F.lit("</td>"))).otherwise(
        F.concat(F.lit("<td>"), name, F.lit("</td><td>"), size.cast("string"), F.lit("</td>"))
    )
    lines = F.concat(
        F.lit("<tr><td rowspan=2>"), F.col("key").cast("string"), F.lit("</td>"), wide, F.lit("</tr><tr><td>second</td><td>"),
        (size + 1).cast("string"), F.lit("</td></tr>"),
    )
    packed = _parts(t).groupBy("page", "stat_type").agg(F.array_join(F.collect_list(lines), "").alias("body"))
    start = _BEFORE.replace("<th>", "<td>").replace("</th>", "</td>")
    pages = packed.select("page", "stat_type", F.concat(F.lit(start), "body", F.lit(_AFTER)).alias("html"))
    rows = html_tables.extract_tables(pages).where("row_no IS NOT NULL")
    return html_tables.table_columns(rows, ["Key", "Name", "Size"]).select("Key", "Name", "Size")


def _team_pages(t):
    """All parts on consecutive pages, then a page with one row, then a copy of the first page."""
    parts = _parts(t).withColumn("stat_type", F.lit("team"))
    full = _render(parts)
    last = parts.agg(F.max("page")).scalar()
    stop = _render(parts.where(F.col("key") == 0)).withColumn("page", last + 1)
    beyond = _render(parts.where(F.col("page") == 1)).withColumn("page", last + 2)
    return full.unionByName(stop).unionByName(beyond)


@query(
    "s09_stop_at_first_empty_page",
    """SELECT CAST(p_partkey AS STRING) AS "Key", p_name AS "Name" FROM {part}""",
)
def _(t):
    rows = html_tables.before_first_empty_page(html_tables.extract_tables(_team_pages(t)))
    return html_tables.table_columns(rows, ["Key", "Name"]).select("Key", "Name")


@query(
    "s10_skip_types_after_empty_one",
    """SELECT CAST(p_partkey AS STRING) AS "Key", CASE p_partkey % 3 WHEN 0 THEN 'batting' WHEN 1 THEN 'bowling'
       ELSE 'fielding' END AS stat_type FROM {part}
       WHERE NOT (CAST(floor(p_partkey / 200) AS BIGINT) % 4 = 3 AND p_partkey % 3 > 0)""",
)
def _(t):
    # On every fourth page the bowling table shrinks to its header row, so fielding is skipped too.
    pages = _render(_parts(t))
    emptied = F.when(
        (F.col("stat_type") == "bowling") & ((F.col("page") - 1) % 4 == 3), F.lit(_BEFORE + _AFTER)
    ).otherwise(F.col("html"))
    rows = html_tables.extract_tables(pages.withColumn("html", emptied))
    kept = html_tables.scraped_rows(rows, PLAYER_TYPES)
    return html_tables.table_columns(kept, ["Key"]).select("Key", "stat_type")


@query(
    "s11_drop_unnamed_column",
    """SELECT CAST(p_partkey AS STRING) AS "Key", CAST(p_size AS STRING) AS "Size" FROM {part}""",
)
def _(t):
    rows = html_tables.extract_tables(_render(_parts(t)))
    cells = html_tables.table_columns(rows.where(F.col("row_no").isNotNull()), ["Key", "Size", "Unnamed: 3"])
    return html_tables.drop_unnamed(html_tables.drop_unnamed(cells, "Unnamed: 3"), "Unnamed: 15").select("Key", "Size")


@query("s12_land_only_new", """SELECT CAST(o_orderkey AS STRING) || '.csv' AS file_name, o_custkey FROM {orders} WHERE o_orderstatus <> 'F'""")
def _(t):
    name = F.concat(F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_name")
    landed = t.orders.where("o_orderstatus = 'F'").select(name)
    return tables.not_landed(t.orders.select(name, "o_custkey"), landed)


@query("s13_csv_sink_and_source", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM {supplier}")
def _(t):
    path = scratch_path(t.spark, "supplier-csv")
    tables.write_csv(t.supplier, path)
    return tables.read_csv(t.spark, path, "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE")


@query("s14_parallel_csv_export", "SELECT CAST(o_orderkey AS STRING) AS o_orderkey, o_orderstatus FROM {orders}")
def _(t):
    path = scratch_path(t.spark, "orders-export")
    tables.write_csv(t.orders.select("o_orderkey", "o_orderstatus"), path, rows_per_file=5000)
    return tables.read_text_columns(t.spark, path)


@query("s15_layer_tables", "SELECT p_partkey, p_brand, p_retailprice FROM {part}")
def _(t):
    path = tables.layer_path(scratch_path(t.spark, "base"), "processed", "parts")
    return tables.write_table(t.part.select("p_partkey", "p_brand", "p_retailprice"), path)


def _splits(t):
    return t.documents.select("doc_id", "lang", split_of("doc_id").alias("split"))


def split_sql(key: str, seed: int = 42) -> str:
    draw = f"CAST('0x' || substr(md5('{seed}:' || CAST({key} AS STRING)), 1, 8) AS BIGINT) % 100"
    return f"CASE WHEN {draw} < 80 THEN 'train' WHEN {draw} < 90 THEN 'val' ELSE 'test' END"


@query("s16_sample_sink", f"SELECT doc_id, lang, {split_sql('doc_id')} AS split FROM {{documents}}")
def _(t):
    path = scratch_path(t.spark, "samples")
    tables.write_samples(_splits(t), path)
    return tables.read_samples(t.spark, path)


@query("s17_sample_source_one_split", f"SELECT doc_id, lang FROM {{documents}} WHERE {split_sql('doc_id')} = 'train'")
def _(t):
    path = scratch_path(t.spark, "samples")
    tables.write_samples(_splits(t), path)
    return tables.read_samples(t.spark, path, "train").select("doc_id", "lang")
