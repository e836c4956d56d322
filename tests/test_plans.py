"""Match semantics on small tables worked out by hand, with every quirk as its own case."""

import io
import uuid
import zipfile

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from wicketworks import schemas
from wicketworks.plans import batch, landing, match_files, merge, season_stats
from wicketworks.sources.archives import unpack_archives
from wicketworks.sources.html_tables import extract_tables, scraped_rows, table_columns
from wicketworks.sources.match_info import read_match_info, split_text, wide_matches
from wicketworks.sources.tables import read_deliveries
from wicketworks.streaming.landing import land_new_deliveries


def delivery(match, innings, ball, side, other, runs=0, **more):
    base = dict.fromkeys([c.split()[0] for c in schemas.DELIVERIES.split(", ")])
    base.update(match_id=match, season="2020", innings=innings, ball=ball, batting_team=side, bowling_team=other)
    base.update({"striker": "s", "bowler": "b", "runs_off_bat": runs, "extras": 0, **more})
    return tuple(base.values())


@pytest.fixture(scope="module")
def deliveries(spark):
    data = [
        delivery(1, 1, 0.1, "A", "B", 4),
        delivery(1, 1, 0.1, "A", "B", 1),
        delivery(1, 1, 19.6, "A", "B", 0, extras=1, wides=1),
        delivery(1, 2, 1.1, "B", "A", 2, noballs="1", player_dismissed="x", other_player_dismissed="y"),
        delivery(1, 2, 2.1, "B", "A", 6, penalty="5"),
        delivery(1, 3, 0.1, "B", "A", 3),
        delivery(2, 1, 0.1, "C", "A", 1, wicket_type="bowled", player_dismissed="z"),
        delivery(3, 1, 0.1, "C", "A", 1),
    ]
    return spark.createDataFrame(data, schemas.DELIVERIES)


@pytest.fixture(scope="module")
def matches(spark):
    data = [(1, "A", "B", "male", "2020", "B"), (2, "C", "A", "female", "2020", "C")]
    return spark.createDataFrame(data, schemas.MATCHES)


def test_clean_deliveries(deliveries):
    cleaned = match_files.clean_deliveries(deliveries)
    got = rows(cleaned, "match_id", "innings", "ball", "wides", "noballs", "penalty", "player_dismissed", "wicket_type")
    assert (1, 2, 1.1, 0, 1, 0, 1, 0) in got
    assert (2, 1, 0.1, 0, 0, 0, 1, 1) in got
    assert match_files.clean_deliveries(deliveries, narrow=True).columns == match_files.NARROW
    with pytest.raises(ValueError):
        match_files.clean_deliveries(deliveries.drop("innings"))
    with pytest.raises(ValueError):
        match_files.clean_deliveries(deliveries.where("false"))


@pytest.mark.parametrize("group_rows", [None, 2])
def test_ball_by_ball(deliveries, matches, group_rows):
    balls = merge.ball_by_ball(match_files.clean_deliveries(deliveries), matches, group_rows=group_rows)
    got = rows(balls, "match_id", "innings", "ball", "runs", "curr_score", "curr_wickets", "target", "won")
    assert got == sorted(
        [
            # Tied balls share their running total; extras are counted again with the wides.
            (1, 1, 0.1, 4, 5, 0, 0, 0), (1, 1, 0.1, 1, 5, 0, 0, 0), (1, 1, 19.6, 2, 7, 0, 0, 0),
            (1, 2, 1.1, 3, 3, 2, 7, 1), (1, 2, 2.1, 11, 14, 2, 7, 1),
            # Innings beyond the second keep the target.
            (1, 3, 0.1, 3, 3, 0, 7, 1),
            (2, 1, 0.1, 1, 1, 1, 0, 1),
        ],
        key=repr,
    )
    rates = {(r["innings"], r["ball"]): r for r in balls.where("match_id = 1").collect()}
    assert rates[(1, 19.6)]["overs"] == 19 and rates[(1, 19.6)]["run_rate"] == 7 / 19
    assert rates[(1, 0.1)]["run_rate"] == 0.0
    assert rates[(2, 2.1)]["required_run_rate"] == (7 - 14) / 18


@pytest.mark.parametrize("group_rows", [None, 2])
def test_chasing_variant(deliveries, matches, group_rows):
    balls = merge.ball_by_ball(
        match_files.clean_deliveries(deliveries), matches, merge.PLAIN_RUN_COLUMNS, "chasing", 1, group_rows
    )
    got = rows(balls, "match_id", "innings", "ball", "runs", "target", "won")
    assert (1, 1, 19.6, 1, 0, 1) in got and (1, 2, 2.1, 11, 7, 1) in got and (2, 1, 0.1, 1, 0, 0) in got


def test_one_exchange_for_a_bounded_match(deliveries):
    balls = match_files.clean_deliveries(deliveries).select(
        "match_id", "innings", "ball", F.col("runs_off_bat").alias("runs"), F.col("player_dismissed").alias("wickets")
    )
    plan = merge.score_balls(balls)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_batting_quirks(spark):
    columns = "Player STRING, Season STRING, Mat INT, Inns STRING, Runs STRING, SR STRING, Ave STRING"
    data = [
        ("P One (IND)", "2018", 5, "4", "100", "120.5", "25.0"),
        ("P One (IND)", "2019", 3, "-", "-", "-", "-"),
        ("P One (IND)", "2019/20", 2, "2", "30", "90.0", "-"),
        ("P One (IND)", "2021", 1, "1", "1", "10.0", "1.0"),
        ("P Two (ICC/PAK)", "2018", 1, "1", "1", "1.0", "1.0"),
        ("No Country", "2018", 1, "1", "1", "1.0", "1.0"),
        ("P Three (SWZ) [7]", "2018", 1, "1", "9", "1.0", "9.0"),
        ("P Three (SWA) [8]", "2019", 1, "1", "1", "1.0", "1.0"),
    ]
    raw = spark.createDataFrame(data, columns)
    for group_rows in (None, 2):
        got = rows(season_stats.batting(raw, group_rows=group_rows))
        assert got == sorted(
            [
                ("P One", "India", "2018", 0, 0, 0, 0.0, 0.0),
                ("P One", "India", "2019", 5, 4, 100, 25.0, 120.5),
                ("P One", "India", "2019/20", 8, 4, 100, 25.0, 120.5),
                # 2019/20: the missing average is 30 / 2.
                ("P One", "India", "2021", 10, 6, 130, 21.67, 110.33),
                # Two codes of one country stay two careers.
                ("P Three", "Eswatini", "2018", 0, 0, 0, 0.0, 0.0),
                ("P Three", "Eswatini", "2019", 0, 0, 0, 0.0, 0.0),
            ],
            key=repr,
        )


def test_bowling_weights_by_innings_and_adds_overs_as_decimals(spark):
    columns = "Player STRING, Season STRING, Mat INT, Inns STRING, Overs STRING, Mdns STRING, Runs STRING, Wkts STRING, Econ STRING"
    data = [
        ("B (AUS)", "1", 2, "2", "3.4", "1", "20", "2", "6.0"),
        ("B (AUS)", "2", 2, "1", "3.4", "0", "10", "1", "9.0"),
        ("B (AUS)", "3", 1, "0", "-", "-", "-", "-", "-"),
        ("B (AUS)", "4", None, "1", "1", "0", "1", "0", "1"),
    ]
    got = rows(season_stats.bowling(spark.createDataFrame(data, columns), maidens=True))
    assert got[2] == ("B", "Australia", "3", 4, 3.0, 6.8, 1.0, 30.0, 3.0, 7.0)
    assert got[3] == ("B", "Australia", "4", 5, 3.0, 6.8, 1.0, 30.0, 3.0, 7.0)


def test_team_gates(spark):
    columns = "Team STRING, Season STRING, Mat INT, Won INT, Lost INT, Tied INT, NR INT, Ave STRING, RPO STRING, LS INT"
    data = [
        ("A", "1", 2, 0, 2, 0, 0, "20.0", "7.0", 1),
        ("A", "2", 2, 2, 0, 0, 1, "-", "-", 1),
        ("A", "3", 4, 1, 1, 0, 0, "30.0", "8.0", 1),
        ("W", "1", 3, 3, 0, 0, 0, "40.0", "9.0", 1),
        ("W", "2", 3, 3, 0, 0, 0, "40.0", "9.0", 1),
    ]
    got = rows(season_stats.teams(spark.createDataFrame(data, columns)))
    assert got == [
        ("A", "1", 0, 0, 0, 0.0, 0.0, 0.0),
        ("A", "2", 0, 2, 0, 0.0, 0.0, 7.0),
        ("A", "3", 2, 2, 0, 1.0, 10.0, 3.5),
        ("W", "1", 0, 0, 0, 0.0, 0.0, 0.0),
        ("W", "2", 3, 0, 0, 0.0, 40.0, 0.0),
    ]


def test_match_teams_names(spark):
    columns = 'Team STRING, Season STRING, `Cumulative Won` INT, `Cumulative Lost` INT, `Cumulative Tied` INT, `Cumulative W/L` DOUBLE, `Cumulative AveRPW` DOUBLE, `Cumulative AveRPO` DOUBLE'
    teams = spark.createDataFrame(
        [(n, "2020", i, 0, 0, 0.0, 0.0, 0.0) for i, n in enumerate(["A", "B", "U.S.A.", "Never"])], columns
    )
    data = [
        (1, "A", "B", "male", "2020", "A"), (2, "B", "A", None, "2020", "B"),
        (3, "A", "Never", "male", "2020", "A"), (4, "United States of America", "A", "female", "2020", "United States of America"),
        (5, "A", "B", "male", "2020", None), (6, "A", "B", "male", "1999", "A"),
    ]
    matches = spark.createDataFrame(data, schemas.MATCHES)
    plain = merge.match_teams(matches, teams)
    assert rows(plain, "match_id", "gender", "Cumulative Won team1", "Cumulative Won team2") == [
        (1, 0, 0, 1), (2, 1, 1, 0), (5, 0, 0, 1),
    ]
    mapped = merge.match_teams(matches, teams, map_before_filter=True)
    assert [r[0] for r in rows(mapped, "match_id")] == [1, 2, 4, 5]


def info_text(players=22, winner=True, season="2016/17", same_name=False, player="Player"):
    lines = ["version,2.2.0", "info,balls_per_over,6", "info,team,Alpha", "info, team, Beta", "info,gender,male"]
    lines += [f"info,season,{season}"] + (["info,winner,Beta"] if winner else [])
    names = [f"{player} {i}" for i in range(players)]
    if same_name:
        names[1] = names[0]
    lines += [f"info,player,{'Alpha' if i < 11 else 'Beta'},{n}" for i, n in enumerate(names)]
    lines += [f"info,registry,people,{n},id{i}" for i, n in enumerate(names)]
    return "\n".join(lines) + "\n"


def test_matches_and_rosters(spark):
    files = [
        ("10_info.csv", info_text()), ("11_info.csv", info_text(winner=False)), ("12_info.csv", info_text(21)),
        ("13_info.csv", info_text(same_name=True)), ("14_info.csv", info_text(season="2018")),
        ("15_info.csv", 'info,team,"Gamma, United"\r\ninfo,gender,male\r\n'),
    ]
    lines = split_text(spark.createDataFrame(files, "file_name STRING, text STRING"))
    found = match_files.matches_from_info(lines)
    assert (10, "Alpha", "Beta", "male", "2016/17", "Beta") in rows(found.accepted)
    assert rows(found.rejected, "match_id", "reject_reason") == [(11, "winner"), (15, "teams")]
    assert rows(wide_matches(lines).where("match_id = 15"), "team1") == [("Gamma, United",)]
    rosters = match_files.rosters_from_info(lines)
    assert {r[0] for r in rows(rosters.match_players, "match_id")} == {10, 11, 14}
    assert rosters.match_players.count() == 66
    # Two players of one name give four pairs, so 24 in all.
    assert (13, 24) in rows(rosters.rejected, "match_id", "roster_size")
    assert (12, 21) in rows(rosters.rejected, "match_id", "roster_size")
    assert rosters.players.count() == 22
    assert {r[0] for r in rows(rosters.players, "season")} == {"2016/17"}
    assert match_files.distinct_players(rosters.match_players, by_season=False).count() == 22


def test_match_players_full_roster_option(spark):
    roster = spark.createDataFrame(
        [(f"P{i}", "X", "2020", m, f"id{i}") for m in (1, 2) for i in range(22)],
        "player STRING, country STRING, season STRING, match_id LONG, player_id STRING",
    ).where("NOT (match_id = 2 AND player = 'P3')")
    stats = spark.createDataFrame([(f"P{i}", "X", "2020", i) for i in range(22)], "Player STRING, Country STRING, Season STRING, m INT")
    assert merge.match_players(roster, stats).count() == 43
    assert {r[0] for r in rows(merge.match_players(roster, stats, require_full_roster=True), "match_id")} == {1}


def test_common_matches_share_one_key_set(spark):
    def table(*ids):
        return spark.createDataFrame([(i, float(i)) for i in ids], "match_id LONG, x DOUBLE")

    balls = table(1, 2, 2, 4).select("match_id", *[F.lit(1).alias(c) for c in merge.BALL_COLUMNS[1:]])
    for stored in (False, True):
        parts = merge.common_matches(table(1, 2, 3), balls, table(2, 4, 1), materialize_keys=stored)
        assert [sorted(r[0] for r in p.select("match_id").collect()) for p in parts] == [[1, 2], [1, 2, 2], [1, 2]]
    assert "overs" not in merge.common_matches(table(1), balls, table(1), with_overs=False)[1].columns


def csv_lines(header, data):
    return header + "\n" + "\n".join(",".join("" if v is None else str(v) for v in row) for row in data) + "\n"


@pytest.fixture(scope="module")
def raw_base(tmp_path_factory):
    """A raw layer of real files: two accepted matches, one without a winner."""
    base = tmp_path_factory.mktemp("raw")
    files = base / "1_rawData" / "t20s_csv2"
    files.mkdir(parents=True)
    header = ",".join(c.split()[0] for c in schemas.DELIVERIES.split(", "))
    for match in (1, 2, 3):
        (files / f"{match}_info.csv").write_text(info_text(winner=match != 3, season="2020"))
        balls = [delivery(match, i, o + 0.1, *(("Alpha", "Beta") if i == 1 else ("Beta", "Alpha")), o) for i in (1, 2) for o in range(5)]
        (files / f"{match}.csv").write_text(csv_lines(header, balls))
    players = [f"Player {i} ({c})" for i in range(22) for c in ("IND",)]
    tables = {
        "batting": ("Player,Season,Mat,Inns,Runs,SR,Ave,Unused", lambda p, s: (p, s, 2, 2, 30, 100.0, "-", "x")),
        "bowling": ("Player,Season,Mat,Inns,Overs,Mdns,Runs,Wkts,Econ", lambda p, s: (p, s, 2, 1, 4.0, 0, 20, 1, 5.0)),
        "fielding": ("Player,Season,Mat,Inns,Dis,Ct,St,D/I", lambda p, s: (p, s, 2, 2, 1, 1, 0, "-")),
    }
    for kind, (columns, make) in tables.items():
        data = [make(p, s) for p in players for s in ("2019", "2020")]
        (base / "1_rawData" / batch.RAW_STATS[kind]).write_text(csv_lines(columns, data))
    team = [(t, s, 4, 2, 1, 1, 0, 25.5, 7.5, 1) for t in ("Alpha", "Beta") for s in ("2019", "2020")]
    (base / "1_rawData" / batch.RAW_STATS["team"]).write_text(
        csv_lines("Team,Season,Mat,Won,Lost,Tied,NR,Ave,RPO,LS", team)
    )
    return str(base)


def test_files_are_split_by_name(spark, raw_base):
    files = f"{raw_base}/1_rawData/t20s_csv2"
    assert read_deliveries(spark, files).count() == 30
    lines = read_match_info(spark, files)
    teams = wide_matches(lines).orderBy("match_id").collect()
    assert [(r["match_id"], r["team1"], r["team2"]) for r in teams] == [(i, "Alpha", "Beta") for i in (1, 2, 3)]


def test_whole_batch_from_files(spark, raw_base):
    lines = read_match_info(spark, f"{raw_base}/1_rawData/t20s_csv2")
    # Rosters name sides, statistics name countries: line them up for this fixture.
    raw = batch.read_raw(spark, raw_base)
    renamed = lines.withColumn("value", F.when(F.col("attribute") == "player", "India").otherwise(F.col("value")))
    done = batch.process(raw._replace(info_lines=renamed), raw_base)
    # Only Beta ever wins, so no team pair survives: names must win somewhere to take part.
    assert done["team12_stats"].count() == 0
    winners = renamed.withColumn(
        "value",
        F.when((F.col("attribute") == "winner") & (F.col("match_id") == 2), "Alpha").otherwise(F.col("value")),
    )
    done = batch.process(raw._replace(info_lines=winners), raw_base)
    assert rows(done["team12_stats"], "match_id", "Cumulative Won team1") == [(1, 2), (2, 2)]
    assert done["players_stats"].count() == 44
    assert done["ball_to_ball"].count() == 20
    again = spark.read.parquet(f"{raw_base}/4_filteredData/ball_to_ball")
    assert rows(again.agg(F.max("curr_score"))) == [(10,)]


def test_stream_lands_each_file_once(spark, raw_base, tmp_path):
    source, landed = f"{raw_base}/1_rawData/t20s_csv2", str(tmp_path / "landed")
    # The stream's log outlives a test run, so each run needs a name of its own.
    name = uuid.uuid4().hex
    for _ in range(2):
        land_new_deliveries(spark, source, landed, name).awaitTermination()
        assert spark.read.parquet(landed).count() == 30


def test_archives(spark):
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as archive:
        archive.writestr("a/b/1.csv", "x,1\n")
        archive.writestr("2_info.csv", "info,é\n")
        archive.writestr("readme.txt", "no")
    archives = spark.createDataFrame([("z.zip", body.getvalue())], "path STRING, content BINARY")
    assert rows(unpack_archives(archives), "file_name", "text") == [("1.csv", "x,1\n"), ("2_info.csv", "info,é\n")]
    landed = spark.createDataFrame([("1.csv",)], "file_name STRING")
    assert rows(landing.new_match_files(archives, landed), "file_name") == [("2_info.csv",)]


def html(n, head="<tr><th>Player</th><th></th></tr>", tables=3):
    filler = "<table><tr><td>x</td></tr></table>"
    body = "".join(f"<tr><td>P &amp; {i}</td><td>-</td></tr>" for i in range(n))
    return filler * (tables - 1) + f"<table>{head}{body}</table>"


def test_pages(spark):
    types = ["batting", "bowling", "fielding"]
    pages = [(p, t, html(2)) for p in (1, 2, 3, 5) for t in types if (p, t) != (2, "bowling")]
    pages += [(2, "bowling", html(1)), *[(4, t, html(0)) for t in types], (6, "batting", html(5, tables=2))]
    table = extract_tables(spark.createDataFrame(pages, "page LONG, stat_type STRING, html STRING"))
    kept = scraped_rows(table, types)
    assert rows(kept.groupBy("page", "stat_type").count()) == sorted(
        [(1, t, 2) for t in types] + [(2, "batting", 2)] + [(3, t, 2) for t in types], key=repr
    )
    named = table_columns(kept, ["Player", "Unnamed: 1", "Absent"])
    assert named.where("page = 3 AND stat_type = 'batting'").orderBy("row_no").first()["Player"] == "P & 0"
    assert named.where("Absent IS NOT NULL").count() == 0 and named.where("`Unnamed: 1` = '-'").count() == 14


def test_spans_and_heads_of_html_tables():
    from wicketworks.sources.html_tables import _parse

    def only(body):
        return _parse(f"<table>{body}</table>")[0]

    head = "<tr><th>A</th><th>B</th><th>C</th></tr>"
    assert only(head + "<tr><td colspan=2>x</td><td>y</td></tr>") == (["A", "B", "C"], [["x", "x", "y"]])
    assert only("<thead><tr><td>A</td><td></td></tr></thead><tr><td>1</td></tr>") == (["A", "Unnamed: 1"], [["1"]])
    assert only(head + "<tr><td rowspan=3>x</td><td>1</td></tr><tr><td>2</td></tr><tr><td>3</td><td>4</td></tr><tr><td>5</td></tr>")[1] == [
        ["x", "1"], ["x", "2"], ["x", "3", "4"], ["5"],
    ]
    assert only(head + "<tr><td>1</td><td rowspan='2' colspan=2>x</td></tr><tr><td>2</td></tr>")[1] == [["1", "x", "x"], ["2", "x", "x"]]
    assert only(head + "<tr><td colspan=none>1</td><td rowspan=0>2</td></tr>")[1] == [["1", "2"]]


def test_broken_archives_and_members_are_rejected(spark, tmp_path):
    import zipfile

    from wicketworks.sources.archives import read_archives

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("x/one.csv", "1")
        archive.writestr("two.csv", b"\xff\xfe")
        archive.writestr("three.txt", "no table")
    (tmp_path / "b.zip").write_bytes(b"not an archive")
    with zipfile.ZipFile(tmp_path / "c.zip", "w"):
        pass
    read, rejected = read_archives(spark, f"file://{tmp_path}")
    assert rows(read, "file_name", "text") == [("one.csv", "1")]
    assert sorted((r["archive"].rsplit("/", 1)[1], r["file_name"]) for r in rejected.collect()) == [("a.zip", "two.csv"), ("b.zip", None)]


def test_settings_are_merged_and_intermediates_released(spark, monkeypatch):
    from wicketworks import session

    merged = session.merged_settings({"spark.sql.shuffle.partitions": "3", "spark.sql.session.timeZone": "CET"})
    assert merged == {**session.SESSION_DEFAULTS, "spark.sql.shuffle.partitions": "3", "spark.sql.session.timeZone": "CET"}
    monkeypatch.setattr(session, "_SCRATCH", [])
    session.materialize(spark.range(3).toDF("i"))
    unused = session.scratch_path(spark, "unused")
    kept = list(session._SCRATCH)
    assert kept[1] == unused and session.release(spark) == 1 and session._SCRATCH == []
    jvm = spark.sparkContext._jvm
    assert not jvm.java.io.File(kept[0].removeprefix("file:")).exists()


def test_members_are_handed_on_in_frames_of_bounded_size(spark):
    """Many small members share a frame, large ones do not pile up, and every member is there once."""
    from wicketworks.sources.archives import FRAME_CHARS, FRAME_ROWS, _frames, _members

    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as archive:
        for i in range(2 * FRAME_ROWS + 1):
            archive.writestr(f"{i}.csv", str(i))
    batch = pd.DataFrame({"path": ["z.zip"], "content": [body.getvalue()]})
    frames = list(_frames(_members([batch]), ["archive", "file_name", "text"]))
    assert [len(f) for f in frames] == [FRAME_ROWS, FRAME_ROWS, 1]
    large = [("a", f"{i}.csv", "x" * (FRAME_CHARS // 2), None) for i in range(5)] + [("a", "6.csv", None, "broken")]
    assert [len(f) for f in _frames(iter(large), ["archive", "file_name", "text", "reason"])] == [2, 2, 2]
    made = unpack_archives(spark.createDataFrame([("z.zip", body.getvalue())], "path STRING, content BINARY"))
    assert made.count() == 2 * FRAME_ROWS + 1


def test_wide_texts_are_wide_matches_read_once(spark):
    from wicketworks.sources.match_info import wide_texts

    whole = 'version,2\ninfo,team,A\ninfo, team, "B, the others"\ninfo,gender,male\ninfo,season,2020\ninfo,season,2021\ninfo,winner,A'
    texts = [
        ("1_info.csv", whole.replace("\n", "\r\n")),
        ("2_info.csv", whole.replace("info,winner,A", "info,\"winner\",\"A\"")),
        ("3_info.csv", "\nversion,2\ninfo,player,A,x"),  # blank first line, no attribute
        ("4_info.csv", " \r\n  \n"),  # nothing but blank lines
        ("5_info.csv", ""),
        ("6_info.csv", None),
        ("7_info.csv", "info,team,A"),
        ("7_info.csv", "version,2\ninfo,team,B\ninfo,gender,female\ninfo,season,2020"),  # one match in two files
        ("none.csv", whole),
        ("8_info.csv", "info,toss,season\ninfo,player,winner,gender\ninfo,season,,x\ninfo,winner,"),
    ]
    files = spark.createDataFrame(texts, "file_name STRING, text STRING")
    made = wide_texts(files)
    assert rows(made) == rows(wide_matches(split_text(files)))
    assert {r.match_id for r in made.collect()} == {1, 2, 3, 7, 8, None}
    assert made._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_written_rosters_of_info_texts(spark, tmp_path):
    """Customers of any number, and none, have the roster lines that their number gives."""
    from wicketworks.catalog.registry import Tables
    from wicketworks.catalog.sources import info_texts

    keys = [0, 1, 9, 49, 50, 51, 99, 100, 14999, -1, -7, None]
    orders = spark.createDataFrame([(i, k, "F", "2020-01-01") for i, k in enumerate(keys)], "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, d STRING")
    orders.selectExpr("o_orderkey", "o_custkey", "o_orderstatus", "1.0D AS o_totalprice", "CAST(d AS TIMESTAMP_NTZ) AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    made = {r.file_name: r.text.split("\n") for r in info_texts(Tables(spark, str(tmp_path))).collect()}
    assert len(made) == len(keys)
    for i, key in enumerate(keys):
        lines = made[f"{i}_info.csv"]
        ids = [x.rsplit(",id", 1)[1] for x in lines if x.startswith("info,registry")]
        if key is None or key < 0:
            continue
        drawn = [(key * 22 + j) % 100 for j in range(1, 22 if key % 9 == 0 else 23)]
        assert ids == [str(k // 6 * 8 + k % 6) for k in drawn]
        assert [x.rsplit(" ", 1)[1] for x in lines if x.startswith("info,player")] == ids


def test_rosters_meet_in_one_exchange_and_pair_as_joins_do(spark):
    from wicketworks.session import materialize

    def text(players, people, more="info,season,2020"):
        return "\n".join([more, *[f"info,player,{c},{p}" for c, p in players], *[f"info,registry,people,{p},{i}" for p, i in people]])

    full = [("X", f"p{i}") for i in range(22)]
    ids = [(f"p{i}", f"id{i}") for i in range(22)]
    texts = [
        ("1_info.csv", text(full, [*ids, ("umpire", "u"), ("umpire", "v")])),
        ("2_info.csv", text(full[:21], ids)),
        ("3_info.csv", text(full[:20], [*ids[:20], ("p19", "other"), ("p19", "")])),  # 19 players, and one with three ids
        ("4_info.csv", text(full, ids, "info,gender,male")),
        ("5_info.csv", text([*full[:20], ("Y", "p0"), ("", "p1")], ids)),  # two players listed twice
        ("6_info.csv", text(full, ids, "info,season,2021\ninfo,season,2020")),
        ("7_info.csv", text(full, ids)),
        ("7_info.csv", text(full, ids)),
        ("8_info.csv", "version,2"),
        ("none.csv", text(full, ids)),
    ]
    lines = materialize(split_text(spark.createDataFrame(texts, "file_name STRING, text STRING")), "lines")
    made, divided = (match_files.rosters_from_info(lines, group_rows=limit) for limit in (None, 0))
    assert rows(made.match_players) == rows(divided.match_players)
    assert {r.match_id: r["count"] for r in made.match_players.groupBy("match_id").count().collect()} == {1: 22, 3: 22, 5: 22, 6: 22}
    assert {(r.player, r.player_id) for r in made.match_players.where("match_id = 3 AND player = 'p19'").collect()} == {("p19", "id19"), ("p19", "other"), ("p19", None)}
    assert {r.season for r in made.match_players.where("match_id = 6").collect()} == {"2021"}
    assert rows(made.rejected, "match_id", "roster_size") == [(2, 21), (4, 22), (7, 88), (8, 0), (None, 0)]
    plan = made.match_players._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange ") == 1 and plan.count("FileScan") == 1
