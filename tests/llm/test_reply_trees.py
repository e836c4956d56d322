"""Reply trees against plain walks, and formatted conversations against the texts they were made of."""

import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.edge import clashing
from wicketworks.llm import reply_trees
from wicketworks.llm.queries import ORACLES, QUERIES
from wicketworks.llm.reply_trees import CHAT, escaped, format_chains, format_trees, read_back, unescaped

POSTS = "id long, parent long, role string, text string, score double"
TURNS = "conv_id long, turn long, role string, text string"
ODD = st.lists(st.sampled_from([*CHAT.controls, "\\", "\n", "<", "[", "a", "😀", "é", "s>", "<<", "%", "+", "user"]), max_size=12).map("".join)


@settings(max_examples=20, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=40))
def test_escaping_is_reversible_and_leaves_no_control_string(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", escaped(F.col("text")).alias("e"))
    for text, e, back in df.select("text", "e", unescaped(F.col("e"))).collect():
        assert back == text
        assert not any(c in e for c in CHAT.controls)


def walk(posts):
    """Every branch by plain recursion: (score, leaf id, [(role, text), ...]) per root."""
    by_id = {p[0]: p for p in posts if p[0] is not None}
    parents = {p[1] for p in posts}
    found = {}
    for p in posts:
        if p[0] in parents and p[0] is not None:
            continue
        path, here = [p], p
        while here[1] is not None and here[1] in by_id:
            here = by_id[here[1]]
            if here in path:
                break
            path.append(here)
        else:
            scores = [0.0 if x[4] is None or x[4] != x[4] else x[4] for x in path]
            turns = [(x[2] or "", x[3] or "") for x in reversed(path)]
            found.setdefault(path[-1][0], []).append((sum(scores) / len(scores), p[0], turns))
    return {root: sorted(b, key=lambda x: (-x[0], x[1])) for root, b in found.items()}


def check_trees(spark, posts, best):
    got = read_back(format_trees(spark.createDataFrame(posts, POSTS), best=best)).collect()
    want = {(root, i + 1): b for root, bs in walk(posts).items() for i, b in enumerate(bs[:best])}
    assert {(r.id, r["rank"]): [tuple(t) for t in r.turns] for r in got} == {k: b[2] for k, b in want.items()}
    for r in got:
        assert r.score == pytest.approx(want[r.id, r["rank"]][0]) and r.n_turns == len(r.turns)
        assert list(r.loss_texts) == [t for role, t in want[r.id, r["rank"]][2] if role == "assistant"]


def test_random_trees(spark):
    rnd = random.Random(3)
    posts = []
    for i in range(200):
        parent = rnd.choice([None, *range(i)]) if rnd.random() < 0.9 else 10_000 + i
        posts.append((i, parent, rnd.choice(["user", "assistant", None]), rnd.choice(["x", None, "</s>", "\\ä"]) , rnd.choice([None, 1.0, 2.0, float("nan"), -3.5])))
    check_trees(spark, posts, 1)
    check_trees(spark, posts, 3)


def test_deep_path_wide_post_and_circles(spark):
    path = [(i, i - 1 if i else None, "assistant" if i % 2 else "user", f"t{i}", float(i)) for i in range(300)]
    star = [(1000 + i, 1000 if i else None, "assistant", f"s{i}", float(i % 7)) for i in range(200)]
    circle = [(5000, 5001, "user", "a", 1.0), (5001, 5000, "user", "b", 1.0), (5002, 5001, "assistant", "c", 1.0), (5003, 5003, "user", "d", 1.0)]
    check_trees(spark, path + star + circle, 4)


def test_ids_that_are_null_or_repeated_and_an_empty_table(spark):
    posts = [(1, None, "user", "q", 1.0), (2, 1, "assistant", "a", 1.0), (2, 1, "assistant", "a", 1.0), (3, 2, "user", "more", 5.0), (None, 1, "assistant", "n", 2.0)]
    rows = read_back(format_trees(spark.createDataFrame(posts, POSTS), best=9)).collect()
    assert sorted([t.text for t in r.turns] for r in rows) == [["q", "a"], ["q", "a", "more"], ["q", "n"]]
    assert format_trees(spark.createDataFrame([], POSTS)).count() == 0


def test_chains_of_edge_rows(spark):
    rows = [(1, 0, "user", "x" * 50_000), (1, 2, "assistant", None), (1, 2, "assistant", "é" * 9000), (2, None, None, "first"), (2, 0, "a\nb<s>", "second"),
            (None, 1, "user", "u"), (None, 2, "assistant", "v"), (3, 5, "assistant", ""), (3, 5, "assistant", "")]
    want = {1: 3, 2: 2, None: 2, 3: 2}
    base = spark.createDataFrame(rows, TURNS)
    extra = base.selectExpr("*", "'n' AS node", "1 AS up", "2 AS leaf", "3 AS length", "4 AS head", "5 AS kept", "6 AS chain", "7 AS n", "8 AS _node", "9 AS score", "10 AS hash")
    for df in (base, extra):
        got = {r.conv_id: r for r in read_back(format_chains(df, "conv_id", "turn")).collect()}
        assert {k: r.n_turns for k, r in got.items()} == want
        assert [tuple(t) for t in got[2].turns] == [("", "first"), ("a\nb<s>", "second")]
        assert sorted(got[1].loss_texts) == ["", "é" * 9000] and got[1].turns[0].text == "x" * 50_000
        assert [t.text for t in got[None].turns] == ["u", "v"] and list(got[None].loss_texts) == ["v"]
    assert format_chains(base.limit(0), "conv_id", "turn").count() == 0


def test_a_conversation_above_the_rows_of_a_task(spark, monkeypatch):
    from wicketworks.operators import skew

    monkeypatch.setattr(skew, "GROUP_ROWS", 100)
    rows = [(7, i, "assistant" if i % 2 else "user", f"</s>{i}") for i in range(1500)] + [(8, 0, "user", "a")]
    random.Random(1).shuffle(rows)
    got = {r.conv_id: r for r in read_back(format_chains(spark.createDataFrame(rows, TURNS).repartition(6), "conv_id", "turn")).collect()}
    assert [t.text for t in got[7].turns] == [f"</s>{i}" for i in range(1500)]
    assert list(got[7].loss_texts) == [f"</s>{i}" for i in range(1, 1500, 2)]


def test_the_main_path_has_no_python(spark, tmp_path):
    source = open(reply_trees.__file__).read()
    assert "udf" not in source and "InArrow" not in source and "InPandas" not in source and ".rdd" not in source


def test_query_against_sql(spark, tmp_path):
    rows = [(1, 0, "user", "[INST]\\<s>"), (1, 1, "assistant", "<<SYS>> ünd\n<|im_end|>"), (2, 0, None, None), (2, None, "assistant", "😀"), (5, 1, "system", "b"), (5, 1, "system", "a")]
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op11_reply_trees"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    cursor = con.execute(ORACLES["op11_reply_trees"])
    names = [d[0] for d in cursor.description]
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(cursor.fetchall())
    assert clashing(got.selectExpr("conv_id AS doc_id")).count() == 4
