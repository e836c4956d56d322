"""Running values: hot groups give the same result as bounded ones."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wicketworks.operators import windows
from wicketworks.operators.skew import split_hot
from wicketworks.operators.windows import Ratio, Running, Weighted

KINDS = ["sum", "count", "min", "max", "last"]


@pytest.fixture(scope="module")
def table(spark):
    """One key holds a third of all rows, one key is null, values are missing, rows repeat."""
    draw = random.Random(7)
    data = []
    for i in range(240):
        key = "hot" if i % 3 == 0 else None if i % 11 == 0 else f"k{draw.randrange(12)}"
        value = None if draw.random() < 0.2 else draw.randrange(100)
        data.append((key, draw.randrange(25), i, value))
    data += [("hot", 5, 10_000, 7)] * 20
    return spark.createDataFrame(data, "k STRING, o INT, id INT, v INT")


def brute(data, keys, order, kind, frame, inclusive):
    """One value per row, by looking at every other row of its key."""
    out = []
    ordered = sorted(data, key=lambda r: tuple((r[c] is not None, r[c]) for c in order))
    for i, row in enumerate(ordered):
        same = [j for j, r in enumerate(ordered) if all(r[c] == row[c] for c in keys)]
        if frame == "range":
            seen = [ordered[j] for j in same if [ordered[j][c] for c in order] <= [row[c] for c in order]]
        else:
            seen = [ordered[j] for j in same if j <= i - (0 if inclusive else 1)]
        known = [r["v"] for r in seen if r["v"] is not None]
        value = {
            "sum": lambda: sum(known) if known else None,
            "count": lambda: len(seen),
            "min": lambda: min(known, default=None),
            "max": lambda: max(known, default=None),
            "last": lambda: known[-1] if known else None,
        }[kind]()
        out.append((row["k"], row["o"], row["id"], row["v"], value))
    return sorted(out, key=repr)


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("group_rows", [None, 30])
@pytest.mark.parametrize("keys", [["k"], []])
def test_rows_frame(table, keys, group_rows, inclusive):
    data = table.collect()
    measures = [Running(kind, "v", kind) for kind in KINDS]
    got = windows.running(table, keys, ["o", "id", "v"], measures, inclusive=inclusive, group_rows=group_rows)
    got = got.collect()
    for kind in KINDS:
        mine = sorted(((r["k"], r["o"], r["id"], r["v"], r[kind]) for r in got), key=repr)
        assert mine == brute(data, keys, ["o", "id", "v"], kind, "rows", inclusive), kind


@pytest.mark.parametrize("group_rows", [None, 30])
@pytest.mark.parametrize("keys", [["k"], []])
def test_range_frame(table, keys, group_rows):
    data = table.collect()
    kinds = ["sum", "count", "min", "max"]
    measures = [Running(kind, "v", kind) for kind in kinds]
    got = windows.running(table, keys, ["o"], measures, frame="range", group_rows=group_rows).collect()
    for kind in kinds:
        mine = sorted(((r["k"], r["o"], r["id"], r["v"], r[kind]) for r in got), key=repr)
        assert mine == brute(data, keys, ["o"], kind, "range", True), kind


def test_split_hot_is_null_safe(table):
    bounded, hot = split_hot(table, ["k"], 30)
    assert {r["k"] for r in hot.select("k").distinct().collect()} == {"hot"}
    assert bounded.count() + hot.count() == table.count()
    assert bounded.where("k IS NULL").count() == table.where("k IS NULL").count() > 0
    assert split_hot(table, ["k"], 10_000)[1] is None


def test_attach_group(table):
    aggregates = {"n": F.count(F.lit(1)), "best": F.max("v")}
    plain = windows.attach_group(table, ["k"], aggregates)
    assert rows(plain) == rows(windows.attach_group(table, ["k"], aggregates, group_rows=20))


def test_exclusive_cumulative_by_hand(spark):
    data = [("a", 1, 10, 2, 0), ("a", 2, 20, 1, 0), ("a", 3, 30, 4, 1), ("b", 1, 5, 0, 0), ("b", 2, 6, 0, 0)]
    df = spark.createDataFrame(data, "k STRING, s INT, v INT, w INT, g INT")
    for group_rows in (None, 2):
        done = windows.exclusive_cumulative(
            df, ["k"], ["s"], {"sum": "v"},
            {"mean": Weighted("v", "w"), "gated": Weighted("v", "w", gate="g")}, {"ratio": Ratio("v", "w")},
            group_rows=group_rows,
        )
        assert rows(done, "k", "s", "sum", "mean", "gated", "ratio") == [
            ("a", 1, 0, 0.0, 0.0, 0.0),
            ("a", 2, 10, 10.0, 0.0, 5.0),
            ("a", 3, 30, 13.33, 0.0, 10.0),
            ("b", 1, 0, 0.0, 0.0, 0.0),
            ("b", 2, 5, 0.0, 0.0, 0.0),
        ]


def test_all_earlier_values_null_stay_null(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 3)], "k STRING, s INT, v INT")
    done = windows.exclusive_cumulative(df, ["k"], ["s"], {"sum": "v"})
    assert rows(done, "s", "sum") == [(1, 0), (2, None)]


def test_forward_fill_and_running_max(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5), (1, 3, None), (1, 4, 2)], "k INT, o INT, v INT")
    for group_rows in (None, 2):
        assert rows(windows.forward_fill(df, ["k"], ["o"], "v", group_rows=group_rows), "o", "v") == [
            (1, None), (2, 5), (3, 5), (4, 2),
        ]
        assert rows(windows.running_max(df, ["k"], ["o"], "v", "m", group_rows), "o", "m") == [
            (1, None), (2, 5), (3, 5), (4, 5),
        ]


def test_range_frame_must_be_inclusive(table):
    with pytest.raises(ValueError):
        windows.running(table, ["k"], ["o"], [Running("sum", "v", "s")], "range", inclusive=False)
