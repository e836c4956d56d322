"""Frequent values and correlations of whole tables against plain counts and the built-in aggregate."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wicketworks.operators.frequent import correlation_matrix, frequent_values


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows hold one value; a long tail, a key, a column of nulls and a dotted name."""
    draw = random.Random(5)
    data = []
    for i in range(6000):
        tail = draw.choice(["hot", draw.choice("abcd"), str(draw.randrange(3000))])
        data.append((tail, i, None, draw.choice([None, "x", "y"])))
    return spark.createDataFrame(data, "tail string, id int, none string, `a.b` string").repartition(5).cache()


def plain(df, k):
    out = []
    for i, c in enumerate(df.columns):
        counts = Counter(None if r[i] is None else str(r[i]) for r in df.collect())
        first = sorted(counts.items(), key=lambda x: (-x[1], x[0] is None, x[0] or ""))[:k]
        out += [(c, v, n, rank) for rank, (v, n) in enumerate(first, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("k, capacity", [(5, 4096), (5, 60), (5, 8), (5, 1), (2, 2), (4000, 100)])
def test_first_values(skewed, k, capacity):
    got = [tuple(r) for r in frequent_values(skewed, k=k, capacity=capacity).collect()]
    assert sorted(got, key=str) == plain(skewed, k)


def test_candidates_are_counted_only_where_counters_were_dropped(skewed):
    """Five values of the tail are proven with 60 counters; its exchange then holds no tail."""
    got = frequent_values(skewed, ["tail"], capacity=60)
    plan = got._jdf.queryExecution().toString()
    assert "LeftSemi" in plan and got.count() == 5
    assert "LeftSemi" not in frequent_values(skewed, ["a.b"], capacity=60)._jdf.queryExecution().toString()


def test_empty_table(spark, skewed):
    assert frequent_values(skewed.where("false")).count() == 0
    got = correlation_matrix(spark.createDataFrame([], "a int, b double")).collect()
    assert [r.corr for r in got] in ([], [None])


def test_correlations_with_nulls_and_large_offsets(spark):
    draw = random.Random(7)
    data = []
    for _ in range(3000):
        x = draw.gauss(0, 1)
        data.append((1e9 + x, x + draw.gauss(0, 1) if draw.random() < 0.7 else None, draw.randrange(5), 3.3, None))
    df = spark.createDataFrame(data, "far double, gaps double, `few.s` int, same double, none double").repartition(4).cache()
    got = {(r[0], r[1]): r[2] for r in correlation_matrix(df).collect()}
    all_rows = df.collect()
    assert len(got) == 10
    for (a, b), value in got.items():
        if {a, b} & {"same", "none"}:
            assert value is None
        else:
            # Extended precision; the built-in aggregate keeps 8 digits of the far column.
            both = [(r[a], r[b]) for r in all_rows if r[a] is not None and r[b] is not None]
            x, y = (np.array([r[i] for r in both], np.longdouble) for i in (0, 1))
            x, y = x - x.mean(), y - y.mean()
            assert value == pytest.approx(float((x * y).sum() / np.sqrt((x * x).sum() * (y * y).sum())), abs=1e-12)
            assert value == pytest.approx(df.agg(F.corr(f"`{a}`", f"`{b}`")).first()[0], abs=1e-7)


def test_no_number_stays_in_its_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.5, 1.0), (3.0, 5.0, 2.0), (float("nan"), 1.0, None)], "a double, b double, c double")
    got = {(r[0], r[1]): r[2] for r in correlation_matrix(df).collect()}
    assert got["a", "c"] == pytest.approx(1.0) and got["b", "c"] == pytest.approx(1.0)
    assert got["a", "b"] is None or got["a", "b"] != got["a", "b"]
