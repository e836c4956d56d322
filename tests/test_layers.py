"""Stored layers: bucketed tables meet without an exchange, watches refuse, reopened layers are the same."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wicketworks.operators import skew
from wicketworks.operators.skew import BOUNDED, group_limit, split_hot
from wicketworks.plans import merge, modeling
from wicketworks.sources.layers import Watch, open_bucketed, store, write_bucketed, write_layer


def balls_of(spark, matches, each):
    df = spark.range(matches * each).select((F.col("id") % matches).alias("match_id"), F.col("id").alias("n"))
    kinds = {"innings": F.lit(1) + F.col("n") % 2, "ball": F.col("n") / 10}
    more = {c: (F.col("n") % 7).cast("double") for c in merge.BALL_COLUMNS if c not in ("match_id", "innings", "ball")}
    return df.select("match_id", *[e.alias(c) for c, e in {**kinds, **more}.items()]).select(*merge.BALL_COLUMNS)


def keyed(spark, first, last, each=1):
    return spark.range(first, last).select(F.col("id").alias("match_id"), (F.col("id") * 2.0).alias("x")).crossJoin(spark.range(each).drop("id"))


def exchanges(df):
    return re.findall(r"\bExchange (?!.*Broadcast)", df._jdf.queryExecution().executedPlan().toString())


def test_merged_layers_meet_without_an_exchange(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        teams, balls, players = (
            write_bucketed(df, f"{tmp_path}/{name}", ["match_id"], order)
            for name, df, order in (
                ("teams", keyed(spark, 5, 60), []),
                ("balls", balls_of(spark, 50, 12), ["innings", "ball"]),
                ("players", keyed(spark, 0, 40, 22), []),
            )
        )
        assert (balls.rows, balls.group_rows) == (600, BOUNDED)
        common = merge.common_matches(teams.frame, balls.frame, players.frame, co_located=True)
        assert [exchanges(t) for t in common] == [[], [], []]
        want = merge.common_matches(keyed(spark, 5, 60), balls_of(spark, 50, 12), keyed(spark, 0, 40, 22))
        assert [rows(t) for t in common] == [rows(t) for t in want]
        samples = modeling.match_samples(balls.frame, teams.frame, players.frame, group_rows=balls.group_rows)
        assert exchanges(samples) == []
        plain = modeling.match_samples(balls_of(spark, 50, 12), keyed(spark, 5, 60), keyed(spark, 0, 40, 22))
        assert rows(samples) == rows(plain) and samples.count() == 35
        # What the filter gives lies in its buckets still, and is written there without another exchange.
        again = write_bucketed(common[1], f"{tmp_path}/filtered", ["match_id"], ["innings", "ball"], in_place=True)
        files = [r[0] for r in spark.read.parquet(f"{tmp_path}/filtered").select(F.input_file_name()).distinct().collect()]
        assert len(files) <= 8 and rows(again.frame) == rows(common[1])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_another_session_opens_a_layer(spark, tmp_path):
    made = write_bucketed(keyed(spark, 0, 100), f"{tmp_path}/it's a layer", ["match_id"], ["x"], buckets=4)
    other = open_bucketed(spark.newSession(), f"{tmp_path}/it's a layer")
    assert other.rows == 100 and rows(other.frame) == rows(made.frame)
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {re.search('layer_[0-9a-f]+', made.frame._jdf.queryExecution().logical().toString())[0]}").collect()}
    assert described["Num Buckets"] == "4" and described["Bucket Columns"] == "[`match_id`]"


def test_an_overlarge_match_leaves_its_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(skew, "GROUP_ROWS", 200)
    df = keyed(spark, 0, 30, 5).unionByName(keyed(spark, 7, 8, 400))
    made = write_bucketed(df, f"{tmp_path}/hot", ["match_id"], spread=4)
    assert made.group_rows == 200 and made.rows == 550
    assert "Bucketed: true" not in made.frame._jdf.queryExecution().executedPlan().toString()
    bounded, hot = split_hot(made.frame, ["match_id"], made.group_rows)
    assert bounded.count() == 145 and hot.count() == 405
    assert rows(made.frame) == rows(df)


def test_a_watch_counts_in_the_pass_that_writes(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, None)], "k int, `odd name` string")
    watch = Watch("input", ["k", "odd name"])
    spark.sparkContext.setJobGroup("watch", "watch")
    layer = write_layer(watch.over(df).where("k > 1"), f"{tmp_path}/t", [watch])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("watch")) == 1
    assert (watch.rows, watch.null_counts(), layer.rows) == (3, {"k": 1, "odd name": 2}, 1)


@pytest.mark.parametrize("bucketed", [False, True])
def test_an_empty_table_is_refused_and_the_earlier_one_stays(spark, tmp_path, bucketed):
    path = f"{tmp_path}/t"

    def write(df):
        watch = Watch("balls")
        if bucketed:
            return write_bucketed(watch.over(df), path, ["match_id"], guards=[watch])
        return write_layer(watch.over(df), path, [watch])

    first = rows(write(keyed(spark, 0, 5)).frame)
    with pytest.raises(ValueError, match="balls: no rows"):
        write(keyed(spark, 0, 5).where("x < 0"))
    assert rows(spark.read.parquet(path)) == first
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    second = write(keyed(spark, 5, 9)).frame
    assert second.count() == 4 == spark.read.parquet(path).count()


def test_known_sizes_need_no_look(spark):
    df = store(spark.range(50).select((F.col("id") % 3).alias("k")), "sizes").frame
    assert group_limit(df, ["k"], rows=50) == BOUNDED
    assert group_limit(df, ["k"], group_rows=16) == 16 and group_limit(df, ["k"], group_rows=17) == BOUNDED
    assert split_hot(df, ["k"], BOUNDED) == (df, None)


def test_a_fitted_model_scores_after_rows_were_observed(spark):
    from wicketworks.operators import modeling as models

    df = spark.range(40).select((F.col("id") % 2).cast("double").alias("a"), (F.col("id") % 4 > 1).cast("int").alias("label"))
    watch = Watch("rows")
    store(watch.over(df), "observed", [watch])
    assert watch.rows == 40
    assert models.score(models.baseline_classifier(["a"]).fit(df), df, ["label"]).count() == 40
    assert len(models.score(models.baseline_classifier(["a"]).fit(df), df, ["label"]).collect()) == 40


def test_padding_reads_stored_samples(spark):
    from wicketworks.catalog import QUERIES

    padded = QUERIES["m05_padded_batches"](spark, "/root/testdata/sf0.001")
    assert len(exchanges(padded)) <= 6
