"""Samples, metrics, selection, profiles and scoring."""

import math
import random

import pytest
from conftest import rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from wicketworks.operators import aggregates, metrics, modeling, ordering, profile, samples
from wicketworks.plans.modeling import select_run


@pytest.fixture(scope="module")
def balls(spark):
    data = [(m, i, m * 100 + i, m % 2) for m, n in ((1, 5), (2, 12), (3, 1)) for i in range(n)]
    return spark.createDataFrame(data, "m INT, o INT, x INT, won INT")


def build(spark, balls, **options):
    teams = spark.createDataFrame([(1, 1.5, 0), (2, 2.5, 1), (3, 3.5, 0), (9, 9.0, 0)], "m INT, a DOUBLE, b INT")
    players = spark.createDataFrame([(m, p) for m in (1, 2, 3, 8) for p in range(3)], "m INT, p INT")
    return samples.build_samples(
        balls, teams, players, "m", ["o"], ["o", "x"], ["a", "b"], ["p"], ["p"], "won", **options
    )


@pytest.mark.parametrize("group_rows", [None, 3])
@pytest.mark.parametrize("chunk_rows", [4096, 4])
def test_samples_are_whole_in_any_chunking(spark, balls, chunk_rows, group_rows):
    done = build(spark, balls, chunk_rows=chunk_rows, group_rows=group_rows)
    assert rows(done.where("chunk = 0"), "m", "label", "n_balls", "team") == [
        (1, 1, 4, [1.5, 0.0]), (2, 0, 11, [2.5, 1.0]), (3, 1, 0, [3.5, 0.0]),
    ]
    exploded = samples.explode_rows(done, ["m"], "balls", ["o", "x"])
    want = [(m, i, float(i), float(m * 100 + i)) for m, n in ((1, 4), (2, 11)) for i in range(n)]
    assert rows(exploded) == sorted(want, key=repr)
    assert done.agg(F.sum(F.size("players"))).first()[0] == 9
    assert max(len(r["balls"]) for r in done.collect()) <= chunk_rows
    staged = samples.augment(done, [1, 2], unit=5)
    assert rows(staged.groupBy("m", "window").agg(F.sum(F.size("balls")))) == [
        (1, 1, 4), (1, 2, 4), (2, 1, 5), (2, 2, 10), (3, 1, 0), (3, 2, 0),
    ]
    assert staged.where("chunk = 0").count() == 6


@pytest.mark.parametrize("chunk_rows", [4096, 4, 2])
def test_shapes_batches_and_padding_in_any_chunking(spark, balls, chunk_rows):
    done = build(spark, balls, chunk_rows=chunk_rows)
    assert rows(samples.input_shapes(done, ["m"])) == [(2, 3, 1, 2)]
    batched = samples.assign_batches(done.withColumn("split", F.lit("train")), ["m"], 2)
    assert rows(batched.select("m", "batch_id").distinct()) == [(1, 0), (2, 0), (3, 1)]
    padded = samples.pad_batches(batched, "balls", 2, ["m"]).orderBy("m", "chunk").collect()
    whole = {}
    for r in padded:
        so_far = whole.setdefault((r["m"], r["batch_id"]), [])
        assert len(r["balls"]) <= chunk_rows
        assert not r["balls"] or r["start"] == len(so_far)  # a chunk may hold players alone
        so_far += r["balls"]
    assert {k: len(v) for k, v in whole.items()} == {(1, 0): 11, (2, 0): 11, (3, 1): 0}
    assert whole[1, 0][4:] == [[0.0, 0.0]] * 7 and whole[1, 0][3] == [3.0, 103.0]


def test_drop_last_is_exact_with_ties(spark):
    df = spark.createDataFrame([(1, 0, i) for i in range(4)] + [(2, 0, 9)], "k INT, o INT, x INT")
    for group_rows in (None, 2):
        counts = aggregates.drop_last_rows(df, ["k"], ["o"], 1, group_rows).groupBy("k").count()
        assert rows(counts) == [(1, 3)]


@pytest.mark.parametrize("group_rows", [None, 10])
def test_exact_split_sizes(spark, group_rows):
    keys = spark.range(103).withColumnRenamed("id", "k")
    split = samples.split_exact(keys, "k", group_rows=group_rows)
    assert rows(split.groupBy("split").count()) == [("test", 11), ("train", 82), ("val", 10)]
    assert rows(split) == rows(samples.split_exact(keys.repartition(5), "k"))


@pytest.fixture(scope="module")
def scored(spark):
    draw = random.Random(3)
    data = [(i, int(draw.random() < 0.4), draw.randrange(21) / 20) for i in range(400)]
    return spark.createDataFrame(data, "id INT, label INT, probability DOUBLE")


@pytest.mark.parametrize("group_rows", [None, 5])
def test_auc_with_ties(scored, group_rows):
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="label")
    want = evaluator.evaluate(scored.withColumn("label", F.col("label").cast("double")))
    assert metrics.area_under_curve(scored, group_rows=group_rows).first()[0] == pytest.approx(want, abs=1e-12)
    roc = metrics.roc_points(scored, group_rows=group_rows).orderBy(F.desc_nulls_first("threshold")).collect()
    assert len(roc) == 22 and (roc[0]["fpr"], roc[0]["tpr"]) == (0.0, 0.0) and (roc[-1]["fpr"], roc[-1]["tpr"]) == (1.0, 1.0)
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(roc, roc[1:]))
    assert area == pytest.approx(want, abs=1e-12)


def test_threshold_is_strict_and_empty_denominators_give_zero(spark):
    df = metrics.predict(spark.createDataFrame([(1, 0.5), (0, 0.2)], "label INT, probability DOUBLE"))
    assert rows(df, "prediction") == [(0,), (0,)]
    assert rows(metrics.binary_scores(df)) == [(0.5, 0.0, 0.0, 0.0)]
    assert sum(r["n"] for r in metrics.confusion_matrix(df).collect()) == 2
    assert rows(metrics.confusion_matrix(df.where("false")), "n") == [(0,)] * 4


def test_staged_scores_use_all_when_fewer(scored):
    table = metrics.metrics_table(metrics.predict(scored), ["id"], windows=[1, 50, 100])
    found = {r["stage"]: r for r in table.collect()}
    assert set(found) == {"1 overs", "50 overs", "100 overs", "Overall"}
    assert found["100 overs"]["accuracy"] == found["Overall"]["accuracy"]


def test_cross_entropy_floor_and_batches(spark):
    df = spark.createDataFrame([(1, 1.0, 0), (1, 0.0, 0), (0, 0.5, 1)], "label INT, probability DOUBLE, b INT")
    half = -math.log(0.5)
    assert metrics.cross_entropy(df).first()[0] == pytest.approx((100 + half) / 3)
    assert metrics.cross_entropy(df, batch=["b"]).first()[0] == pytest.approx((50 + half) / 2)


@pytest.mark.parametrize("group_rows", [None, 4])
def test_early_stop(spark, group_rows):
    losses = [5.0, 4.0, 4.0, 6.0, 3.5, 3.6, 3.7, 3.8, 1.0]
    history = spark.createDataFrame(list(enumerate(losses)), "epoch INT, val_loss DOUBLE")
    marked = metrics.training_history(history, group_rows=group_rows)
    assert [r[1] for r in rows(marked, "epoch", "since_best")] == [0, 0, 1, 2, 0, 1, 2, 3, 0]
    assert rows(metrics.early_stop(history, patience=3, group_rows=group_rows)) == [(7, 4, 3.5)]
    assert rows(metrics.early_stop(history, patience=9, group_rows=group_rows)) == [(8, 8, 1.0)]
    two = history.withColumn("run", F.explode(F.array(F.lit("a"), F.lit("b"))))
    assert rows(metrics.early_stop(two, keys=["run"], patience=3, group_rows=group_rows)) == [("a", 7, 4, 3.5), ("b", 7, 4, 3.5)]


def test_best_runs(spark):
    runs = spark.createDataFrame([(1, 0.5), (2, None), (3, 0.9), (4, 0.9)], "run_id INT, m DOUBLE")
    assert rows(select_run(runs, "m"), "run_id") == [(3,)]
    assert rows(select_run(runs, "m", k=2), "run_id") == [(4,)]
    assert rows(select_run(runs, "m", maximize=False), "run_id") == [(1,)]
    assert rows(select_run(runs, "m", k=4), "run_id") == [(2,)]
    assert rows(select_run(runs, "m", k=5), "run_id") == []


def test_sampling_is_reproducible(spark):
    df = spark.range(2000).withColumn("label", F.col("id") % 2)
    drawn = ordering.bernoulli_sample(df, "id", 0.1)
    assert 120 < drawn.count() < 280
    assert rows(drawn) == rows(ordering.bernoulli_sample(df.repartition(7), "id", 0.1))
    assert rows(ordering.one_per_class(df, "label", "id"), "label") == [(0,), (1,)]
    assert ordering.any_key(df, "id", 0.1).count() == 1


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, float("nan")), (2, "a", 3.0), (2, "a", 3.0)], "i INT, s STRING, d DOUBLE")
    for exact in (True, False):
        found = {r["column"]: r for r in profile.column_profile(df, exact_distinct=exact).collect()}
        assert (found["i"]["n"], found["i"]["n_distinct"], found["i"]["median"]) == (4, 2, 2.0)
        assert (found["s"]["missing"], found["s"]["min_value"], found["s"]["mean"]) == (1, "a", None)
    assert rows(aggregates.null_counts(df)) == [(0, 1, 1)]
    assert rows(aggregates.null_counts(df, count_nan=False)) == [(0, 1, 0)]
    assert rows(aggregates.total_nulls(df)) == [(1,)]
    assert rows(profile.duplicate_rows(df), "i", "copies") == [(2, 2)]
    assert rows(profile.top_values(df, ["i", "s"], 1), "column", "value", "n") == [("i", "2", 3), ("s", "a", 3)]
    assert profile.correlations(df, ["i", "i"]).first()["corr"] == pytest.approx(1.0)


def test_flatten_is_independent_of_chunking(spark, balls):
    flat = [
        rows(modeling.flatten_samples(build(spark, balls, chunk_rows=c), "m", 2, 1, 2)) for c in (4096, 4)
    ]
    assert flat[0] == flat[1]
    assert flat[0][0] == (1, 1, 1.5, 0.0, 1.0, 1.5, 101.5)


def test_classifier_and_search(spark):
    draw = random.Random(5)
    data = [(i, float(x := draw.random()), draw.random(), int(x > 0.5)) for i in range(300)]
    df = spark.createDataFrame(data, "id INT, a DOUBLE, b DOUBLE, label INT")
    model = modeling.baseline_classifier(["a", "b"]).fit(df)
    done = metrics.predict(modeling.score(model, df, ["id", "label"]))
    assert metrics.accuracy_percent(done).first()[0] > 95
    split = df.withColumn("split", F.when(F.col("id") % 3 == 0, "val").otherwise("train"))
    search = modeling.parameter_search(split, ["a", "b"], trials=3, parallelism=2)
    assert [x.trial for x in search] == [0, 1, 2] and search[0].params["regParam"] == 0
    assert search == modeling.parameter_search(split.repartition(3), ["a", "b"], trials=3, parallelism=1) or all(
        abs(x.val_loss - y.val_loss) < 1e-6 for x, y in zip(search, modeling.parameter_search(split.repartition(3), ["a", "b"], trials=3))
    )


def test_saved_model_scores_the_same(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i % 4 == 1), int(i % 8 < 3)) for i in range(80)], "id INT, a DOUBLE, label INT")
    model = modeling.baseline_classifier(["a"], weightCol="weight").fit(modeling.weighted(df, ["a"]))
    again = modeling.load_model(modeling.save_model(model, f"file://{tmp_path}/model"))
    assert rows(modeling.score(model, df, ["id"])) == rows(modeling.score(again, df, ["id"]))


def test_quartiles_of_many_steps_are_exact_without_a_large_sketch(spark, monkeypatch):
    """Ranks as in a sorted list, whatever the brackets: ties, nulls, NaN, large integers, empty columns."""
    import math
    import random

    draw = random.Random(3)
    nan, inf = float("nan"), float("inf")
    columns = [
        [draw.gauss(0, 1e6) for _ in range(3000)],
        [draw.choice([1.0, 2.0, 7.0, None]) for _ in range(3000)],
        [draw.choice([nan, inf, -inf, 0.0, -0.0, 3.5]) for _ in range(3000)],
        [None] * 3000,
        [5.0] * 2999 + [None],
    ]
    df = spark.createDataFrame(list(zip(*columns, range(2**40, 2**40 + 3000))), "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, `e.f` DOUBLE, g LONG")
    df = df.repartition(7).withColumn("text", F.lit("x"))
    shares = [0.0, 0.25, 0.5, 0.75, 1.0]
    ordered = [sorted((float(x) for x in c if x is not None), key=lambda x: (math.isnan(x), x)) for c in [*columns, range(2**40, 2**40 + 3000)]]
    wanted = [[c[max(1, math.ceil(p * len(c))) - 1] for p in shares] if c else [None] * 5 for c in ordered]
    names = ["a", "b", "c", "d", "e.f", "g"]
    for steps in (profile.SKETCH_STEPS, 20):  # the second sketch is too coarse for its brackets to be narrow
        found = profile.exact_quantiles(df, names, shares, steps)
        assert repr([found[n] for n in names]).replace("-0.0", "0.0") == repr(wanted).replace("-0.0", "0.0")
    tables = {}
    monkeypatch.setattr(profile, "SKETCH_STEPS", 1000)
    for accuracy in (1000, 5_000_000):
        made = profile.column_profile(df.drop("c"), exact_distinct=True, accuracy=accuracy)
        tables[accuracy] = {r["column"]: (r.q1, r.median, r.q3) for r in made.collect()}
        assert ("percentile_approx" in made._jdf.queryExecution().analyzed().toString()) == (accuracy == 1000)
    assert tables[5_000_000] == {n: tuple(w[1:4]) for n, w in zip(names, wanted) if n != "c"} | {"text": (None, None, None)}
    assert profile.column_profile(df.limit(0), accuracy=5_000_000).count() == 7


def test_brackets_that_miss_are_widened(spark):
    """A rank outside its bracket is never taken for one inside."""
    df = spark.range(100).select(F.col("id").cast("double").alias("c0"))
    found = {"x": [None, None, None]}
    left = profile._select(df, [(0, 0, 10, 20.0, 30.0), (0, 1, 26, 20.0, 30.0), (0, 2, 90, 20.0, 30.0)], found, ["x"])
    assert left == [(0, 0, 10), (0, 2, 90)] and found == {"x": [None, 25.0, None]}
