"""Batches of an epoch: every place once, another order in every epoch, no sort of samples."""

import pytest
from pyspark.sql import functions as F

from wicketworks.operators.samples import epoch_batches


@pytest.mark.parametrize("sizes", [{"train": 1000, "val": 1, "test": 2, None: 17}, {}])
def test_each_sample_once_in_every_epoch(spark, sizes):
    data = [(s, i) for s, n in sizes.items() for i in range(n)]
    samples = spark.createDataFrame(data, "split string, number bigint")
    orders = []
    for epoch in (0, 1):
        got = epoch_batches(samples, 16, epoch).collect()
        for split, n in sizes.items():
            own = [r for r in got if r.split == split]
            assert sorted(r.place for r in own) == list(range(n))
            assert all(r.batch_id == r.place // 16 for r in own)
        orders.append({(r.split, r.number): r.place for r in got})
    if sizes:
        same = sum(orders[0][x] == orders[1][x] for x in orders[0] if x[0] == "train")
        assert same < 20
        # Neighbours by number do not stay neighbours.
        near = sum(abs(orders[0]["train", i] - orders[0]["train", i + 1]) < 16 for i in range(999))
        assert near < 100


def test_epochs_are_the_same_again_and_exchange_no_samples(spark):
    samples = spark.range(500).select(F.lit("train").alias("split"), F.col("id").alias("number"))
    first, again = (epoch_batches(samples, 7, 3, seed=s) for s in (1, 1))
    assert sorted(first.collect()) == sorted(again.collect())
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan


def test_points_of_rounds_are_drawn_once_an_epoch(spark):
    """A sample reckons one hash a round; the points are the same for all samples of an epoch."""
    samples = spark.range(500).select(F.lit("train").alias("split"), F.col("id").alias("number"), (F.col("id") % 2).alias("epoch"))
    plan = epoch_batches(samples, 7, F.col("epoch"))._jdf.queryExecution().analyzed().toString()
    steps = [line for line in plan.splitlines() if "aggregate(" in line and "AS place" in line]
    assert len(steps) == 1 and steps[0].count("md5(") == 1 and "conv(" not in steps[0]


def test_two_epochs_are_dealt_over_tasks(spark, tmp_path):
    """Nearly all samples are in one split, and numbering leaves them in one task."""
    from wicketworks.catalog import QUERIES

    spark.range(40_000).withColumnRenamed("id", "o_orderkey").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        got = QUERIES["m05_batches_of_two_epochs"](spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", before)
    tasks = [sum(r.task == x for r in got) for x in {r.task for r in got}]
    assert len(got) == 80_000 and len(tasks) > 3 and max(tasks) < 40_000
    for epoch in (0, 1):
        places = sorted(r.place for r in got if r.epoch == epoch and r.split == "train")
        assert places == list(range(len(places)))
