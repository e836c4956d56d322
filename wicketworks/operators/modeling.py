"""Baseline win-probability classifier, parameter search and batch scoring."""

from __future__ import annotations

import random
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketworks.session import materialize


def flatten_samples(
    samples: DataFrame, key: str, team_width: int, player_width: int, ball_width: int
) -> DataFrame:
    """Fixed-width features of a sample: team vector, mean of each player and ball column.

    Sums are taken inside each chunk and combined per key with map-side combine.
    """
    keep = [key, *[c for c in ("split", "window") if c in samples.columns]]
    widths = {"players": player_width, "balls": ball_width}

    def chunk_sum(array: str, i: int):
        return F.aggregate(array, F.lit(0.0), lambda acc, row: acc + F.coalesce(row[i], F.lit(0.0)))

    chunks = samples.select(
        *keep, "label", "team",
        *[chunk_sum(a, i).alias(f"_{a}_{i}") for a, w in widths.items() for i in range(w)],
        *[F.size(a).alias(f"_n_{a}") for a in widths],
    )

    def mean(array: str, i: int):
        share = F.try_divide(F.sum(f"_{array}_{i}"), F.sum(f"_n_{array}").cast("double"))
        return F.coalesce(share, F.lit(0.0)).alias(f"{array}_{i}")

    return chunks.groupBy(*keep).agg(
        F.max("label").alias("label"),
        *[F.max(F.try_element_at("team", F.lit(i + 1))).alias(f"team_{i}") for i in range(team_width)],
        *[mean(a, i) for a, w in widths.items() for i in range(w)],
    )


class _Classifier(Pipeline):
    """A pipeline whose fitted classifier forgets its training summary.

    The summary holds the session, and a session that has counted rows with an observation cannot be shipped to tasks; a
    model that is sent out to score must not carry it.
    """

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        model = super()._fit(dataset)
        model.stages[-1]._java_obj.setSummary(dataset.sparkSession._jvm.scala.Option.empty())
        return model


def baseline_classifier(features: Sequence[str], label: str = "label", **params) -> Pipeline:
    """Standardised logistic regression over named numeric columns."""
    return _Classifier(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="_assembled", handleInvalid="keep"),
            StandardScaler(inputCol="_assembled", outputCol="_scaled", withMean=True),
            LogisticRegression(featuresCol="_scaled", labelCol=label, **params),
        ]
    )


def score(model: Model | PipelineModel, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Chosen columns and the probability of class 1."""
    scored = model.transform(df)
    return scored.select(*columns, vector_to_array("probability")[1].alias("probability"))


def weighted(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Distinct rows of features and label with their number as ``weight``.

    A fit on them is the fit on all rows, and passes over far fewer rows where features are discrete.
    """
    return df.groupBy(*features, label).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def save_model(model: PipelineModel, path: str) -> str:
    """Write a fitted model to a folder that all executors reach; returns the folder."""
    model.write().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def random_params(trials: int, seed: int = 42) -> list[dict[str, float]]:
    """Search points for the baseline classifier: without a penalty first, then seeded random ones."""
    draw = random.Random(seed)
    points = [
        {
            "regParam": 10 ** draw.uniform(-6, -1),
            "elasticNetParam": draw.uniform(0.0, 1.0),
            "maxIter": draw.choice([25, 50, 100]),
        }
        for _ in range(trials - 1)
    ]
    return [{"regParam": 0.0, "elasticNetParam": 0.0, "maxIter": 100}, *points]


class Trial(NamedTuple):
    trial: int
    params: dict[str, float]
    val_loss: float


def parameter_search(
    data: DataFrame, features: Sequence[str], label: str = "label", split: str = "split",
    trials: int = 50, seed: int = 42, parallelism: int = 4,
) -> list[Trial]:
    """Random search: every point is fitted on the ``train`` rows and judged by the log loss of the ``val`` rows.

    The split is a column of the data, so it is the same wherever the search runs and keeps all samples
    of a match together.
    """
    parts = {
        name: materialize(weighted(data.where(F.col(split) == name), features, label), f"search-{name}") for name in ("train", "val")
    }

    def run(numbered: tuple[int, dict[str, float]]) -> Trial:
        number, params = numbered
        model = baseline_classifier(features, label, weightCol="weight", tol=1e-10, **params).fit(parts["train"])
        right = F.element_at(vector_to_array("probability"), (F.col(label) + 1).cast("int"))
        loss = -F.greatest(F.log(right), F.lit(-100.0))
        total = model.transform(parts["val"]).agg(F.sum(loss * F.col("weight")) / F.sum("weight"))
        return Trial(number, params, total.first()[0])

    with ThreadPool(parallelism) as pool:
        return pool.map(run, enumerate(random_params(trials, seed)))
