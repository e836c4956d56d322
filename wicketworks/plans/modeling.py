"""From filtered tables to samples, and from samples to evaluation tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketworks.operators import metrics
from wicketworks.operators.modeling import baseline_classifier, flatten_samples, load_model, score
from wicketworks.operators.ordering import best
from wicketworks.operators.samples import WINDOW_OVERS, augment, build_samples, split_exact, split_of
from wicketworks.plans.merge import BALL_COLUMNS
from wicketworks.session import materialize

BALL_FEATURES = [c for c in BALL_COLUMNS if c not in ("match_id", "won")]


def match_samples(
    balls: DataFrame,
    teams: DataFrame,
    players: DataFrame,
    drop_last: int = 1,
    exact_split: bool = False,
    seed: int = 42,
    group_rows: int | None = None,
) -> DataFrame:
    """Samples of all common matches with their split.

    ``drop_last`` is 1, or 30 for the variant that hides the end of a match.
    """
    team_features = [c for c in teams.columns if c != "match_id"]
    player_features = [c for c in players.columns if c != "match_id"]
    samples = build_samples(
        balls,
        teams,
        players,
        key="match_id",
        ball_order=["innings", "ball", "runs", "wickets"],
        ball_features=BALL_FEATURES,
        team_features=team_features,
        player_order=player_features,
        player_features=player_features,
        label="won",
        drop_last=drop_last,
        group_rows=group_rows,
    )
    if exact_split:
        return samples.join(split_exact(samples.select("match_id"), "match_id", seed, group_rows), "match_id")
    return samples.withColumn("split", split_of("match_id", seed))


class Evaluation(NamedTuple):
    scores: DataFrame
    confusion: DataFrame
    report: DataFrame
    roc: DataFrame
    auc: DataFrame
    loss: DataFrame


def evaluate(
    scored: DataFrame,
    order: Sequence[str],
    windows: Sequence[int] = WINDOW_OVERS,
    names: Sequence[str] = ("Class 0", "Class 1"),
) -> Evaluation:
    """All evaluation tables of (label, probability) rows; ``order`` is the list order."""
    predicted = metrics.predict(scored)
    return Evaluation(
        scores=metrics.metrics_table(predicted, order, windows),
        confusion=metrics.confusion_matrix(predicted),
        report=metrics.classification_report(predicted, names),
        roc=metrics.roc_points(predicted),
        auc=metrics.area_under_curve(predicted),
        loss=metrics.cross_entropy(predicted),
    )


class Trained(NamedTuple):
    model: PipelineModel
    scored: DataFrame
    train: DataFrame


def train_and_score(
    samples: DataFrame,
    team_width: int,
    player_width: int,
    ball_width: int,
    windows: Sequence[int] | None = WINDOW_OVERS,
    **params,
) -> Trained:
    """Fit the baseline on the train split and score the test split.

    With ``windows`` every match contributes one sample per stage; with None it is used once.
    The flat features are written once, because fitting passes over them many times.
    """
    staged = augment(samples, windows) if windows else samples
    flat = materialize(flatten_samples(staged, "match_id", team_width, player_width, ball_width), "features")
    keys = [c for c in ("match_id", "window") if c in flat.columns]
    features = [c for c in flat.columns if c not in (*keys, "split", "label")]
    model = baseline_classifier(features, **params).fit(flat.where(F.col("split") == "train"))
    test, train = (score(model, flat.where(F.col("split") == x), [*keys, "label"]) for x in ("test", "train"))
    return Trained(model, test, train)


def select_run(runs: DataFrame, metric: str, maximize: bool = True, k: int = 1) -> DataFrame:
    """The best (or k-th best) run."""
    return best(runs, metric, maximize, k, tiebreak=["run_id"])


def evaluate_best_run(
    runs: DataFrame, data: DataFrame, metric: str, order: Sequence[str], maximize: bool = True
) -> tuple[str, Evaluation]:
    """Load the model of the best run in ``runs`` (run_id, metric, path), score ``data`` with it and evaluate."""
    chosen = select_run(runs, metric, maximize).select("run_id", "path").first()
    scored = score(load_model(chosen["path"]), data, [*order, "label"])
    return chosen["run_id"], evaluate(scored, order)
