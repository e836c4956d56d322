"""Classification metrics as aggregations over (label, probability) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.operators.samples import BALLS_PER_OVER, WINDOW_OVERS
from wicketworks.operators.windows import Running, running

# Fixed value: floor of a logarithm in the cross-entropy.
LOG_FLOOR = -100.0


def predict(df: DataFrame, probability: str = "probability", threshold: float = 0.5) -> DataFrame:
    """1 where the probability is strictly above the threshold."""
    return df.withColumn("prediction", (F.col(probability) > threshold).cast("int"))


def _cells(label: str, prediction: str) -> dict[str, Column]:
    y, p = F.col(label), F.col(prediction)
    return {
        "tp": F.count_if((y == 1) & (p == 1)),
        "fp": F.count_if((y == 0) & (p == 1)),
        "fn": F.count_if((y == 1) & (p == 0)),
        "tn": F.count_if((y == 0) & (p == 0)),
    }


def _share(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def _scores(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    return {
        "accuracy": _share(tp + tn, tp + fp + fn + tn),
        "precision": _share(tp, tp + fp),
        "recall": _share(tp, tp + fn),
        "f1": _share(2 * tp, 2 * tp + fp + fn),
    }


def accuracy_percent(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of correct predictions, in percent."""
    return df.agg((100 * F.avg((F.col(label) == F.col(prediction)).cast("int"))).alias("accuracy_percent"))


def binary_scores(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1, per group; 0 on a zero denominator."""
    counted = df.groupBy(*by).agg(*[c.alias(n) for n, c in _cells(label, prediction).items()])
    scores = _scores(*[F.col(n) for n in ("tp", "fp", "fn", "tn")])
    return counted.select(*by, *[s.alias(n) for n, s in scores.items()])


def staged_scores(
    df: DataFrame,
    order: Sequence[str],
    windows: Sequence[int] = WINDOW_OVERS,
    unit: int = BALLS_PER_OVER,
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """Scores over the first ``window * unit`` predictions in list order, all if there are fewer.

    Only the first max(windows) * unit rows can matter, so they are selected before numbering.
    """
    first = df.select(*order, label, prediction).orderBy(*order).limit(max(windows) * unit)
    numbered = first.withColumn("_n", F.row_number().over(W.orderBy(*order)))
    staged = numbered.withColumn("window", F.explode(F.array(*[F.lit(int(w)) for w in windows])))
    return binary_scores(staged.where(F.col("_n") <= F.col("window") * unit), ["window"], label, prediction)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts on the full 2x2 grid, absent cells as 0."""
    cells = df.agg(*[c.alias(n) for n, c in _cells(label, prediction).items()])
    grid = F.array(
        *[
            F.struct(F.lit(y).alias("actual"), F.lit(p).alias("predicted"), F.col(n).alias("n"))
            for y, p, n in [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
        ]
    )
    return cells.select(F.inline(grid))


def classification_report(
    df: DataFrame,
    names: Sequence[str] = ("Class 0", "Class 1"),
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted average."""
    cells = df.agg(*[c.alias(n) for n, c in _cells(label, prediction).items()])
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    zero, one = _scores(tn, fn, fp, tp), _scores(tp, fp, fn, tn)
    support = {0: tn + fp, 1: tp + fn}
    total = tp + fp + fn + tn

    def row(name: str, precision: Column, recall: Column, f1: Column, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), n.alias("support"),
        )

    def average(key: str, weighted: bool) -> Column:
        if weighted:
            return _share(zero[key] * support[0] + one[key] * support[1], total)
        return (zero[key] + one[key]) / 2

    keys = ("precision", "recall", "f1")
    accuracy = one["accuracy"]
    return cells.select(
        F.inline(
            F.array(
                row(names[0], *[zero[k] for k in keys], support[0]),
                row(names[1], *[one[k] for k in keys], support[1]),
                row("accuracy", accuracy, accuracy, accuracy, total),
                row("macro avg", *[average(k, False) for k in keys], total),
                row("weighted avg", *[average(k, True) for k in keys], total),
            )
        )
    )


def _score_points(df: DataFrame, label: str, score: str, group_rows: int | None) -> DataFrame:
    """Per distinct score, highest first: own and running counts of both classes."""
    points = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n")
    )
    ordered = points.withColumn("_down", -F.col("threshold"))
    steps = [Running("sum", "_p", "_tp"), Running("sum", "_n", "_fp")]
    return running(ordered, [], ["_down"], steps, group_rows=group_rows)


def _class_totals(df: DataFrame, label: str) -> tuple[Column, Column]:
    totals = [df.agg(F.count_if(F.col(label) == k).cast("double")).scalar() for k in (1, 0)]
    return totals[0], totals[1]


def roc_points(
    df: DataFrame, label: str = "label", score: str = "probability", group_rows: int | None = None
) -> DataFrame:
    """(threshold, fpr, tpr); tied scores are one point. The origin has a null threshold."""
    positives, negatives = _class_totals(df, label)
    points = _score_points(df, label, score, group_rows).select(
        "threshold",
        F.try_divide(F.col("_fp").cast("double"), negatives).alias("fpr"),
        F.try_divide(F.col("_tp").cast("double"), positives).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(points)


def area_under_curve(
    df: DataFrame, label: str = "label", score: str = "probability", group_rows: int | None = None
) -> DataFrame:
    """Trapezoidal area under the ROC curve.

    Each point adds a trapezoid of its own negatives between the positives before and after it.
    """
    points = _score_points(df, label, score, group_rows)
    area = F.sum(F.col("_n") * (2 * F.col("_tp") - F.col("_p"))).cast("double") / 2
    pairs = F.sum("_p").cast("double") * F.sum("_n").cast("double")
    return points.agg(F.try_divide(area, pairs).alias("auc"))


def cross_entropy(
    df: DataFrame,
    label: str = "label",
    probability: str = "probability",
    batch: Sequence[str] = (),
) -> DataFrame:
    """Mean binary cross-entropy; with ``batch`` columns the mean of the batch means."""
    p, y = F.col(probability), F.col(label)

    def log(x: Column) -> Column:
        return F.greatest(F.coalesce(F.ln(x), F.lit(LOG_FLOOR)), F.lit(LOG_FLOOR))

    loss = df.select(*batch, (-(y * log(p) + (1 - y) * log(1 - p))).alias("_loss"))
    if batch:
        loss = loss.groupBy(*batch).agg(F.avg("_loss").alias("_loss"))
    return loss.agg(F.avg("_loss").alias("loss"))


def metrics_table(
    df: DataFrame,
    order: Sequence[str],
    windows: Sequence[int] = WINDOW_OVERS,
    unit: int = BALLS_PER_OVER,
) -> DataFrame:
    """Staged scores and an 'Overall' row in one table."""
    stages = staged_scores(df, order, windows, unit)
    stage = F.concat(F.col("window").cast("string"), F.lit(" overs"))
    staged = stages.select(stage.alias("stage"), "accuracy", "precision", "recall", "f1")
    overall = binary_scores(df).select(F.lit("Overall").alias("stage"), "accuracy", "precision", "recall", "f1")
    return staged.unionByName(overall)


def _marked(
    history: DataFrame, epoch: str, loss: str, keys: list[str], group_rows: int | None
) -> DataFrame:
    """The history with best loss before each epoch, and epoch, loss and place of the last improvement."""
    seen = running(
        history, keys, [epoch], [Running("min", loss, "best_before"), Running("count", None, "_i")],
        inclusive=False, group_rows=group_rows,
    )
    improved = F.col("best_before").isNull() | (F.col(loss) < F.col("best_before"))
    seen = seen.withColumn("improved", improved.cast("int")).withColumns(
        {f"_at_{n}": F.when(improved, F.col(c)) for n, c in (("i", "_i"), ("epoch", epoch), ("loss", loss))}
    )
    last = [Running("last", f"_at_{n}", f"_last_{n}") for n in ("i", "epoch", "loss")]
    return running(seen, keys, [epoch], last, group_rows=group_rows).withColumn("since_best", F.col("_i") - F.col("_last_i"))


def training_history(
    history: DataFrame,
    epoch: str = "epoch",
    loss: str = "val_loss",
    keys: Sequence[str] = (),
    group_rows: int | None = None,
) -> DataFrame:
    """Per epoch: best loss before it, whether it improved, and epochs since the last improvement."""
    marked = _marked(history, epoch, loss, list(keys), group_rows)
    return marked.select(*history.columns, "best_before", "improved", "since_best")


def early_stop(
    history: DataFrame,
    epoch: str = "epoch",
    loss: str = "val_loss",
    keys: Sequence[str] = (),
    patience: int = 10,
    group_rows: int | None = None,
) -> DataFrame:
    """Stop epoch (the last one if patience never runs out), best epoch up to it and its loss.

    Losses fall from one improvement to the next, so the best epoch up to any row is the last improvement
    there: the first row without patience, or else the last row, holds the answer.
    """
    marked = _marked(history, epoch, loss, list(keys), group_rows)
    row = F.struct(F.col(epoch).alias("stop_epoch"), F.col("_last_epoch").alias("best_epoch"), F.col("_last_loss").alias("best_loss"))
    stop = F.coalesce(F.min(F.when(F.col("since_best") >= patience, row)), F.max(row))
    return marked.groupBy(*keys).agg(stop.alias("_row")).select(*keys, "_row.*")
