"""Scores of predictions, model comparison and feature importance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.functions.scalars import exact_rounded, one_if_zero
from smogline.session import stage

# The score that decides per task.
DECIDING = {"regression": "R2", "classification": "F1_Score"}
DIGITS = 4


def regression_metrics(df: DataFrame, truth: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """MAE, RMSE and R2 as rows (metric, value), in one pass (M14); ``by`` names columns that come first.

    For a constant truth R2 is 1 if every prediction hits it, else 0.
    """
    by = by or []
    error = F.col(truth) - F.col(prediction)
    sums = df.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(F.col(truth).cast("double")).alias("variance"),
    )
    r2 = (
        F.when(F.col("variance") > 0, 1 - F.try_divide(F.col("mse"), F.col("variance")))
        .when(F.col("mse") == 0, 1.0)
        .when(F.col("mse") > 0, 0.0)
    )
    wide = sums.select(*by, F.col("mae").alias("MAE"), F.sqrt("mse").alias("RMSE"), r2.alias("R2"))
    return wide.unpivot(by, ["MAE", "RMSE", "R2"], "metric", "value")


def confusion_counts(df: DataFrame, truth: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """Rows per pair of true and predicted class that occurs."""
    return df.groupBy(*(by or []), F.col(truth).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Every pair of classes with its count and percentage of all rows.

    Classes are those that occur on either side; pairs that do not occur count
    zero. The counts, one row per pair, are staged: they are needed twice, and
    scoring the rows again would cost far more.
    """
    counts = stage(confusion_counts(df, truth, prediction), "confusion")
    classes = counts.agg(
        F.array_union(F.collect_set("label"), F.collect_set("prediction")).alias("classes")
    )
    every = classes.withColumn("label", F.explode("classes")).select(
        "label", F.explode("classes").alias("prediction")
    )
    full = every.join(counts, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )
    return with_percent(full, "n", "pct")


def with_percent(small: DataFrame, value: str, name: str) -> DataFrame:
    """Percentage of the total, 0 where the total is 0.

    For result tables of bounded size: the total is one window over all rows.
    """
    total = F.sum(value).over(Window.partitionBy())
    return small.withColumn(name, F.col(value) / one_if_zero(total) * 100.0)


def classification_metrics(df: DataFrame, truth: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 as rows.

    All come from the pair counts; a class that is never predicted has
    precision 0. ``by`` names columns that come first.
    """
    by = by or []
    counts = confusion_counts(df, truth, prediction, by)
    hit = "if(label = prediction, n, 0L)"
    sides = counts.select(
        *by,
        F.expr(f"stack(2, label, n, 0L, 0L, prediction, 0L, n, {hit})").alias(
            "class", "support", "predicted", "hits"
        ),
    )
    per_class = sides.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    support, predicted, hits = F.col("support"), F.col("predicted"), F.col("hits")
    wide = per_class.groupBy(*by).agg(
        ratio(F.sum(hits), F.sum(support)).alias("Accuracy"),
        ratio(F.sum(support * ratio(hits, predicted)), F.sum(support)).alias("Precision"),
        ratio(F.sum(support * ratio(hits, support)), F.sum(support)).alias("Recall"),
        ratio(F.sum(support * ratio(hits * 2, support + predicted)), F.sum(support)).alias("F1_Score"),
    )
    return wide.unpivot(by, [c for c in wide.columns if c not in by], "metric", "value")


def compared(
    df: DataFrame, truth: str, predictions: dict[str, str], measure: Callable[[DataFrame, str, str, list[str]], DataFrame]
) -> DataFrame:
    """Scores of several models as rows (model, metric, value), in one pass over the rows.

    predictions: column of each model's predictions.
    """
    sides = [x for name, column in predictions.items() for x in (F.lit(name), F.col(column))]
    each = df.select(truth, F.stack(F.lit(len(predictions)), *sides).alias("model", "prediction"))
    return measure(each, truth, "prediction", ["model"])


def leaderboard(scores: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """Scores of several models as rows (task, model, ord, metric, value).

    ``scores`` lists (task, model, metric rows) in the order of preference.
    """
    board = None
    for place, (task, model, rows) in enumerate(scores):
        part = rows.select(
            F.lit(task).alias("task"),
            F.lit(model).alias("model"),
            F.lit(place).alias("ord"),
            "metric",
            exact_rounded(F.col("value"), DIGITS).cast("double").alias("value"),
        )
        board = part if board is None else board.unionByName(part)
    return board


def best_model(board: DataFrame) -> DataFrame:
    """Per task the model with the best deciding score; the first of equals."""
    deciding = F.create_map(*[F.lit(x) for pair in DECIDING.items() for x in pair])
    return (
        board.where(F.col("metric") == F.element_at(deciding, F.col("task")))
        .groupBy("task")
        .agg(
            F.max_by("model", F.struct("value", -F.col("ord"))).alias("best_model"),
            F.max("value").alias("best_score"),
        )
    )


def marked_leaderboard(board: DataFrame, best: DataFrame) -> DataFrame:
    """One row per model with its scores and a mark on the best."""
    metrics = ["MAE", "RMSE", "R2", "Accuracy", "Precision", "Recall", "F1_Score"]
    wide = board.groupBy("task", "ord", "model").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics]
    )
    return wide.join(best.select("task", "best_model"), "task").select(
        "task", "ord", "model", *metrics, (F.col("model") == F.col("best_model")).alias("is_best")
    )


def top_importances(importances: DataFrame, n: int = 15) -> DataFrame:
    """The n most important features and their share of these n."""
    top = importances.orderBy(F.desc("importance"), "feature").limit(n)
    return with_percent(top, "importance", "share")
