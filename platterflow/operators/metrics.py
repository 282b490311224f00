"""Exact evaluation measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platterflow.functions.aggregates import rows
from platterflow.operators.ordering import running_totals


def _errors(actual: str, predicted: str) -> tuple[Column, Column]:
    y = F.col(actual).cast("double")
    return y, y - F.col(predicted).cast("double")


def regression_metrics(frame: DataFrame, actual: str, predicted: str) -> DataFrame:
    """rmse and mae with two decimals and r2 with four, in one pass."""
    y, error = _errors(actual, predicted)
    spread = F.var_pop(y) * F.count(y)
    return frame.agg(
        F.bround(F.sqrt(F.avg(error * error)), 2).alias("rmse"),
        F.bround(F.avg(F.abs(error)), 2).alias("mae"),
        F.bround(1 - F.try_divide(F.sum(error * error), spread), 4).alias("r2"),
        rows().alias("rows"),
    )


def mape(frame: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean absolute percentage error."""
    y, error = _errors(actual, predicted)
    smallest = 2.220446049250313e-16
    return frame.agg((F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(smallest))) * 100).alias("mape"))


def binary_scores(frame: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve, ties counting half, and step-wise average precision.

    Rows are counted per distinct score first; the ordered part works on distinct scores only.
    """
    hit = F.col(label).cast("boolean")
    counts = frame.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg"))
    return counted_scores(counts)


def counted_scores(counts: DataFrame) -> DataFrame:
    """The measures of `binary_scores` from counts (pos, neg) per distinct score, of any size."""
    placed = running_totals(counts, [F.col("score").desc()], ["pos", "neg"])
    hits = F.col("pos_before") + F.col("pos")
    flagged = hits + F.col("neg_before") + F.col("neg")
    return placed.select(
        "pos", "neg",
        (F.col("neg").cast("double") * (F.col("pos_before") + F.col("pos") / 2)).alias("won"),
        (F.col("pos").cast("double") * hits / flagged).alias("gain"),
    ).agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
        F.sum("won").alias("won"), F.sum("gain").alias("gain"),
    ).select(
        F.try_divide(F.col("won"), F.col("positives").cast("double") * F.col("negatives")).alias("roc_auc"),
        F.try_divide(F.col("gain"), F.col("positives")).alias("average_precision"),
        "positives", "negatives",
    )
