"""Cancellation risk from what is known when an order is booked."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.functions import dates
from platterflow.operators import cleaning, metrics, orders, split
from platterflow.plans import learning, publish
from platterflow.session import keep, pin

@dataclass
class CancellationRun:
    model: learning.FittedModel
    metrics: DataFrame
    scored: DataFrame


def run(lines: DataFrame, maximum: int = K.MAX_TRAINING_ORDERS, trees=K.CANCELLATION_TREES) -> CancellationRun:
    """Train on a balanced sample of all months but the last, test on the whole last month."""
    booked = keep(orders.booking_features(cleaning.booking_lines(lines)))
    train, test = split.split_last_period(booked, F.trunc("booking_date", "MM"))
    sample = keep(split.balanced_sample(
        train.withColumn("label", F.col("cancelled").cast("int")), "cancelled", "order_id", maximum))
    model = learning.fit_trees(sample, K.CANCELLATION_CATEGORIES, K.CANCELLATION_NUMBERS, "label",
                               K.CANCELLATION_MIN_FREQUENCY, trees, classify=True)
    scored = keep(learning.positive_probability(model.score(test)))
    factors = model.importance(lines.sparkSession).limit(K.TOP_FACTORS)
    listed = factors.agg(F.transform(
        F.reverse(F.array_sort(F.collect_list(F.struct("importance", "feature")))),
        lambda x: F.struct(x["feature"].alias("feature"), x["importance"].alias("importance"))))
    tested = F.col("positives") + F.col("negatives")
    record = metrics.binary_scores(scored, "cancelled", "score").select(
        F.lit("trained").alias("status"),
        scored.agg(F.max(dates.month_key(F.col("booking_date")))).scalar().alias("test_month"),
        sample.agg(F.count(F.lit(1))).scalar().alias("training_orders"),
        tested.alias("test_orders"), (F.col("positives") / tested).alias("test_cancellation_rate"),
        "roc_auc", "average_precision", listed.scalar().alias("factors"), F.lit(K.RISK_NOTE).alias("note"))
    return CancellationRun(model, pin(record), scored)


def write(result: CancellationRun, output: str) -> None:
    result.model.save(f"{output}/model")
    publish.write_json(result.metrics, f"{output}/metrics")
