"""Next month's demand per item, ranked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.operators import item_demand, metrics, split
from platterflow.plans import learning, publish
from platterflow.session import pin
from platterflow.sources import exports


def fit(pairs: DataFrame, trees=K.ITEM_TREES) -> learning.FittedModel:
    texts, numbers = item_demand.feature_lists(pairs.columns)
    return learning.fit_trees(pairs, texts, numbers, "next_month_quantity", K.ITEM_MIN_FREQUENCY, trees)


def holdout_mape(pairs: DataFrame, trees=K.ITEM_TREES) -> DataFrame | None:
    """Percentage error on the last target month, or None when too little is left to train on."""
    train, test = split.split_last_period(pairs, F.col("target_month"))
    if train.count() < K.MIN_ITEM_VALIDATION_ROWS:
        return None
    scored = fit(train, trees).score(test)
    return metrics.mape(scored.withColumn("prediction", F.greatest("prediction", F.lit(0.0))),
                        "next_month_quantity", "prediction")


def run(raw: DataFrame, trees=K.ITEM_TREES) -> tuple[DataFrame, DataFrame | None]:
    """(ranked forecast, holdout error) from rows in the generic or the export schema."""
    monthly = item_demand.item_months(item_demand.adapt_schema(raw))
    lagged = pin(item_demand.with_month_lags(monthly))
    pairs = pin(item_demand.training_pairs(lagged))
    split.require_rows(pairs, None, K.MIN_ITEM_MONTHS)
    error = holdout_mape(pairs, trees)
    scored = fit(pairs, trees).score(item_demand.future_items(lagged))
    return item_demand.ranked_forecast(scored), error


def run_files(spark: SparkSession, paths: Sequence[str], output: str, trees=K.ITEM_TREES) -> DataFrame:
    """Read the listed files, write the ranked forecast as CSV, and return the best item."""
    ranked, _ = run(exports.read_exports(spark, list(paths)), trees)
    publish.write_csv(ranked, output)
    return spark.read.option("header", True).schema(ranked.schema).csv(output).orderBy("rank").limit(1)
