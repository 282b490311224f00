"""The nested record per monthly card.  Every list in it is bounded: years, weeks, top items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.functions.scores import grouped_digits
from platterflow.operators.monthly import MEASURES

KEYS = ["stationCode", "monthNumber"]


def _listed(frame: DataFrame, keys: list[str], order: str, fields: list[str], name: str) -> DataFrame:
    present = F.when(F.col(order).isNotNull(), F.struct(*dict.fromkeys([order, *fields])))
    listed = F.array_sort(F.collect_list(present))
    kept = F.transform(listed, lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return frame.groupBy(*keys).agg(kept.alias(name))


def card_details(
    cards: DataFrame, trend: DataFrame, by_year: DataFrame, allocation: DataFrame, items: DataFrame,
    forecast_year: int = K.FORECAST_YEAR,
) -> DataFrame:
    """Cards with their trend, items by year, weekly forecast and drivers."""
    trends = _listed(trend, KEYS, "year",
                     ["year", "orders", "cancelledOrders", "revenue", "revenueLoss", "isForecast"], "trend")
    year_items = _listed(by_year, KEYS + ["year", "isForecast"], "rank", ["rank", "item", "units"], "items")
    years = _listed(year_items, KEYS, "year", ["year", "isForecast", "items"], "topItemsByYear")
    week_items = _listed(items, KEYS + ["week"], "rank", ["rank", "item", "units"], "topItems")
    weeks = allocation.join(week_items, KEYS + ["week"], "left").withColumn(
        "topItems", F.coalesce("topItems", F.expr("filter(array(named_struct('rank', 0, 'item', '', 'units', 0L)), x -> false)")))
    weekly = _listed(weeks, KEYS, "week", ["week", "label", *MEASURES, "topItems"], "weeklyForecast")
    history, reference, rate, model, weeks_rule = K.DRIVERS
    drivers = F.array(
        F.concat("historicalYears", F.lit(history)),
        F.concat(F.lit(reference[0] % (forecast_year - 1)), grouped_digits(F.col("referenceOrders")), F.lit(reference[1])),
        F.concat(F.lit(rate[0]), "averageCancellationRate", F.lit(rate[1])), F.lit(model), F.lit(weeks_rule))
    joined = cards.join(trends, KEYS).join(years, KEYS).join(weekly, KEYS)
    return joined.select(
        "stationCode", "stationName", "month", "forecastOrders", "predictedPercentage",
        "forecastCancelledOrders", "forecastRevenueLoss", "predictedRevenue", "confidenceScore",
        "trend", "topItemsByYear", "weeklyForecast", drivers.alias("drivers"))
