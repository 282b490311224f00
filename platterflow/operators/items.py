"""Item rankings per station, month and week, and their forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.functions.aggregates import units_sum
from platterflow.functions.scores import whole


def item_weeks(lines: DataFrame, months: Sequence[int] = K.FORECAST_MONTHS) -> DataFrame:
    """Units per station, week and item from the fulfilled lines of the forecast months."""
    return (
        lines.filter(F.col("is_fulfilled") & F.col("month_number").isin(*months))
        .groupBy(
            F.col("station_code").alias("stationCode"), F.col("station_name").alias("stationName"),
            "year", F.col("month_number").alias("monthNumber"),
            F.col("week_of_month").alias("weekOfMonth"), F.col("item_name").alias("item"))
        .agg(units_sum(F.col("quantity")).alias("units"))
    )


def month_items(units: DataFrame, k: int = K.ITEMS_PER_LIST) -> DataFrame:
    """Best items per station, year and month."""
    names = units.groupBy("stationCode").agg(F.min("stationName").alias("stationName"))
    totals = units.groupBy("stationCode", "year", "monthNumber", "item").agg(F.sum("units").alias("units"))
    best = Window.partitionBy("stationCode", "year", "monthNumber").orderBy(F.desc("units"), "item")
    ranked = totals.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.join(names, "stationCode").select(
        "stationCode", "stationName", "year", "monthNumber", "item", "units", "rank")


def item_ranking(
    actual: DataFrame, cards: DataFrame, forecast_year: int = K.FORECAST_YEAR, k: int = K.ITEMS_PER_LIST,
) -> DataFrame:
    """Ranked items of every year and, scaled to the forecast orders, of the forecast year.

    The forecast follows the reference year's list, or the latest `k` entries where that is empty.
    """
    month = Window.partitionBy("stationCode", "monthNumber")
    latest = month.orderBy(F.desc("year"), "rank")
    is_reference = F.col("year") == forecast_year - 1
    source = (
        actual.withColumns({
            "__has_ref": F.max(is_reference).over(month), "__place": F.row_number().over(latest)})
        .filter(F.when(F.col("__has_ref"), is_reference).otherwise(F.col("__place") <= k))
        .select("stationCode", "monthNumber", "item", "units", "rank")
    )
    scaled = whole(F.col("units") * F.col("forecastOrders") / F.greatest("referenceOrders", F.lit(1)))
    forecast = cards.join(source, ["stationCode", "monthNumber"]).select(
        "stationCode", "stationName", F.lit(forecast_year).alias("year"), "monthNumber", "month",
        "item", scaled.cast("double").alias("units"), "rank", F.lit(True).alias("isForecast"))
    return actual.withColumns(
        {"isForecast": F.lit(False), "month": F.lit(None).cast("string")}).unionByName(forecast)


def items_by_year(ranking: DataFrame, cards: DataFrame, forecast_year: int = K.FORECAST_YEAR) -> DataFrame:
    """Five year slots per card, each with its ranked items; a slot without items keeps one row."""
    years = F.sequence(F.lit(forecast_year - K.TREND_YEARS), F.lit(forecast_year))
    slots = cards.select("stationCode", "monthNumber", F.explode(years).alias("year"))
    listed = ranking.select("stationCode", "monthNumber", "year", "rank", "item", "units")
    return slots.join(listed, ["stationCode", "monthNumber", "year"], "left").select(
        "stationCode", "monthNumber", "year", (F.col("year") == forecast_year).alias("isForecast"),
        "rank", "item", "units")


def week_items(units: DataFrame, forecast_year: int = K.FORECAST_YEAR, k: int = K.ITEMS_PER_LIST) -> DataFrame:
    """Best items per station, month and week: the reference year's, or of all years together."""
    keys = ["stationCode", "monthNumber", "weekOfMonth"]
    is_reference = F.col("year") == forecast_year - 1
    in_reference = units.filter(is_reference).select(*keys).distinct().withColumn("__has_ref", F.lit(True))
    pooled = (
        units.groupBy(*keys, "item").agg(
            F.sum(F.when(is_reference, F.col("units"))).alias("ref"), F.sum("units").alias("all"))
        .join(in_reference, keys, "left")
        .filter(F.col("__has_ref").isNull() | F.col("ref").isNotNull())
        .withColumn("units", F.when(F.col("__has_ref"), F.col("ref")).otherwise(F.col("all")))
    )
    best = Window.partitionBy(*keys).orderBy(F.desc("units"), "item")
    return pooled.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        *keys, "rank", "item", "units")


def weekly_items(
    ranked: DataFrame, weeks: DataFrame, allocation: DataFrame, forecast_year: int = K.FORECAST_YEAR,
) -> DataFrame:
    """Items of every forecast week, scaled from the week's past orders to its forecast orders."""
    in_reference = F.when(F.col("year") == forecast_year - 1, F.col("orderCount"))
    base = weeks.groupBy("stationCode", "monthNumber", "weekOfMonth").agg(
        F.coalesce(F.sum(in_reference), F.sum("orderCount")).alias("base"))
    planned = allocation.select("stationCode", "monthNumber", F.col("week").alias("weekOfMonth"), "weeklyOrders")
    keys = ["stationCode", "monthNumber", "weekOfMonth"]
    scaled = F.col("units") * F.col("weeklyOrders") / F.greatest(F.coalesce("base", F.lit(0)), F.lit(1))
    return planned.join(ranked, keys).join(base, keys, "left").select(
        "stationCode", "monthNumber", F.col("weekOfMonth").alias("week"), "rank", "item",
        whole(scaled).alias("units"))
