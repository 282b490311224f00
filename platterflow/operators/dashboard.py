"""Monthly key figures, item rankings, the enriched item forecast and the dashboard record."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.functions.aggregates import money_sum, rows, units_sum
from platterflow.functions.scores import grouped_digits


def line_cube(lines: DataFrame) -> DataFrame:
    """Lines and units per month, station, item, vendor and state of the order.

    All item, coverage and availability figures come from this one pass over the lines.
    """
    keys = ["month", "station_code", "station", "item", "outlet_name", "is_fulfilled", "is_cancelled"]
    return lines.groupBy(*keys).agg(units_sum(F.col("quantity")).alias("units"), rows().alias("lines"))


def station_month_items(cube: DataFrame, k: int = K.ITEMS_PER_LIST) -> DataFrame:
    """Best items per month and station by units, then by lines."""
    best = Window.partitionBy("month", "station").orderBy(F.desc("units"), F.desc("order_lines"), "item")
    return (
        cube.filter("is_fulfilled").groupBy("month", "station", "item").agg(
            F.sum("units").alias("units"), F.sum("lines").alias("order_lines"),
            F.count_distinct("outlet_name").alias("vendors"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
    )


def monthly_kpis(orders: DataFrame) -> DataFrame:
    """Orders, cancellations, revenue and lost revenue per month."""
    cancelled = F.col("is_cancelled")
    return (
        orders.groupBy("month").agg(
            rows().alias("order_count"), F.count_if(cancelled).alias("cancellation_count"),
            money_sum(F.col("revenue")).alias("revenue"),
            money_sum(F.when(cancelled, F.col("revenue"))).alias("revenue_loss"))
        .withColumn("cancellation_rate", F.col("cancellation_count") / F.col("order_count"))
    )


def item_month_units(cube: DataFrame) -> DataFrame:
    """Fulfilled units per item and month: the item history and the latest month come from it."""
    return cube.filter("is_fulfilled").groupBy("item", "month").agg(F.sum("units").alias("units"))


def item_history(units: DataFrame) -> DataFrame:
    """Units, observed months and latest month per item, with the units of the overall latest month."""
    last = units.agg(F.max("month")).scalar()
    return units.withColumn("__last", last).groupBy("item").agg(
        F.sum("units").alias("units"), rows().alias("observed_months"),
        F.max("month").alias("latest_month"),
        F.sum(F.when(F.col("month") == F.col("__last"), F.col("units"))).alias("latest_units"),
        F.max("__last").alias("overall_month"),
    )


def enriched_forecast(forecast: DataFrame, history: DataFrame, k: int = K.ENRICHED_ITEMS) -> DataFrame:
    """Best forecast items with their history and a sentence that gives the reason.

    The top is taken before the join: only its rows look their history up.
    """
    top = forecast.orderBy("rank").limit(k).select(
        "forecast_month", "rank", F.col("food_item").alias("item"),
        F.col("forecast_quantity").alias("forecast_units"))
    month = history.agg(F.max("overall_month")).scalar()
    observed = F.coalesce("observed_months", F.lit(0))
    reason = F.concat(
        observed, F.lit(" observed months; "), grouped_digits(F.col("units")),
        F.lit(" historical units; "), grouped_digits(F.col("latest_units")), F.lit(" units in "),
        month, F.lit("."))
    known = history.select("item", "units", "observed_months", "latest_units")
    return top.join(known, "item", "left").select(
        "forecast_month", "rank", "item", "forecast_units", "units", "observed_months",
        "latest_units", reason.alias("reason")).orderBy("rank")


def with_states(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Lines with the state of their station, null where the map has no such code."""
    return lines.join(states, "station_code", "left")


def state_coverage(cube: DataFrame, states: DataFrame) -> DataFrame:
    """Share of lines whose station has a state.  Lines are counted per station before the join."""
    per_station = cube.groupBy("station_code").agg(F.sum("lines").alias("lines"))
    mapped = F.coalesce("state", F.lit("")) != ""
    return with_states(per_station, states).agg(
        F.sum("lines").alias("lines"), F.sum(F.when(mapped, F.col("lines")).otherwise(0)).alias("mapped"),
    ).select("lines", "mapped", (F.col("mapped") / F.col("lines")).alias("state_mapping_coverage"))


def dashboard_record(cube: DataFrame) -> DataFrame:
    """Latest fulfilled month and whether cancelled lines exist, in one row."""
    return cube.agg(
        F.max(F.when(F.col("is_fulfilled"), F.col("month"))).alias("latest_observed_month"),
        F.bool_or("is_cancelled").alias("cancellation_model_available"))
