"""Best-seller report and the short tables and lines of the printed report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.functions.aggregates import rows, units_sum
from platterflow.functions.scores import grouped_digits, lakh


def month_item_totals(lines: DataFrame) -> DataFrame:
    """Units, lines, vendors and stations per month and item.

    Lines are combined per vendor and station first: the two distinct counts then expand the
    combined rows and not the lines, and an item sold everywhere is many small groups.
    """
    keys = ["month", "item_name"]
    combined = lines.groupBy(*keys, "outlet_name", "station_name").agg(
        units_sum(F.col("quantity")).alias("units_sold"), rows().alias("order_lines"))
    return combined.groupBy(*keys).agg(
        F.sum("units_sold").alias("units_sold"), F.sum("order_lines").alias("order_lines"),
        F.count_distinct("outlet_name").alias("active_vendors"),
        F.count_distinct("station_name").alias("active_stations"))


def best_sellers(totals: DataFrame) -> DataFrame:
    """The item with most units of every month, by lines and name where units are equal."""
    best = Window.partitionBy("month").orderBy(F.desc("units_sold"), F.desc("order_lines"), "item_name")
    return totals.withColumn("rank", F.row_number().over(best)).filter("rank = 1").select(
        "month", "rank", F.col("item_name").alias("top_seller"),
        "units_sold", "order_lines", "active_vendors", "active_stations")


def report_summary(totals: DataFrame) -> DataFrame:
    """Observed months and delivered units of the report."""
    return totals.agg(
        F.count_distinct("month").alias("observed_months"),
        F.coalesce(F.sum("units_sold"), F.lit(0.0)).cast("bigint").alias("total_delivered_units"))


def kpi_strip(evaluation: DataFrame, outlook: DataFrame, routes: DataFrame, alerts: DataFrame) -> DataFrame:
    """Model errors with the sizes of training and forecast tables, in one row."""
    def size(frame: DataFrame) -> Column:
        return frame.agg(rows()).scalar()

    return evaluation.select(
        "mae", "rmse", "r2", "trainingRows", size(outlook).alias("stations"),
        F.lit(K.HORIZON_DAYS).cast("bigint").alias("forecastDays"),
        size(routes).alias("routes"), size(alerts).alias("alerts"))


def station_table(outlook: DataFrame, k: int = K.REPORT_STATIONS) -> DataFrame:
    """Stations with the most forecast orders, formatted for the report."""
    return outlook.orderBy(F.desc("forecastOrders"), "stationCode").limit(k).select(
        "stationCode", "stationName", "forecastOrders",
        grouped_digits(F.col("forecastOrders")).alias("orders"),
        lakh(F.col("forecastRevenue")).alias("revenue"),
        F.concat("readinessScore", F.lit("/100")).alias("readiness"), "riskLevel")


def _sentence(frame: DataFrame, order: Column, line: Column, empty: str, name: str) -> DataFrame:
    listed = F.array_sort(F.collect_list(F.struct(order.alias("o"), line.alias("t"))))
    joined = F.array_join(F.transform(listed, lambda x: x["t"]), "; ")
    return frame.agg(F.coalesce(F.nullif(joined, F.lit("")), F.lit(empty)).alias(name))


def route_line(routes: DataFrame, k: int = K.REPORT_ROUTES) -> DataFrame:
    """The routes with the most forecast orders as one line of text."""
    ties = ["stationCode", "trainNo", "trainName"]
    top = routes.orderBy(F.desc("forecastOrders"), *ties).limit(k)
    order = F.struct((-F.col("forecastOrders")).alias("n"), *ties)
    line = F.concat("trainName", F.lit(" ("), "trainNo", F.lit("): "),
                    grouped_digits(F.col("forecastOrders")), F.lit(" orders"))
    return _sentence(top, order, line, K.NO_ROUTES, "route_line")


def alert_line(alerts: DataFrame) -> DataFrame:
    """The known events of the horizon as one line of text; at most one event row per day."""
    line = F.concat("eventName", F.lit(" on "), "date", F.lit(" ("),
                    "daysUntil", F.lit(" days into the model window)"))
    return _sentence(alerts, F.struct("date", "eventName"), line, K.NO_ALERTS, "alert_line")


def at_station(frame: DataFrame, station_code: str) -> DataFrame:
    """Rows of one station of a published table."""
    return frame.filter(F.col("stationCode") == station_code)


def preview(frame: DataFrame, order: list[str], rows_shown: int = K.PREVIEW_ROWS) -> DataFrame:
    """The first rows of a table in a given order."""
    return frame.orderBy(*order).limit(rows_shown)
