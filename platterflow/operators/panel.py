"""Station-by-day demand and its calendar, lag and moving-average features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.functions import dates
from platterflow.functions.aggregates import exact_sum, money_rollup, rows


def visits(orders: DataFrame) -> DataFrame:
    """Orders and revenue per station, day, vendor and route.

    Everything the daily job needs comes from this cube, so the orders are read once, and the two
    distinct counts and the route history after it work on far fewer rows.
    """
    keys = ["station_code", "station_name", "date", "outlet_name", "train_no", "train_name"]
    return orders.groupBy(*keys).agg(rows().alias("orders"), exact_sum(F.col("revenue")).alias("revenue"))


def station_days(cube: DataFrame) -> DataFrame:
    """Orders, revenue and active vendors per station and day that had orders.

    A station code seen under several names takes the smallest of them on all its days.
    """
    days = cube.groupBy("station_code", "date").agg(
        F.min("station_name").alias("station_name"),
        F.sum("orders").alias("order_count"),
        money_rollup(F.col("revenue")).alias("revenue"),
        F.count_distinct("outlet_name").alias("vendor_capacity"),
    )
    name = F.min("station_name").over(Window.partitionBy("station_code"))
    return days.select("station_code", name.alias("station_name"), "date", "order_count", "revenue",
                       "vendor_capacity")


def daily_features(panel: DataFrame, calendar: DataFrame, lagged_capacity: bool = False) -> DataFrame:
    """Panel with calendar flags, date parts and demand of the days before.

    Lags never reach over a day without orders: each run of consecutive days is a segment of its
    own.  The windows work on one station's days, a size bounded by the calendar.  Vendor capacity
    is the same day's; with `lagged_capacity` it is that of the day before.
    """
    history = Window.partitionBy("station_code").orderBy("date")
    gap = F.datediff("date", F.lag("date").over(history))
    frame = (
        panel.join(calendar, "date", "left").na.fill(0, list(K.CALENDAR_FLAGS))
        .withColumns({
            "month": F.month("date"),
            "day_of_week": dates.weekday(F.col("date")),
            "is_weekend": dates.weekend(F.col("date")),
            "new_segment": F.when(gap == 1, 0).otherwise(1),
        })
        .withColumn("segment", F.sum("new_segment").over(
            history.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )
    run = Window.partitionBy("station_code", "segment").orderBy("date")
    before = run.rowsBetween(-K.ROLLING_DAYS, -1)
    enough = F.count("order_count").over(before) >= K.ROLLING_MIN_VALUES
    frame = frame.withColumns({
        "lag_1_demand": F.lag("order_count").over(run).cast("double"),
        "rolling_7_demand": F.when(enough, F.avg("order_count").over(before)),
    })
    if lagged_capacity:
        frame = frame.withColumn("vendor_capacity", F.lag("vendor_capacity").over(run))
    return frame


def complete_days(features: DataFrame) -> DataFrame:
    """Rows that can train a model: both demand features are known."""
    return features.na.drop(subset=["lag_1_demand", "rolling_7_demand"])


def null_audit(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, non-null and missing cells per column, most missing first."""
    counted = frame.agg(rows().alias("__rows"), *[F.count(c).alias(c) for c in columns])
    stacked = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counted.select(
        F.col("__rows").alias("rows"),
        F.expr(f"stack({len(columns)}, {stacked}) as (feature, present)"),
    ).select("feature", "rows", "present", (F.col("rows") - F.col("present")).alias("missing")).orderBy(
        F.desc("missing"), "feature")


def demand_by_month(panel: DataFrame) -> DataFrame:
    return panel.groupBy(dates.month_key(F.col("date")).alias("month")).agg(
        F.sum("order_count").alias("order_count"))


def busiest_stations(panel: DataFrame, k: int = K.EXPLORE_STATIONS) -> DataFrame:
    return (panel.groupBy("station_name").agg(F.sum("order_count").alias("order_count"))
            .orderBy(F.desc("order_count"), "station_name").limit(k))


def busiest_routes(cube: DataFrame, k: int = K.EXPLORE_ROUTES) -> DataFrame:
    return (cube.groupBy("station_code", "train_no", "train_name").agg(F.sum("orders").alias("orders"))
            .orderBy(F.desc("orders"), "station_code", "train_no", "train_name").limit(k))
