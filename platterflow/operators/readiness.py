"""Readiness, risk and staffing from the daily horizon, and its roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.functions.scores import action, at_least, percent_change, readiness, risk_level, whole
from platterflow.operators.split import latest


def daily_readiness(horizon: DataFrame) -> DataFrame:
    """Forecast rows as published: orders, revenue, vendors, gap, readiness and known event."""
    predicted = F.col("prediction")
    value = F.col("average_order_value")
    gapped = horizon.withColumn("__gap", at_least(
        predicted - at_least(F.col("baseline_daily_orders") * K.CAPACITY_BUFFER, 1.0), 0.0))
    staffed = gapped.withColumns({
        "__share": F.col("__gap") / at_least(predicted, 1.0),
        "__vendors": whole(F.col("current_vendor_count")),
        "__needed": F.greatest(
            F.lit(1), whole(predicted / at_least(F.col("orders_per_vendor"), 1.0))),
    })
    return staffed.select(
        F.col("station_code").alias("stationCode"), F.col("station_name").alias("stationName"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        whole(predicted).alias("forecastOrders"),
        whole(predicted * value).alias("forecastRevenue"),
        whole(F.col("__gap") * value).alias("revenueAtRisk"),
        F.col("__vendors").alias("currentVendorCount"),
        F.col("__needed").alias("recommendedVendorCount"),
        F.greatest(F.col("__needed") - F.col("__vendors"), F.lit(0)).alias("vendorGap"),
        whole(F.col("baseline_daily_orders")).alias("baselineDailyOrders"),
        readiness(F.col("__share")).alias("readinessScore"),
        risk_level(F.col("__share")).alias("riskLevel"),
        F.col("festival_flag").cast("boolean").alias("festival"),
        F.col("holiday_flag").cast("boolean").alias("holiday"),
        F.nullif(F.col("event_name"), F.lit("")).alias("eventName"),
        F.nullif(F.col("event_type"), F.lit("")).alias("eventType"),
    )


def station_outlook(daily: DataFrame, days: int = K.HORIZON_DAYS) -> DataFrame:
    """One row per station over the horizon, with uplift, risk share and recommended action."""
    summary = daily.groupBy("stationCode", "stationName").agg(
        F.sum("forecastOrders").alias("forecastOrders"),
        F.sum("forecastRevenue").alias("forecastRevenue"),
        F.sum("revenueAtRisk").alias("revenueAtRisk"),
        F.max("recommendedVendorCount").alias("recommendedVendorCount"),
        F.max("currentVendorCount").alias("currentVendorCount"),
        F.max("vendorGap").alias("vendorGap"),
        F.max("baselineDailyOrders").alias("baselineDailyOrders"),
        F.min("readinessScore").alias("readinessScore"),
    )
    risk_share = F.bround(F.col("revenueAtRisk") / at_least(F.col("forecastRevenue"), 1) * 100, 1)
    return (
        summary.withColumns({
            "demandUpliftPercent": percent_change(
                F.col("forecastOrders"), F.col("baselineDailyOrders") * days),
            "riskSharePercent": risk_share,
        })
        .withColumn("riskLevel", risk_level(F.col("riskSharePercent") / 100))
        .withColumn("recommendedAction", action(F.col("riskLevel"), F.col("vendorGap")))
    )


def route_days(cube: DataFrame) -> DataFrame:
    """Orders per route and day."""
    return cube.groupBy("station_code", "train_no", "train_name", "date").agg(
        F.sum("orders").alias("orders"))


def route_shares(route_history: DataFrame) -> DataFrame:
    """The largest routes of each station by share of its orders in the trailing window.

    Shares are of all routes with enough orders, so the routes kept may add up to less than 1.
    """
    since = F.date_sub(latest(route_history, "date"), K.ROUTE_WINDOW_DAYS)
    recent = route_history.filter(F.col("date") >= since).groupBy(
        "station_code", "train_no", "train_name").agg(F.sum("orders").alias("recentOrders"))
    station = Window.partitionBy("station_code")
    place = F.row_number().over(station.orderBy(F.desc("recentOrders"), "train_no", "train_name"))
    return (
        recent.filter(F.col("recentOrders") >= K.ROUTE_MIN_ORDERS)
        .withColumns({
            "routeShare": F.col("recentOrders") / F.sum("recentOrders").over(station),
            "__place": place,
        })
        .filter(F.col("__place") <= K.ROUTES_PER_STATION)
        .select("station_code", "train_no", "train_name", "recentOrders", "routeShare")
    )


def route_outlook(daily: DataFrame, shares: DataFrame) -> DataFrame:
    """Station forecasts spread over its routes.

    Both sides are summed per station before they meet: a share is one factor for all days.
    """
    totals = ["forecastOrders", "forecastRevenue", "revenueAtRisk"]
    stations = daily.groupBy("stationCode", "stationName").agg(*[F.sum(c).alias(c) for c in totals])
    spread = stations.join(shares, stations["stationCode"] == shares["station_code"])
    return (
        spread.select(
            "stationCode", "stationName",
            F.col("train_no").alias("trainNo"), F.col("train_name").alias("trainName"),
            *[whole(F.col(c) * F.col("routeShare")).alias(c) for c in totals],
            "routeShare", F.bround(F.col("routeShare") * 100, 1).alias("routeSharePercent"),
        )
        .withColumn("riskLevel", risk_level(
            F.col("revenueAtRisk") / at_least(F.col("forecastRevenue"), 1)))
    )


def event_alerts(daily: DataFrame) -> DataFrame:
    """Known events in the horizon against the mean of the days without one, null if all have one."""
    per_day = daily.groupBy("date", "eventName", "eventType").agg(
        F.sum("forecastOrders").alias("forecastOrders"), F.sum("revenueAtRisk").alias("revenueAtRisk"))
    normal = per_day.filter(F.col("eventName").isNull()).agg(F.avg("forecastOrders")).scalar()
    first = per_day.agg(F.min(F.to_date("date"))).scalar()
    return per_day.filter(F.col("eventName").isNotNull()).select(
        "date", "eventName", "eventType",
        F.greatest(F.datediff(F.to_date("date"), first), F.lit(0)).alias("daysUntil"),
        "forecastOrders",
        F.when(normal.isNotNull(), percent_change(F.col("forecastOrders"), normal))
        .alias("expectedDemandChangePercent"),
        "revenueAtRisk",
    )

