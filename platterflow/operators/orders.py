"""One row per order from the lines of an export, which repeat the order on every item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.functions import dates
from platterflow.functions.aggregates import exact_sum, exact_units, first_row, money_rollup, order_revenue, units_rollup


def delivered_orders(lines: DataFrame) -> DataFrame:
    """Orders of `delivered_lines`: where, when, by whom and for how much."""
    kept = ["date", "station_code", "station_name", "outlet_name", "train_no", "train_name"]
    packed = lines.groupBy("order_id").agg(
        first_row(kept, F.col("line_order")).alias("first"), order_revenue().alias("revenue"))
    return packed.select("order_id", "first.*", "revenue")


def booked_orders(lines: DataFrame) -> DataFrame:
    """Orders of `booked_lines`; an order is cancelled when any of its lines is."""
    kept = ["booking_date", "station_code", "station_name", "year", "month_number", "month",
            "week_of_month"]
    packed = lines.groupBy("order_id").agg(
        first_row(kept, F.col("line_order")).alias("first"),
        F.bool_or("is_cancelled").alias("is_cancelled"), order_revenue().alias("revenue"))
    return packed.select("order_id", "first.*", "is_cancelled", "revenue")


def dashboard_orders(lines: DataFrame) -> DataFrame:
    """Orders of `dashboard_lines`: month of the first booking, status of the last."""
    order = F.struct("booking_date", "line_order")
    return lines.groupBy("order_id").agg(
        dates.month_key(F.min("booking_date")).alias("month"),
        F.max_by("status", order).alias("status"),
        F.bool_or("is_cancelled").alias("is_cancelled"),
        order_revenue().alias("revenue"),
    )


def booking_features(lines: DataFrame) -> DataFrame:
    """Orders of `booking_lines` with what is known when they are booked.

    Lines are combined per order and item first, so that counting items needs no second read of the lines. Both steps
    combine before their shuffle, so an order with a third of all lines is merged from one row per task and item.
    """
    order = F.struct("booking_date", "line_order")

    def earliest(column: str):
        return F.min(F.when(F.col(column).isNotNull(), F.struct(order.alias("o"), F.col(column).alias("v"))))

    firsts = ["eta", *K.CANCELLATION_CATEGORIES]
    items = lines.groupBy("order_id", "item_name").agg(
        F.min("booking_date").alias("booking_date"), F.bool_or("cancelled").alias("cancelled"),
        *[earliest(c).alias(c) for c in firsts], exact_units(F.col("quantity")).alias("units"),
        *[exact_sum(F.col(c)).alias(c) for c in ("selling_price", "discount")])
    orders = items.groupBy("order_id").agg(
        F.min("booking_date").alias("booking_date"), F.bool_or("cancelled").alias("cancelled"),
        *[F.min(c)["v"].alias(c) for c in firsts], F.count("item_name").alias("item_count"),
        units_rollup(F.col("units")).alias("total_quantity"),
        money_rollup(F.col("selling_price")).alias("total_selling_price"),
        money_rollup(F.col("discount")).alias("total_discount"))
    booked = F.col("booking_date")
    return orders.withColumns({
        "booking_month": F.month(booked),
        "booking_day_of_week": dates.weekday(booked),
        "booking_hour": F.hour(booked),
        "is_weekend": dates.weekend(booked),
        "eta_hour": F.hour("eta"),
        "eta_lead_hours": dates.hours_between(booked, F.col("eta")),
    })
