"""The recursive daily horizon: each day's forecast becomes demand history of the days after it.

The state is one row per station with its last few demand values in an array. A formula, or a fitted model turned into one,
is folded over the days inside one projection.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.functions import dates
from platterflow.functions.aggregates import money_sum
from platterflow.session import pin

Formula = Callable[[Mapping[str, Column]], Column]


def station_profiles(panel: DataFrame) -> DataFrame:
    """Vendors, orders per vendor, recent baseline and order value of every station."""
    recent = Window.partitionBy("station_code").orderBy(F.col("date").desc())
    per_vendor = F.col("order_count") / F.greatest(F.col("vendor_capacity"), F.lit(1))
    newest = F.col("__age") <= K.BASELINE_ROWS
    return (
        panel.withColumn("__age", F.row_number().over(recent))
        .groupBy("station_code", "station_name")
        .agg(
            F.median("vendor_capacity").alias("current_vendor_count"),
            F.median(per_vendor).alias("orders_per_vendor"),
            money_sum(F.col("revenue")).alias("revenue"),
            F.sum("order_count").alias("orders"),
            F.avg(F.when(newest, F.col("order_count"))).alias("baseline_daily_orders"),
        )
        .withColumn("average_order_value", F.col("revenue") / F.greatest(F.col("orders"), F.lit(1)))
    )


def seed_histories(panel: DataFrame, length: int = K.HISTORY_LENGTH) -> DataFrame:
    """Last demand values of every station in date order, over gaps."""
    recent = Window.partitionBy("station_code").orderBy(F.col("date").desc())
    kept = panel.withColumn("__age", F.row_number().over(recent)).filter(F.col("__age") <= length)
    listed = F.array_sort(F.collect_list(F.struct("date", F.col("order_count").cast("double").alias("n"))))
    return kept.groupBy("station_code").agg(F.transform(listed, lambda x: x["n"]).alias("history"))


def horizon_days(panel: DataFrame, calendar: DataFrame, days: int = K.HORIZON_DAYS) -> DataFrame:
    """The forecast dates with their calendar signals: one row per day of the horizon."""
    last = panel.agg(F.max("date").alias("last"))
    span = F.sequence(F.date_add("last", 1), F.date_add("last", days))
    return (
        last.select(F.explode(span).alias("date")).join(calendar, "date", "left")
        .na.fill(0, list(K.CALENDAR_FLAGS))
        .withColumns({
            "month": F.month("date"),
            "day_of_week": dates.weekday(F.col("date")),
            "is_weekend": dates.weekend(F.col("date")),
        })
    )


def _state(panel: DataFrame, calendar: DataFrame, days: int) -> DataFrame:
    calendar_days = horizon_days(panel, calendar, days)
    # As many rows as the horizon has days.
    listed = calendar_days.agg(F.array_sort(F.collect_list(F.struct(
        "date", "month", "day_of_week", "is_weekend", *K.CALENDAR_FLAGS, "event_name", "event_type",
    )))).scalar()
    return (station_profiles(panel).join(seed_histories(panel), "station_code")
            .withColumn("days", listed))


def append(history: Column, value: Column, length: int = K.HISTORY_LENGTH) -> Column:
    """The array with one more value, cut to its last `length`."""
    start = F.greatest(F.size(history) - (length - 2), F.lit(1))
    return F.slice(F.concat(history, F.array(value)), start, F.lit(length))


def mean(history: Column) -> Column:
    return F.aggregate(history, F.lit(0.0), lambda total, x: total + x) / F.size(history)


def _features(day: Column, history: Column) -> dict[str, Column]:
    names = ("month", "day_of_week", "is_weekend") + K.CALENDAR_FLAGS
    return {name: day[name] for name in names} | {
        "lag_1_demand": F.element_at(history, -1),
        "rolling_7_demand": mean(history),
        "vendor_capacity": F.col("current_vendor_count"),
    }


def _unrolled(state: DataFrame) -> DataFrame:
    """One row per station and day from the day and forecast arrays."""
    steps = F.arrays_zip(F.col("days").alias("day"), F.col("forecasts").alias("prediction"))
    return (
        state.withColumn("__step", F.explode(steps))
        .select("*", F.col("__step.day.*"), F.col("__step.prediction").alias("prediction"))
        .drop("__step", "days", "forecasts", "history")
    )


def momentum(features: Mapping[str, Column]) -> Column:
    """Plain estimate: the mean of yesterday and the last week, raised on weekends and event days."""
    base = 0.5 * features["lag_1_demand"] + 0.5 * features["rolling_7_demand"]
    uplift = (1 + 0.05 * features["is_weekend"] + 0.20 * features["festival_flag"]
              + 0.10 * features["holiday_flag"] - 0.05 * features["local_event_flag"])
    return base * uplift


def _folded(state: DataFrame, formula: Formula) -> DataFrame:
    """All days of the horizon inside one projection."""
    def step(acc: Column, day: Column) -> Column:
        value = F.greatest(formula(_features(day, acc["history"])), F.lit(0.0))
        return F.struct(
            append(acc["history"], value).alias("history"),
            F.concat(acc["forecasts"], F.array(value)).alias("forecasts"))

    start = F.struct(F.col("history"), F.array().cast("array<double>").alias("forecasts"))
    return _unrolled(state.withColumn("forecasts", F.aggregate("days", start, step)["forecasts"]))


def forecast_by_formula(
    panel: DataFrame, calendar: DataFrame, formula: Formula = momentum, days: int = K.HORIZON_DAYS,
) -> DataFrame:
    """Station-by-day predictions of a formula over the feature columns."""
    return _folded(_state(panel, calendar, days), formula)


def forecast_by_model(panel: DataFrame, calendar: DataFrame, model, days: int = K.HORIZON_DAYS) -> DataFrame:
    """Station-by-day predictions of a fitted model (see `plans.learning`).

    The model is turned into a formula, so the jobs do not grow with the horizon: no pass over the stations per day.
    """
    return _folded(pin(model.with_levels(_state(panel, calendar, days))), model.formula())
