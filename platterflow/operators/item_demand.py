"""Item-by-month demand, its supervised frames, and the ranked forecast of the next month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.functions import coerce, dates
from platterflow.functions.aggregates import units_sum
from platterflow.operators.cleaning import column_instant, line_order
from platterflow.operators.ordering import global_rank
from platterflow.operators.split import latest
from platterflow.session import keep


def adapt_schema(raw: DataFrame) -> DataFrame:
    """Demand rows in the generic schema, from that schema or from an order export."""
    if not set(K.ITEM_REQUIRED) <= set(raw.columns):
        if not set(K.EXPORT_REQUIRED) <= set(raw.columns):
            missing = sorted(set(K.ITEM_REQUIRED) - set(raw.columns))
            raise ValueError("Input is missing required columns: " + ", ".join(missing))
        if "order_status" in raw.columns:
            raw = raw.filter(coerce.is_fulfilled(F.col("order_status")))
        discount = F.lit(0.0)
        if "discount" in raw.columns:
            discount = coerce.number_or_zero(F.col("discount"), dict(raw.dtypes)["discount"])
        raw = raw.withColumnsRenamed(K.EXPORT_RENAMES).withColumn(
            "promotion_active", (discount > 0).cast("int"))
    types = dict(raw.dtypes)
    typed = raw.withColumns({
        "date": column_instant(raw, "date"),
        "quantity_sold": coerce.number(F.col("quantity_sold"), types["quantity_sold"]),
        "line_order": line_order(raw),
    }).na.drop(subset=list(K.ITEM_REQUIRED))
    return typed.withColumn("month", F.trunc("date", "MM"))


def item_months(demand: DataFrame) -> DataFrame:
    """One row per observed month and item, with the optional columns the input has.

    The columns that are read are written once, unshuffled: rows of one vendor, city and region are few, so combining them
    first would move all rows and leave most.  The distinct counts and the last values are then taken from that table
    separately: counting several columns repeats its rows, and only the narrow keys are repeated that way.
    """
    present = [c for c in K.ITEM_OPTIONAL_CATEGORIES + K.ITEM_OPTIONAL_NUMBERS + K.ITEM_EXTRA_LAST
               if c in demand.columns]
    distinct = {"outlet_name": "vendor_availability", "city": "city_coverage", "region": "region_coverage"}
    distinct = {c: name for c, name in distinct.items() if c in demand.columns}
    lasts = [c for c in present if c not in distinct.values()]
    carried = [c for c in lasts if c not in distinct]
    keys = ["month", "food_item"]

    def newest(column: str):
        return F.max(F.when(F.col(column).isNotNull(), F.struct("line_order", F.col(column).alias("value"))))

    rows = demand.select(*keys, *distinct, *carried, "quantity_sold", "line_order")
    if distinct:
        rows = keep(rows)
    monthly = rows.groupBy(*keys).agg(
        units_sum(F.col("quantity_sold")).alias("quantity_sold"), *[newest(c)["value"].alias(c) for c in lasts])
    if not distinct:
        return monthly
    counts = rows.groupBy(*keys).agg(
        *[F.count_distinct(c).alias(name) for c, name in distinct.items()])
    return monthly.join(counts, keys)


def _target_parts(frame: DataFrame, target) -> DataFrame:
    return frame.withColumns({
        "month_number": F.month(target), "year": F.year(target), "quarter": F.quarter(target)})


def with_month_lags(monthly: DataFrame) -> DataFrame:
    """Lags and the label over the observed months of each item; months without sales are no rows."""
    observed = Window.partitionBy("food_item").orderBy("month")
    quantity = F.col("quantity_sold")
    return monthly.withColumns({
        "lag_1_month": F.lag(quantity, 1).over(observed),
        "lag_3_month": F.lag(quantity, 3).over(observed),
        "rolling_3_month_mean": F.avg(quantity).over(observed.rowsBetween(-3, -1)),
        "target_month": F.lead("month").over(observed),
        "next_month_quantity": F.lead(quantity).over(observed),
    })


def training_pairs(lagged: DataFrame) -> DataFrame:
    """Rows whose next observed month is the next calendar month."""
    consecutive = F.col("target_month") == dates.next_month(F.col("month"))
    pairs = lagged.filter(consecutive).na.drop(subset=["next_month_quantity"])
    return _target_parts(pairs, F.col("target_month"))


def future_items(lagged: DataFrame) -> DataFrame:
    """Items of the latest month, with the parts of the month to forecast."""
    future = lagged.filter(F.col("month") == latest(lagged, "month")).drop("target_month", "next_month_quantity")
    target = dates.next_month(F.col("month"))
    return _target_parts(future.withColumn("forecast_month", dates.month_key(target)), target)


def feature_lists(columns: list[str]) -> tuple[list[str], list[str]]:
    """(text features, numeric features) a frame can offer."""
    texts = ["food_item"] + [c for c in K.ITEM_OPTIONAL_CATEGORIES if c in columns]
    optional = [c for c in K.ITEM_OPTIONAL_NUMBERS + K.ITEM_COVERAGE if c in columns]
    return texts, list(K.ITEM_NUMBERS) + optional


def recent_mean(future: DataFrame) -> DataFrame:
    """Plain estimate: the mean of the three observed months before, else the last month."""
    return future.withColumn("prediction", F.coalesce("rolling_3_month_mean", "quantity_sold"))


def ranked_forecast(scored: DataFrame) -> DataFrame:
    """Forecast quantities of the next month, best item first."""
    listed = scored.select(
        "forecast_month", "food_item",
        F.greatest(F.col("prediction"), F.lit(0.0)).alias("forecast_quantity"))
    ranked = global_rank(listed, [F.col("forecast_quantity").desc(), F.col("food_item")])
    return ranked.select("forecast_month", "rank", "food_item", "forecast_quantity")
