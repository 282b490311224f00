"""The event calendar, the station dimension, and results of earlier jobs read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.functions import coerce
from platterflow.functions.aggregates import first_row
from platterflow.sources.exports import exists, read_exports
from platterflow.sources.published import resolve

CALENDAR_SCHEMA = (
    "date date, event_name string, event_type string, "
    "festival_flag int, holiday_flag int, local_event_flag int"
)
ITEM_FORECAST_SCHEMA = (
    "forecast_month string, rank bigint, food_item string, forecast_quantity double"
)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Calendar rows as text, with the order of the rows over all files; no rows when the path is absent."""
    if not exists(spark, path):
        return spark.createDataFrame([], "date string, row_order bigint")
    return read_exports(spark, path).drop("line_file").withColumnRenamed("line_order", "row_order")


def collapse_calendar(rows: DataFrame) -> DataFrame:
    """One row per date: distinct names and types joined in order of appearance, flags by maximum.

    Each distinct text is reduced to its first position before anything is collected, so what one
    date gathers is its distinct texts and not its rows.
    """
    types = dict(rows.dtypes)
    day = coerce.instant(F.col("date"), types["date"]).cast("date")
    flags = [
        (coerce.flag(F.col(c), types[c]) if c in types else F.lit(0)).alias(c)
        for c in K.CALENDAR_FLAGS
    ]
    texts = [
        (F.coalesce(F.col(c), F.lit(d)) if c in types else F.lit(d)).alias(c)
        for c, d in K.CALENDAR_DEFAULTS.items()
    ]
    order = F.col("row_order") if "row_order" in types else F.lit(0)
    typed = rows.select(day.alias("date"), *texts, *flags, order.alias("row_order"))
    pairs = (
        typed.filter(F.col("date").isNotNull())
        .groupBy("date", "event_name", "event_type")
        .agg(F.min("row_order").alias("row_order"), *[F.max(c).alias(c) for c in K.CALENDAR_FLAGS])
    )
    return pairs.groupBy("date").agg(
        _joined("event_name").alias("event_name"),
        _joined("event_type").alias("event_type"),
        *[F.max(c).alias(c) for c in K.CALENDAR_FLAGS],
    )


def _joined(column: str):
    listed = F.array_sort(F.collect_set(F.struct("row_order", column)))
    return F.array_join(F.array_distinct(F.transform(listed, lambda x: x[column])), " / ")


def read_station_map(spark: SparkSession, path: str) -> DataFrame:
    """Station dimension, every column text and every missing cell empty."""
    return spark.read.option("header", True).csv(path).na.fill("")


def read_station_states(spark: SparkSession, path: str) -> DataFrame:
    """One state per station code, the first that the map lists."""
    return station_states(read_exports(spark, path).na.fill("", ["state"]), "line_order")


def station_template(lines: DataFrame) -> DataFrame:
    """Distinct stations with an empty state, for a user to fill in."""
    return lines.select("station_code", F.col("station").alias("station")).distinct().withColumn(
        "state", F.lit(""))


def station_states(station_map: DataFrame, order: str | None = None) -> DataFrame:
    """One state per station code: the first listed, by `order` where the map has such a column."""
    position = F.col(order) if order else F.monotonically_increasing_id()
    picked = (station_map.withColumn("__position", position)
              .groupBy("station_code").agg(first_row(["state"], F.col("__position")).alias("s")))
    return picked.select("station_code", F.col("s.state").alias("state"))


def read_item_forecast(spark: SparkSession, path: str) -> DataFrame:
    """Ranked item forecast written by the item job; no rows when it has not run."""
    if not exists(spark, path):
        return spark.createDataFrame([], ITEM_FORECAST_SCHEMA)
    return spark.read.option("header", True).schema(ITEM_FORECAST_SCHEMA).csv(path)


def read_payload(spark: SparkSession, path: str) -> DataFrame | None:
    """JSON records of an earlier job, or None when they are absent. Of a published section the current version is read."""
    found = resolve(spark, path)
    return spark.read.json(found) if exists(spark, found) else None
