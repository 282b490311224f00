"""Monthly key figures, station rankings and the enriched item forecast for the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.operators import cleaning, dashboard, orders
from platterflow.plans import publish
from platterflow.session import keep, pin
from platterflow.sources import dimensions
from platterflow.sources.exports import exists

def metadata(record: DataFrame, coverage: DataFrame, forecast: DataFrame, model: str) -> DataFrame:
    """The dashboard's record of availability, coverage and notes."""
    available = F.col("cancellation_model_available")
    return record.select(
        F.lit(model).alias("model"),
        forecast.agg(F.min("forecast_month")).scalar().alias("forecast_month"),
        "latest_observed_month", F.lit(K.QUALITY_NOTE).alias("data_quality_note"),
        "cancellation_model_available",
        F.when(available, K.CANCELLED_NOTE).otherwise(K.NOT_CANCELLED_NOTE).alias("cancellation_note"),
        coverage.select("state_mapping_coverage").scalar().alias("state_mapping_coverage"),
        F.lit(K.STATE_NOTE).alias("state_mapping_note"))


def run(lines: DataFrame, forecast: DataFrame, station_map: str, code_fallback: str = K.DASHBOARD_STATION_CODE_FALLBACK):
    """Sections of the dashboard.  The station map is written for a user to fill when absent.

    The lines are read twice: for the cube of lines and for the orders of the key figures.
    """
    spark = lines.sparkSession
    cleaned = cleaning.dashboard_lines(lines, code_fallback)
    cube = keep(dashboard.line_cube(cleaned))
    if not exists(spark, station_map):
        publish.write_missing_csv(
            dimensions.station_template(cube).orderBy("station_code", "station"), station_map)
    states = dimensions.read_station_states(spark, station_map)
    history = pin(dashboard.item_history(pin(dashboard.item_month_units(cube))))
    enriched = pin(dashboard.enriched_forecast(forecast, history))
    return {
        "metadata": metadata(dashboard.dashboard_record(cube), dashboard.state_coverage(cube, states),
                             enriched, "Boosted-tree demand trend prototype"),
        "monthly": dashboard.monthly_kpis(orders.dashboard_orders(cleaned)),
        "topItems": dashboard.station_month_items(cube),
        "forecast": enriched,
    }


def write(sections: dict[str, DataFrame], output: str, cancellation_metrics: str | None = None) -> DataFrame:
    """Publish the sections as JSON records, all or none, an earlier cancellation record among them; returns the run's counters."""
    spark = sections["metadata"].sparkSession
    record = dimensions.read_payload(spark, cancellation_metrics) if cancellation_metrics else None
    passed_on = {} if record is None else {"cancellationModel": record}
    with publish.Publication(spark, output) as published:
        counted = {name: published.write(frame, name, strict=False).count() for name, frame in (sections | passed_on).items()}
    return spark.createDataFrame([(output, counted["monthly"], counted["topItems"], counted["forecast"])],
                                 "output string, months bigint, rankings bigint, forecastItems bigint")
