"""Daily station forecast: from order lines to readiness, routes and alerts for the next 30 days."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.operators import cleaning, horizon, metrics, orders, panel, readiness, split
from platterflow.plans import learning, publish
from platterflow.session import keep, pin
from platterflow.sources import dimensions

@dataclass
class DailyForecast:
    """The published tables of one run."""

    metadata: DataFrame
    evaluation: DataFrame
    stations: DataFrame
    daily: DataFrame
    routes: DataFrame
    alerts: DataFrame

    def sections(self) -> dict[str, DataFrame]:
        return {"metadata": self.metadata, "evaluation": self.evaluation, "stationForecasts": self.stations,
                "dailyForecasts": self.daily, "routeForecasts": self.routes, "eventAlerts": self.alerts}


def evaluate(train: DataFrame, test: DataFrame, trees=K.DAILY_TREES) -> DataFrame:
    """Errors of a model fitted before the holdout, with the holdout's dates and sizes."""
    trained, _ = split.require_rows(train, test, K.MIN_DAILY_TRAINING_ROWS)
    scored = fit(train, trees).score(test).withColumn(
        "prediction", F.greatest("prediction", F.lit(0.0)))
    scored = pin(scored.select("date", "order_count", "prediction"))
    span = scored.agg(F.min("date").alias("start"), F.max("date").alias("end"))
    errors = metrics.regression_metrics(scored, "order_count", "prediction")
    return errors.select(
        F.date_format(span.select("start").scalar(), "yyyy-MM-dd").alias("testStart"),
        F.date_format(span.select("end").scalar(), "yyyy-MM-dd").alias("testEnd"),
        "rmse", "mae", "r2", F.lit(trained).alias("trainingRows"), F.col("rows").alias("testRows"))


def fit(frame: DataFrame, trees=K.DAILY_TREES) -> learning.FittedModel:
    return learning.fit_trees(frame, K.DAILY_CATEGORIES, K.DAILY_NUMBERS, "order_count",
                              K.DAILY_MIN_FREQUENCY, trees)


def run(
    lines: DataFrame, calendar_rows: DataFrame, trees=K.DAILY_TREES, days: int = K.HORIZON_DAYS,
    lagged_capacity: bool = False,
) -> DailyForecast:
    """Evaluate on the last 30 days, refit on all, forecast, and roll up.

    The lines are read once; everything after the cube of visits works on station-day sizes.
    """
    delivered = orders.delivered_orders(cleaning.delivered_lines(lines))
    cube = keep(panel.visits(delivered))
    station_days = pin(panel.station_days(cube))
    calendar = pin(dimensions.collapse_calendar(calendar_rows))
    features = pin(panel.complete_days(
        panel.daily_features(station_days, calendar, lagged_capacity)))
    evaluation = evaluate(*split.split_last_days(features), trees)
    forecast = horizon.forecast_by_model(station_days, calendar, fit(features, trees), days)
    return assemble(cube, forecast, evaluation, days)


def assemble(cube: DataFrame, forecast: DataFrame, evaluation: DataFrame, days: int = K.HORIZON_DAYS) -> DailyForecast:
    """The published tables from the cube of visits, the forecast of its stations, and the errors of its model."""
    daily = pin(readiness.daily_readiness(forecast))
    shares = readiness.route_shares(pin(readiness.route_days(cube)))
    metadata = daily.agg(
        F.lit(K.DAILY_MODEL).alias("model"), F.min("date").alias("forecastStart"),
        F.max("date").alias("forecastEnd"), F.lit(days).alias("forecastDays"),
        F.lit(K.ROUTE_METHOD).alias("routeForecastMethod"))
    return DailyForecast(
        metadata, evaluation, readiness.station_outlook(daily, days), daily,
        readiness.route_outlook(daily, shares), readiness.event_alerts(daily))


def write(result: DailyForecast, output: str) -> DataFrame:
    """Publish every section as JSON records, all or none; returns the run's counters."""
    with publish.Publication(result.daily.sparkSession, output) as sections:
        written = {name: sections.write(publish.nulls_for_nan(frame), name) for name, frame in result.sections().items()}
        counted = {name: written[name].count() for name in ("stationForecasts", "routeForecasts", "eventAlerts")}
    counters = written["evaluation"].select(
        F.lit(output).alias("output"), F.lit(counted["stationForecasts"]).alias("stations"),
        F.lit(counted["routeForecasts"]).alias("routes"),
        F.lit(counted["eventAlerts"]).alias("alerts"), F.struct("*").alias("evaluation"))
    return pin(counters)
