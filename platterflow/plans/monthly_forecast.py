"""Monthly station forecast with its trend, weekly split and item lists."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.operators import cleaning, details, items, monthly, orders
from platterflow.plans import learning, publish
from platterflow.session import pin

Estimator = Callable[[DataFrame, DataFrame], DataFrame]
MODEL = "Boosted-tree monthly station-demand forecast"
NOTE = ("{year} cancellation and revenue-loss values are forecast estimates based on historical "
        "station-month cancellation behaviour.")


@dataclass
class MonthlyForecast:
    metadata: DataFrame
    cards: DataFrame
    details: DataFrame
    ranking: DataFrame


def tree_estimate(trees=K.MONTHLY_TREES) -> Estimator:
    """Estimator that fits boosted trees on the training months."""
    def estimate(train: DataFrame, targets: DataFrame) -> DataFrame:
        model = learning.fit_trees(train, K.MONTHLY_CATEGORIES, K.MONTHLY_NUMBERS, "orderCount",
                                   K.MONTHLY_MIN_FREQUENCY, trees)
        orders_estimate = F.greatest(F.col("prediction"), F.lit(0.0)).alias("modelOrders")
        return model.score(targets).select(*targets.columns, orders_estimate)
    return estimate


def run(
    lines: DataFrame, forecast_year: int = K.FORECAST_YEAR, months: Sequence[int] = K.FORECAST_MONTHS,
    estimator: Estimator | None = None,
) -> MonthlyForecast:
    """The lines are read twice, by order and by item; all else works on station-week sizes."""
    booked = cleaning.booked_lines(lines)
    cube = pin(monthly.booking_cube(orders.booked_orders(booked)))
    units = pin(items.item_weeks(booked, months))
    history, weeks = pin(monthly.station_months(cube, months)), pin(monthly.station_weeks(cube))
    train = monthly.training_months(history, months)
    targets = monthly.forecast_targets(train, forecast_year, months)
    estimates = (estimator or tree_estimate())(train, targets)
    cards = pin(monthly.monthly_cards(train, estimates, forecast_year))
    ranking = pin(items.item_ranking(items.month_items(units), cards, forecast_year))
    allocation = pin(monthly.weekly_allocation(weeks, cards, forecast_year))
    planned = items.weekly_items(items.week_items(units, forecast_year), weeks, allocation, forecast_year)
    nested = details.card_details(
        cards, monthly.station_trend(history, cards, forecast_year),
        items.items_by_year(ranking, cards, forecast_year), allocation, planned, forecast_year)
    keys = [f"{forecast_year}-{month:02d}" for month in months]
    metadata = lines.sparkSession.createDataFrame(
        [(MODEL, forecast_year, keys, NOTE.format(year=forecast_year))],
        "model string, forecastYear int, months array<string>, note string")
    return MonthlyForecast(metadata, cards, nested, ranking)


def write(result: MonthlyForecast, output: str) -> DataFrame:
    """Publish the sections as JSON records, all or none; returns the run's counters."""
    with publish.Publication(result.cards.sparkSession, output) as sections:
        sections.write(result.metadata, "metadata")
        cards = sections.write(publish.nulls_for_nan(result.cards), "stationSummaries")
        details_written = sections.write(result.details, "stationDetails").count()
        counters = pin(cards.agg(
            F.lit(output).alias("output"), F.count_distinct("stationCode").alias("stations"),
            F.count(F.lit(1)).alias("monthlyCards"), F.lit(details_written).alias("details")))
    return counters
