"""Station-by-month history and the monthly station forecast made from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.functions.aggregates import exact_sum, money_rollup, rows
from platterflow.functions.scores import at_least, percent_change, whole

MEASURES = ("forecastOrders", "forecastCancelledOrders", "predictedRevenue", "forecastRevenueLoss")


def booking_cube(orders: DataFrame) -> DataFrame:
    """Orders, cancellations, revenue and lost revenue per station and week of a month.

    Month and week tables both roll up from here, so the orders are aggregated once.
    """
    keys = ["station_code", "station_name", "year", "month_number", "month", "week_of_month"]
    lost = F.when(F.col("is_cancelled"), F.col("revenue"))
    return orders.groupBy(*keys).agg(
        rows().alias("orders"), F.count_if("is_cancelled").alias("cancelled"),
        exact_sum(F.col("revenue")).alias("revenue"), exact_sum(lost).alias("lost"))


def _kpis():
    return [
        F.sum("orders").alias("orderCount"), F.sum("cancelled").alias("cancelledOrders"),
        money_rollup(F.col("revenue")).alias("revenue"),
        money_rollup(F.col("lost")).alias("revenueLoss"),
    ]


def station_months(cube: DataFrame, months: Sequence[int] = K.FORECAST_MONTHS) -> DataFrame:
    """Key figures per station and month; a code takes the smallest of its names.

    `yearIndex` counts from the first year with a row in the forecast months.
    """
    grouped = cube.groupBy("station_code", "year", "month_number", "month").agg(
        F.min("station_name").alias("station_name"), *_kpis())
    first_year = cube.filter(F.col("month_number").isin(*months)).agg(F.min("year")).scalar()
    name = F.min("station_name").over(Window.partitionBy("station_code"))
    return grouped.select(
        F.col("station_code").alias("stationCode"), name.alias("stationName"), "year",
        F.col("month_number").alias("monthNumber"), "month",
        "orderCount", "cancelledOrders", "revenue", "revenueLoss",
        (F.col("cancelledOrders") / F.greatest("orderCount", F.lit(1))).alias("cancelRate"),
        (F.col("year") - first_year).alias("yearIndex"),
    )


def station_weeks(cube: DataFrame) -> DataFrame:
    """Key figures per station, month and week of the month."""
    return cube.groupBy(
        F.col("station_code").alias("stationCode"), "year",
        F.col("month_number").alias("monthNumber"), F.col("week_of_month").alias("weekOfMonth"),
    ).agg(*_kpis())


def training_months(history: DataFrame, months: Sequence[int] = K.FORECAST_MONTHS) -> DataFrame:
    return history.filter(F.col("monthNumber").isin(*months))


def forecast_targets(
    train: DataFrame, forecast_year: int = K.FORECAST_YEAR, months: Sequence[int] = K.FORECAST_MONTHS,
) -> DataFrame:
    """Every station of the training rows with every forecast month."""
    first_year = train.agg(F.min("year")).scalar()
    return (
        train.select("stationCode", "stationName").distinct()
        .withColumn("monthNumber", F.explode(F.array(*[F.lit(m) for m in months])))
        .withColumns({
            "yearIndex": F.lit(forecast_year) - first_year,
            "month": F.format_string("%d-%02d", F.lit(forecast_year), F.col("monthNumber")),
        })
    )


def trend_estimate(train: DataFrame, targets: DataFrame) -> DataFrame:
    """Plain estimate: the least-squares line over a station's same month in all years.

    Sums of integers make it exact; a single year gives that year's value.
    """
    x, y = F.col("yearIndex").cast("bigint"), F.col("orderCount")
    sums = train.groupBy("stationCode", "monthNumber").agg(
        rows().alias("n"), F.sum(x).alias("x"), F.sum(y).alias("y"),
        F.sum(x * y).alias("xy"), F.sum(x * x).alias("xx"))
    spread = F.col("n") * F.col("xx") - F.col("x") * F.col("x")
    slope = F.coalesce(
        F.try_divide(F.col("n") * F.col("xy") - F.col("x") * F.col("y"), spread), F.lit(0.0))
    lines = sums.select("stationCode", "monthNumber", "n", "x", "y", slope.alias("slope"))
    line = (F.col("y") - F.col("slope") * F.col("x")) / F.col("n") + F.col("slope") * F.col("yearIndex")
    joined = targets.join(lines, ["stationCode", "monthNumber"], "left")
    return joined.select(*targets.columns, at_least(line, 0.0).alias("modelOrders"))


def monthly_cards(
    train: DataFrame, estimates: DataFrame, forecast_year: int = K.FORECAST_YEAR,
) -> DataFrame:
    """Forecast per station and month: seasonal mean blended with the model's estimate.

    Targets without history of their month give no card.
    """
    reference_year = forecast_year - 1
    newest = Window.partitionBy("stationCode", "monthNumber").orderBy(F.desc("year"))
    seasonal = F.when(F.col("__age") <= K.SEASONAL_ROWS, F.col("orderCount"))
    in_reference = F.when(F.col("year") == reference_year, F.col("orderCount"))
    history = train.withColumn("__age", F.row_number().over(newest)).groupBy(
        "stationCode", "monthNumber").agg(
        F.coalesce(F.max(in_reference), F.max_by("orderCount", "year")).alias("referenceOrders"),
        F.avg(seasonal).alias("seasonal"),
        F.avg("cancelRate").alias("rate"),
        F.avg(F.col("revenue") / F.greatest("orderCount", F.lit(1))).alias("value"),
        F.count_distinct("year").alias("historicalYears"),
        (F.stddev_pop("orderCount") / at_least(F.avg("orderCount"), 1.0)).alias("volatility"),
    )
    blended = K.SEASONAL_WEIGHT * F.col("seasonal") + K.MODEL_WEIGHT * F.col("modelOrders")
    score = (K.CONFIDENCE_BASE + F.col("historicalYears") * K.CONFIDENCE_PER_YEAR
             - F.col("volatility") * K.CONFIDENCE_PER_VOLATILITY)
    kept = F.greatest(F.lit(float(K.CONFIDENCE_LOW)), F.least(F.lit(float(K.CONFIDENCE_HIGH)), score))
    cards = estimates.join(history, ["stationCode", "monthNumber"])
    cards = cards.withColumn("forecastOrders", whole(at_least(blended, 0.0)))
    cards = cards.withColumn("predictedRevenue", whole(F.col("forecastOrders") * F.col("value")))
    return cards.select(
        "stationCode", "stationName", "month", "monthNumber", "forecastOrders",
        percent_change(F.col("forecastOrders"), F.col("referenceOrders")).alias("predictedPercentage"),
        whole(F.col("forecastOrders") * F.col("rate")).alias("forecastCancelledOrders"),
        whole(F.col("predictedRevenue") * F.col("rate")).alias("forecastRevenueLoss"),
        "predictedRevenue",
        kept.cast("bigint").alias("confidenceScore"),
        "referenceOrders", "historicalYears",
        F.bround(F.col("rate") * 100, 1).alias("averageCancellationRate"),
    )


def station_trend(history: DataFrame, cards: DataFrame, forecast_year: int = K.FORECAST_YEAR) -> DataFrame:
    """Same-month figures of the years before the forecast, and the forecast itself."""
    years = range(forecast_year - K.TREND_YEARS, forecast_year)
    past = history.filter(F.col("year").isin(*years)).join(
        cards.select("stationCode", "monthNumber"), ["stationCode", "monthNumber"])
    return past.select(
        "stationCode", "monthNumber", "year", F.col("orderCount").alias("orders"), "cancelledOrders",
        F.col("revenue").cast("bigint").alias("revenue"),
        F.col("revenueLoss").cast("bigint").alias("revenueLoss"),
        F.lit(False).alias("isForecast"),
    ).unionByName(cards.select(
        "stationCode", "monthNumber", F.lit(forecast_year).alias("year"),
        F.col("forecastOrders").alias("orders"),
        F.col("forecastCancelledOrders").alias("cancelledOrders"),
        F.col("predictedRevenue").alias("revenue"), F.col("forecastRevenueLoss").alias("revenueLoss"),
        F.lit(True).alias("isForecast"),
    ))


def card_weeks(cards: DataFrame) -> DataFrame:
    """Weeks of every card's month with their first and last day."""
    start = F.to_date(F.concat("month", F.lit("-01")))
    weeks = F.ceil(F.dayofmonth(F.last_day(start)) / 7).cast("int")
    day = F.date_add("__start", (F.col("weekOfMonth") - 1) * 7)
    return (
        cards.withColumn("__start", start)
        .withColumn("weekOfMonth", F.explode(F.sequence(F.lit(1), weeks)))
        .withColumns({"weekStart": day, "weekEnd": F.least(F.date_add(day, 6), F.last_day("__start"))})
        .drop("__start")
    )


def weekly_allocation(weeks: DataFrame, cards: DataFrame, forecast_year: int = K.FORECAST_YEAR) -> DataFrame:
    """Cards spread over their weeks by the station's share of orders per week.

    The reference year's weeks are used where it has any, else those of all years, else equal
    shares.  What rounding leaves over goes to the first week, so the weeks add up to the card.
    """
    in_reference = F.col("year") == forecast_year - 1
    card = Window.partitionBy("stationCode", "monthNumber")
    history = (
        weeks.groupBy("stationCode", "monthNumber", "weekOfMonth").agg(
            F.sum(F.when(in_reference, F.col("orderCount"))).alias("ref"),
            F.sum("orderCount").alias("all"))
        .withColumn("__has_ref", F.count("ref").over(card) > 0)
        .select("stationCode", "monthNumber", "weekOfMonth",
                F.when(F.col("__has_ref"), F.coalesce("ref", F.lit(0))).otherwise(F.col("all")).alias("n"))
    )
    spread = card_weeks(cards).join(history, ["stationCode", "monthNumber", "weekOfMonth"], "left")
    n = F.coalesce("n", F.lit(0))
    total = F.sum(n).over(card)
    spread = spread.withColumn("share", F.when(total == 0, 1 / F.count(F.lit(1)).over(card))
                               .otherwise(n / F.greatest(total, F.lit(1))))
    rounded = spread.withColumns({f"__{m}": whole(F.col(m) * F.col("share")) for m in MEASURES})
    first = F.col("weekOfMonth") == 1

    def settled(m: str):
        rest = F.col(m) - F.sum(f"__{m}").over(card)
        return F.when(first, F.col(f"__{m}") + rest).otherwise(F.col(f"__{m}")).alias(m)

    label = F.concat(
        F.lit("Week "), F.col("weekOfMonth"), F.lit(" · "), F.date_format("weekStart", "dd MMM"),
        F.lit(" - "), F.date_format("weekEnd", "dd MMM"))
    return rounded.select(
        "stationCode", "month", "monthNumber", F.col("weekOfMonth").alias("week"),
        label.alias("label"), "share", F.col("__forecastOrders").alias("weeklyOrders"),
        *[settled(m) for m in MEASURES])
