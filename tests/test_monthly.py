
import statistics

import pytest
from pyspark.sql import functions as F

from platterflow.operators import details, items, monthly
from platterflow.operators.monthly import MEASURES

CUBE = ("station_code string, station_name string, year int, month_number int, month string, week_of_month int, "
        "orders bigint, cancelled bigint, revenue double, lost double")


def cube(spark, *rows):
    full = [(c, c, y, m, f"{y}-{m:02d}", w, n, x, float(n) * 10, float(x) * 10) for c, y, m, w, n, x in rows]
    frame = spark.createDataFrame(full, CUBE)
    return frame.withColumns({c: F.col(c).cast("decimal(28,4)") for c in ("revenue", "lost")})


def cards(spark, frame, year=2026, months=(8, 9)):
    train = monthly.training_months(monthly.station_months(frame, months), months)
    targets = monthly.forecast_targets(train, year, months)
    estimates = targets.withColumn("modelOrders", F.lit(100.0))
    return monthly.monthly_cards(train, estimates, year)


def test_card_blends_seasonal_and_model(spark):
    frame = cube(spark, ("A", 2021, 8, 1, 1000, 0), ("A", 2023, 8, 1, 50, 10), ("A", 2024, 8, 1, 60, 6), ("A", 2025, 8, 1, 70, 7))
    got = cards(spark, frame).collect()
    assert len(got) == 1  # no history of September, no card
    card = got[0]
    assert card.forecastOrders == 72 and card.referenceOrders == 70  # 0.7 * 60 + 0.3 * 100
    assert card.predictedPercentage == 2.9 and card.historicalYears == 4
    assert card.predictedRevenue == 720 and card.averageCancellationRate == 10.0
    assert card.forecastCancelledOrders == 7 and card.forecastRevenueLoss == 72
    volatility = statistics.pstdev([1000, 50, 60, 70]) / 295
    assert card.confidenceScore == int(56 + 4 * 13 - volatility * 12) == 91 and card.month == "2026-08"


def test_latest_year_stands_in_for_a_missing_reference(spark):
    got = cards(spark, cube(spark, ("A", 1998, 8, 1, 10, 0), ("A", 1999, 8, 1, 20, 0))).first()
    assert got.referenceOrders == 20 and got.historicalYears == 2


def test_trend_estimate_is_a_line(spark):
    frame = cube(spark, ("A", 2023, 8, 1, 10, 0), ("A", 2024, 8, 1, 20, 0), ("A", 2025, 8, 1, 30, 0), ("B", 2025, 9, 1, 7, 0))
    train = monthly.training_months(monthly.station_months(frame, (8, 9)), (8, 9))
    got = monthly.trend_estimate(train, monthly.forecast_targets(train, 2026, (8, 9))).collect()
    assert {(r.stationCode, r.monthNumber): r.modelOrders for r in got} == {
        ("A", 8): pytest.approx(40.0), ("A", 9): 0.0, ("B", 8): 0.0, ("B", 9): 7.0}


CARD = ("stationCode string, stationName string, month string, monthNumber int, forecastOrders bigint, "
        "predictedPercentage double, forecastCancelledOrders bigint, forecastRevenueLoss bigint, predictedRevenue bigint, "
        "confidenceScore bigint, referenceOrders bigint, historicalYears bigint, averageCancellationRate double")


def card(code="A", month=8, orders=10, cancelled=3, loss=31, revenue=101, reference=10, year=2026):
    return (code, code, f"{year}-{month:02d}", month, orders, 0.0, cancelled, loss, revenue, 80, reference, 3, 10.0)


def weeks_frame(spark, *rows):
    return spark.createDataFrame(list(rows), "stationCode string, year int, monthNumber int, weekOfMonth int, orderCount bigint")


def test_rounding_rest_goes_to_the_first_week(spark):
    weeks = weeks_frame(spark, ("A", 2025, 2, 1, 5), ("A", 2025, 2, 2, 5), ("A", 2025, 2, 3, 5))
    frame = spark.createDataFrame([card(month=2)], CARD)
    got = monthly.weekly_allocation(weeks, frame).orderBy("week").collect()
    assert [r.forecastOrders for r in got] == [4, 3, 3, 0]
    assert got[0].label == "Week 1 · 01 Feb - 07 Feb" and got[3].label == "Week 4 · 22 Feb - 28 Feb"


def test_no_weekly_history_is_spread_evenly(spark):
    frame = spark.createDataFrame([card(orders=50)], CARD)
    got = monthly.weekly_allocation(weeks_frame(spark, ("Z", 2025, 8, 1, 1)), frame).orderBy("week").collect()
    assert [r.forecastOrders for r in got] == [10] * 5 and got[4].label == "Week 5 · 29 Aug - 31 Aug"


def test_other_years_serve_where_the_reference_year_has_no_week(spark):
    weeks = weeks_frame(spark, ("A", 2024, 8, 1, 1), ("A", 2023, 8, 2, 3), ("B", 2025, 8, 1, 2), ("B", 2024, 8, 2, 9))
    frame = spark.createDataFrame([card("A", orders=8), card("B", orders=8)], CARD)
    got = {(r.stationCode, r.week): r.forecastOrders for r in monthly.weekly_allocation(weeks, frame).collect()}
    assert got["A", 1] == 2 and got["A", 2] == 6 and got["B", 1] == 8 and got["B", 2] == 0


@pytest.mark.parametrize("seed", range(3))
def test_weeks_add_up_to_the_card(spark, seed):
    rows = [("A", 2025, m, w, (seed * 7 + m * w * 3) % 11) for m in (8, 9, 12) for w in range(1, 6)]
    listed = [card(month=m, orders=97 + seed, cancelled=13, loss=777, revenue=12345 + seed) for m in (8, 9, 12)]
    frame = spark.createDataFrame(listed, CARD)
    sums = monthly.weekly_allocation(weeks_frame(spark, *rows), frame).groupBy("monthNumber").agg(*[F.sum(m).alias(m) for m in MEASURES])
    want = frame.select("monthNumber", *MEASURES)
    assert sums.exceptAll(want).count() == 0 and sums.count() == 3


UNITS = "stationCode string, stationName string, year int, monthNumber int, weekOfMonth int, item string, units double"


def units_frame(spark, *rows):
    return spark.createDataFrame([(c, c, y, m, w, i, float(u)) for c, y, m, w, i, u in rows], UNITS)


def test_item_forecast_follows_the_reference_year_or_the_latest(spark):
    units = units_frame(
        spark, ("A", 2025, 8, 1, "rice", 5), ("A", 2025, 8, 2, "rice", 5), ("A", 2025, 8, 1, "dal", 3), ("A", 2024, 8, 1, "old", 99),
        ("B", 2024, 8, 1, "roti", 4), ("B", 2023, 8, 1, "roti", 9))
    frame = spark.createDataFrame([card("A", orders=20), card("B", orders=5)], CARD)
    ranking = items.item_ranking(items.month_items(units), frame)
    got = sorted((r.stationCode, r["rank"], r.item, r.units) for r in ranking.filter("isForecast").collect())
    assert got == [("A", 1, "rice", 20.0), ("A", 2, "dal", 6.0), ("B", 1, "roti", 2.0), ("B", 1, "roti", 4.0)]


def test_equal_units_rank_by_name(spark):
    units = units_frame(spark, *[("A", 2025, 8, 1, name, 1) for name in "kjihgfedcba"])
    got = items.month_items(units).orderBy("rank").collect()
    assert [r.item for r in got] == list("abcdefghij")


def test_week_items_prefer_the_reference_year(spark):
    units = units_frame(spark, ("A", 2025, 8, 1, "rice", 1), ("A", 2024, 8, 1, "dal", 9), ("A", 2024, 8, 2, "dal", 4), ("A", 2023, 8, 2, "dal", 2))
    ranked = items.week_items(units)
    got = sorted((r.weekOfMonth, r["rank"], r.item, r.units) for r in ranked.collect())
    assert got == [(1, 1, "rice", 1.0), (2, 1, "dal", 6.0)]
    weeks = weeks_frame(spark, ("A", 2025, 8, 1, 2), ("A", 2024, 8, 2, 3))
    frame = spark.createDataFrame([card("A", orders=10)], CARD)
    planned = items.weekly_items(ranked, weeks, monthly.weekly_allocation(weeks, frame))
    assert sorted((r.week, r.item, r.units) for r in planned.collect()) == [(1, "rice", 5), (2, "dal", 0)]


def test_detail_nests_every_list(spark):
    history = monthly.station_months(cube(spark, ("A", 2024, 8, 1, 4, 1), ("A", 2025, 8, 2, 6, 0), ("A", 2021, 8, 1, 9, 0)), (8,))
    frame = cards(spark, cube(spark, ("A", 2024, 8, 1, 4, 1), ("A", 2025, 8, 2, 6, 0)), months=(8,))
    units = units_frame(spark, ("A", 2025, 8, 2, "rice", 6))
    weeks = weeks_frame(spark, ("A", 2025, 8, 2, 6))
    allocation = monthly.weekly_allocation(weeks, frame)
    got = details.card_details(
        frame, monthly.station_trend(history, frame), items.items_by_year(items.item_ranking(items.month_items(units), frame), frame),
        allocation, items.weekly_items(items.week_items(units), weeks, allocation)).collect()
    assert len(got) == 1
    record = got[0]
    assert [(t.year, t.isForecast) for t in record.trend] == [(2024, False), (2025, False), (2026, True)]
    assert [(y.year, len(y["items"])) for y in record.topItemsByYear] == [(2022, 0), (2023, 0), (2024, 0), (2025, 1), (2026, 1)]
    assert [w.week for w in record.weeklyForecast] == [1, 2, 3, 4, 5]
    assert [len(w.topItems) for w in record.weeklyForecast] == [0, 1, 0, 0, 0]
    assert sum(w.forecastOrders for w in record.weeklyForecast) == record.forecastOrders
    assert record.drivers[1] == "2025 reference volume: 6 orders"


