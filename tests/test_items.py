import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from platterflow.operators import dashboard, item_demand, reports
from platterflow.sources import dimensions


def months(spark, *rows):
    return spark.createDataFrame([(dt.date(2024, m, 1), i, float(q)) for m, i, q in rows],
                                 "month date, food_item string, quantity_sold double")


def test_only_consecutive_months_train(spark):
    lagged = item_demand.with_month_lags(months(spark, (1, "rice", 5), (2, "rice", 7), (4, "rice", 9), (4, "dal", 1)))
    pairs = item_demand.training_pairs(lagged).collect()
    assert [(r.month.month, r.target_month.month, r.next_month_quantity, r.month_number, r.quarter) for r in pairs] == [(1, 2, 7.0, 2, 1)]
    future = {r.food_item: r for r in item_demand.future_items(lagged).collect()}
    assert future["rice"].lag_1_month == 7.0 and future["rice"].rolling_3_month_mean == 6.0
    assert future["dal"].lag_1_month is None and future["dal"].forecast_month == "2024-05"
    ranked = item_demand.ranked_forecast(item_demand.recent_mean(item_demand.future_items(lagged)))
    assert [(r["rank"], r.food_item, r.forecast_quantity) for r in ranked.orderBy("rank").collect()] == [(1, "rice", 6.0), (2, "dal", 1.0)]


def test_lags_count_observed_months(spark):
    lagged = item_demand.with_month_lags(months(spark, *[(m, "rice", m) for m in (1, 2, 5, 9)]))
    got = [(r.lag_1_month, r.lag_3_month, r.rolling_3_month_mean) for r in lagged.orderBy("month").collect()]
    assert got == [(None, None, None), (1, None, 1), (2, None, 1.5), (5, 1, pytest.approx(8 / 3))]


EXPORT = "created_at string, item_name string, quantity string, discount string, order_status string, station_name string, railway_zone string, outlet_name string, line_order int"


def test_export_schema_is_adapted(spark):
    raw = spark.createDataFrame([
        ("2024-01-05", "rice", "2", "5", "Delivered", "Alpha", "N", "v1", 1),
        ("2024-01-20", "rice", "3", "0", "Delivered", None, "S", "v2", 2),
        ("2024-01-20", "rice", "9", "0", "Cancelled", "Beta", "S", "v3", 3),
        ("bad", "rice", "9", "0", "Delivered", "Beta", "S", "v3", 4),
        ("2024-01-21", None, "9", "0", "Delivered", "Beta", "S", "v3", 5),
        ("2024-01-21", "dal", "x", "0", "Delivered", "Beta", "S", "v3", 6)], EXPORT)
    got = item_demand.item_months(item_demand.adapt_schema(raw)).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.quantity_sold, row.city, row.region, row.promotion_active) == (5.0, "Alpha", "S", 0)
    assert (row.vendor_availability, row.city_coverage, row.region_coverage) == (2, 1, 2)


def test_generic_schema_passes_through(spark):
    raw = spark.createDataFrame([("2024-01-05", "rice", 2.0, "sunny", 1), ("2024-01-06", "rice", 1.0, None, 0)],
                                "date string, food_item string, quantity_sold double, weather string, public_holiday int")
    panel = item_demand.item_months(item_demand.adapt_schema(raw))
    assert set(panel.columns) == {"month", "food_item", "quantity_sold", "weather", "public_holiday"}
    assert tuple(panel.select("quantity_sold", "weather", "public_holiday").first()) == (3.0, "sunny", 0)
    assert item_demand.feature_lists(panel.columns)[0] == ["food_item", "weather"]


def test_missing_discount_means_no_promotion(spark):
    raw = spark.createDataFrame([("2024-01-05", "rice", "2")], "created_at string, item_name string, quantity string")
    assert item_demand.adapt_schema(raw).first().promotion_active == 0


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="food_item, quantity_sold"):
        item_demand.adapt_schema(spark.createDataFrame([("2024-01-05",)], "date string"))


def dash(spark, *rows):
    lines = spark.createDataFrame(list(rows), "month string, station string, station_code string, item string, outlet_name string, quantity double, is_fulfilled boolean, is_cancelled boolean")
    return dashboard.line_cube(lines)


def test_station_rank_breaks_ties_by_lines_then_name(spark):
    lines = dash(spark, ("2024-01", "S", "s", "b", "v", 2.0, True, False), ("2024-01", "S", "s", "a", "v", 1.0, True, False),
                 ("2024-01", "S", "s", "a", None, 1.0, True, False), ("2024-01", "S", "s", "c", "v", 2.0, True, False),
                 ("2024-01", "S", "s", "gone", "v", 99.0, False, True))
    got = dashboard.station_month_items(lines).orderBy("rank").collect()
    assert [(r.item, r.order_lines, r.vendors) for r in got] == [("a", 2, 1), ("b", 1, 1), ("c", 1, 1)]


def test_enriched_forecast_tolerates_unknown_items(spark):
    lines = dash(spark, ("2024-01", "S", "s", "rice", "v", 1500.0, True, False), ("2024-02", "S", "s", "dal", "v", 2.0, True, False))
    history = dashboard.item_history(dashboard.item_month_units(lines))
    forecast = spark.createDataFrame([("2024-03", 1, "rice", 9.0), ("2024-03", 2, "new", 3.0)], dimensions.ITEM_FORECAST_SCHEMA)
    got = dashboard.enriched_forecast(forecast, history).collect()
    assert got[0].reason == "1 observed months; 1,500 historical units; 0 units in 2024-02."
    assert got[1].reason == "0 observed months; 0 historical units; 0 units in 2024-02." and got[1].units is None


def test_state_coverage_counts_lines(spark):
    lines = dash(spark, *[("2024-01", "S", c, "i", "v", 1.0, True, False) for c in "aaab"])
    mapping = spark.createDataFrame([("a", "A", "Bihar", 1), ("a", "A2", "", 0), ("c", "C", "x", 0)], "station_code string, station string, state string, n int")
    first = dashboard.state_coverage(lines, dimensions.station_states(mapping, "n")).first()
    assert (first.lines, first.mapped, first.state_mapping_coverage) == (4, 0, 0.0)
    by_name = dashboard.state_coverage(lines, dimensions.station_states(mapping, "station")).first()
    assert by_name.state_mapping_coverage == 0.75


def test_best_seller(spark):
    lines = spark.createDataFrame(
        [("2024-01", "rice", "v1", "S", "o1", 2.0), ("2024-01", "rice", "v2", "S", "o2", 2.0), ("2024-01", "dal", None, "T", "o3", 4.0),
         ("2024-02", "dal", "v1", None, "o4", 1.0)],
        "month string, item_name string, outlet_name string, station_name string, order_id string, quantity double")
    totals = reports.month_item_totals(lines)
    got = [tuple(r) for r in reports.best_sellers(totals).orderBy("month").collect()]
    assert got == [("2024-01", 1, "rice", 4.0, 2, 2, 1), ("2024-02", 1, "dal", 1.0, 1, 1, 0)]
    assert tuple(reports.report_summary(totals).first()) == (2, 9)


def test_report_lines_without_rows(spark):
    alerts = spark.createDataFrame([], "date string, eventName string, daysUntil int")
    assert reports.alert_line(alerts).first().alert_line == "No known event in the current model window."
    routes = spark.createDataFrame([], "stationCode string, trainNo string, trainName string, forecastOrders bigint")
    assert reports.route_line(routes).first().route_line == "No qualifying route history."


def test_route_line(spark):
    routes = spark.createDataFrame([("A", str(i), f"R{i}", 1000 * i) for i in range(1, 6)], "stationCode string, trainNo string, trainName string, forecastOrders bigint")
    assert reports.route_line(routes).first().route_line == "R5 (5): 5,000 orders; R4 (4): 4,000 orders; R3 (3): 3,000 orders"


def test_kpi_strip_counts_tables(spark):
    evaluation = spark.createDataFrame([(1.0, 2.0, 0.5, 10)], "mae double, rmse double, r2 double, trainingRows bigint")
    got = reports.kpi_strip(evaluation, spark.range(3), spark.range(4), spark.range(0)).first()
    assert (got.stations, got.routes, got.alerts, got.forecastDays) == (3, 4, 0, 30)


def test_one_order_of_a_line_is_stored_for_all_last_values(spark, monkeypatch):
    """The newest value that is not null counts, the largest of equal orders; the order of a line moves once, not for each value."""
    r = random.Random(6)
    rows = [(f"2024-0{r.randint(1, 2)}-05", r.choice("ab"), float(r.randint(1, 9)), r.choice([None, "v", "w"]), r.choice([None, "x", "y"]),
             r.choice([None, "n", "o"]), r.choice([None, "veg", "non"]), r.choice([None, True, False]), r.randint(0, 20)) for _ in range(200)]
    frame = spark.createDataFrame(rows, "date string, food_item string, quantity_sold double, outlet_name string, city string, region string, "
                                  "food_type string, is_veg boolean, at int").withColumn("line_order", F.struct("at", F.col("at").alias("again")))
    stored, real = [], item_demand.keep
    monkeypatch.setattr(item_demand, "keep", lambda kept: stored.append(kept.dtypes) or real(kept))
    got = {(str(row.month)[:7], row.food_item): row for row in item_demand.item_months(item_demand.adapt_schema(frame)).collect()}
    assert [sum("struct" in kind for _, kind in types) for types in stored] == [1]
    assert got.keys() == {(d[:7], item) for d, item, *_ in rows}
    for (month, item), row in got.items():
        own = [x for x in rows if (x[0][:7], x[1]) == (month, item)]
        assert row.quantity_sold == sum(x[2] for x in own) and row.vendor_availability == len({x[3] for x in own} - {None})
        for at, name in ((4, "city"), (5, "region"), (6, "food_type"), (7, "is_veg")):
            known = [(x[8], x[at]) for x in own if x[at] is not None]
            assert row[name] == max(known)[1]
