import datetime as dt

import pytest
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.operators import horizon, readiness
from platterflow.plans import learning, publish
from platterflow.session import pin
from platterflow.sources import dimensions
from tests.test_panel import PANEL, calendar, day, make


class FormulaModel:
    """The plain estimate behind the interface of a fitted model."""

    def with_levels(self, frame):
        return frame

    def formula(self):
        return horizon.momentum


def day_by_day(panel, cal, model, days):
    """The recursion with one scoring pass of the fitted pipeline per day."""
    state = model.with_levels(horizon._state(panel, cal, days)).withColumn("forecasts", F.array().cast("array<double>"))
    columns = state.columns
    for step in range(days):
        scored = model.predict(state.withColumns(horizon._features(F.element_at("days", step + 1), F.col("history"))))
        state = pin(scored.withColumn("v", F.greatest("prediction", F.lit(0.0))).withColumns({
            "history": horizon.append(F.col("history"), F.col("v")), "forecasts": F.concat("forecasts", F.array("v"))}).select(*columns))
    return horizon._unrolled(state)


@pytest.fixture(scope="module")
def fitted(spark):
    """A model of three stations, one of them rare, with numbers that are missing."""
    rows = [(code, i % 12 + 1, i % 7, i % 7 // 5, i % 11 // 10, 0, 0, None if i % 9 == 0 else float(i % 13), float(i % 5), 2.0 + i % 3,
             float(10 * "ABC".index(code) + i % 13 + 3 * (i % 7 == 0))) for i, code in enumerate("AB" * 150 + "C")]
    names = ("station_code string, month int, day_of_week int, is_weekend int, festival_flag int, holiday_flag int, local_event_flag int, "
             "lag_1_demand double, rolling_7_demand double, vendor_capacity double, order_count double")
    frame = spark.createDataFrame(rows, names)
    trees = K.DAILY_TREES | {"trees": 12, "depth": 4, "step": 0.3}
    return learning.fit_trees(frame, K.DAILY_CATEGORIES, K.DAILY_NUMBERS, "order_count", K.DAILY_MIN_FREQUENCY, trees)


def test_the_formula_is_the_model(spark, fitted):
    rows = [(c, m, d, 1, f, 0, 0, lag, 3.0, v) for c in ("A", "B", "C", "new", None) for m, d, f, lag, v in
            ((1, 0, 0, 5.0, 2.0), (12, 6, 1, None, 9.0), (6, 3, 0, 0.0, None))]
    frame = spark.createDataFrame(rows, "station_code string, month int, day_of_week int, is_weekend int, festival_flag int, holiday_flag int, "
                                        "local_event_flag int, lag_1_demand double, rolling_7_demand double, vendor_capacity double")
    levelled = fitted.with_levels(frame)
    formula = fitted.formula()({n: F.col(n) for n in K.DAILY_NUMBERS})
    got = fitted.predict(levelled.withColumn("by_formula", formula)).collect()
    assert len(got) == 15 and len({r.prediction for r in got}) > 5
    assert [r.by_formula for r in got] == pytest.approx([r.prediction for r in got], rel=1e-12)


def test_one_fold_equals_a_pass_per_day(spark, fitted):
    panel = make(spark, [(n, 5 + n % 7) for n in range(1, 20)], "A").unionByName(make(spark, [(2, 3), (4, 30)], "new"))
    cal = calendar(spark, ("2024-01-22", "Holi", "Festival", "1", "0", "0"))
    folded = horizon.forecast_by_model(panel, cal, fitted, 12).orderBy("station_code", "date").collect()
    want = day_by_day(panel, cal, fitted, 12).orderBy("station_code", "date").collect()
    assert [(r.station_code, r.date) for r in folded] == [(r.station_code, r.date) for r in want] and len(folded) == 24
    assert [r.prediction for r in folded] == pytest.approx([r.prediction for r in want], rel=1e-12)


def test_jobs_do_not_grow_with_the_horizon(spark, fitted):
    panel = pin(make(spark, [(n, 5 + n % 7) for n in range(1, 20)], "A"))
    cal = pin(calendar(spark, ("2024-01-22", "Holi", "Festival", "1", "0", "0")))

    def jobs(days):
        spark.sparkContext.setJobGroup(f"horizon-{days}", "")
        assert horizon.forecast_by_model(panel, cal, fitted, days).count() == days
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"horizon-{days}"))

    jobs(3)
    assert 0 < jobs(40) == jobs(5)


def test_append_keeps_the_last_seven(spark):
    rows = [([1.0, 2.0],), ([float(i) for i in range(7)],), ([],)]
    frame = spark.createDataFrame(rows, "h array<double>")
    got = [r[0] for r in frame.select(horizon.append(F.col("h"), F.lit(9.0))).collect()]
    assert got == [[1.0, 2.0, 9.0], [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 9.0], [9.0]]


def test_history_and_profile_reach_over_gaps(spark):
    counts = [(n, n) for n in range(1, 31)] + [(40, 100)]
    panel = make(spark, counts)
    assert horizon.seed_histories(panel).first().history == [25.0, 26.0, 27.0, 28.0, 29.0, 30.0, 100.0]
    got = horizon.station_profiles(panel).first()
    last = [c for _, c in counts][-28:]
    assert got.baseline_daily_orders == pytest.approx(sum(last) / 28)
    assert got.current_vendor_count == 2.0 and got.orders_per_vendor == 8.0 and got.average_order_value == 1.0


def python_horizon(history, days, events):
    out = []
    for date in days:
        weekend = date.weekday() >= 5
        festival, holiday, local = events.get(date, (0, 0, 0))
        base = 0.5 * history[-1] + 0.5 * sum(history) / len(history)
        value = base * (1 + 0.05 * weekend + 0.20 * festival + 0.10 * holiday - 0.05 * local)
        out.append(value)
        history = (history + [value])[-7:]
    return out


def test_both_runners_follow_the_recursion(spark):
    panel = make(spark, [(1, 10), (2, 12), (3, 9)]).unionByName(make(spark, [(2, 3)], "B"))
    cal = calendar(spark, ("2024-01-06", "Holi", "Festival", "1", "0", "0"), ("2024-01-10", "Fair", "Local", "0", "1", "1"))
    days = [day(3) + dt.timedelta(days=i) for i in range(1, 31)]
    events = {day(6): (1, 0, 0), day(10): (0, 1, 1)}
    want = {"A": python_horizon([10.0, 12.0, 9.0], days, events), "B": python_horizon([3.0], days, events)}
    folded = horizon.forecast_by_formula(panel, cal)
    looped = horizon.forecast_by_model(panel, cal, FormulaModel())
    for frame in (folded, looped):
        rows = frame.orderBy("station_code", "date").collect()
        assert len(rows) == 60
        assert [r.date for r in rows[:30]] == days
        assert [r.prediction for r in rows] == pytest.approx(want["A"] + want["B"], rel=1e-12)


def test_predictions_are_never_negative(spark):
    panel = make(spark, [(1, 10)])
    got = horizon.forecast_by_formula(panel, calendar(spark), lambda f: f["lag_1_demand"] - 100, days=3).collect()
    assert [r.prediction for r in got] == [0.0, 0.0, 0.0]


def daily(spark, *rows):
    schema = ("station_code string, station_name string, date date, prediction double, current_vendor_count double, "
              "orders_per_vendor double, baseline_daily_orders double, average_order_value double, "
              "festival_flag int, holiday_flag int, event_name string, event_type string")
    return readiness.daily_readiness(spark.createDataFrame(list(rows), schema))


def row(code, n, prediction, baseline=10.0, event=None):
    return (code, code, day(n), prediction, 2.5, 4.0, baseline, 50.0, int(bool(event)), 0, event, event and "Festival")


def test_readiness_rows(spark):
    got = {r.date: r for r in daily(spark, row("A", 1, 10.0), row("A", 2, 20.0, event="Holi")).collect()}
    calm, busy = got["2024-01-01"], got["2024-01-02"]
    assert (calm.readinessScore, calm.riskLevel, calm.revenueAtRisk, calm.vendorGap) == (100, "Normal", 0, 0)
    assert (busy.readinessScore, busy.riskLevel, busy.revenueAtRisk) == (20, "Critical", 450)
    assert (busy.recommendedVendorCount, busy.currentVendorCount, busy.vendorGap) == (5, 2, 3)
    assert busy.festival and busy.eventName == "Holi" and calm.eventName is None


def test_summary_sorts_by_risk_then_volume(spark):
    frame = daily(spark, row("calm", 1, 10.0), row("big", 1, 40.0), row("bigger", 1, 80.0))
    got = publish.in_section_order(readiness.station_outlook(frame, days=1), "stationForecasts").collect()
    assert [r.stationCode for r in got] == ["bigger", "big", "calm"]
    assert got[2].recommendedAction == K.CALM_ACTION and "vendor(s)" in got[0].recommendedAction
    assert got[0].demandUpliftPercent == 700.0


def test_alerts_compare_with_days_without_events(spark):
    frame = daily(spark, row("A", 1, 10.0), row("A", 2, 20.0, event="Holi"), row("B", 2, 10.0, event="Holi"))
    got = [tuple(r) for r in readiness.event_alerts(frame).collect()]
    assert got == [("2024-01-02", "Holi", "Festival", 1, 30, 200.0, 450)]


def test_alerts_without_a_normal_day_have_no_change(spark):
    got = readiness.event_alerts(daily(spark, row("A", 2, 20.0, event="Holi"))).first()
    assert got.expectedDemandChangePercent is None and got.daysUntil == 0


def test_route_shares_need_two_orders_and_keep_five(spark):
    rows = [("A", f"T{i}", f"R{i}", day(100), n) for i, n in enumerate((8, 7, 6, 5, 4, 3, 1))]
    rows += [("A", "old", "old", day(9), 99), ("A", "edge", "edge", day(10), 2)]
    history = spark.createDataFrame(rows, "station_code string, train_no string, train_name string, date date, orders bigint")
    got = readiness.route_shares(history).orderBy("train_no").collect()
    assert [r.train_no for r in got] == ["T0", "T1", "T2", "T3", "T4"]
    assert got[0].routeShare == pytest.approx(8 / 35)


def test_routes_spread_the_station_forecast(spark):
    frame = daily(spark, row("A", 1, 10.0), row("A", 2, 30.0))
    shares = spark.createDataFrame([("A", "1", "One", 6, 0.6), ("A", "2", "Two", 3, 0.3), ("Z", "9", "Z", 2, 1.0)],
                                   "station_code string, train_no string, train_name string, recentOrders bigint, routeShare double")
    got = publish.in_section_order(readiness.route_outlook(frame, shares), "routeForecasts").collect()
    assert [(r.trainNo, r.forecastOrders, r.forecastRevenue, r.routeSharePercent) for r in got] == [
        ("1", 24, 1200, 60.0), ("2", 12, 600, 30.0)]


def test_empty_calendar_file(spark, tmp_path):
    cal = dimensions.collapse_calendar(dimensions.read_calendar(spark, str(tmp_path / "none.csv")))
    assert cal.count() == 0
    assert spark.createDataFrame([], PANEL).join(cal, "date", "left").count() == 0
