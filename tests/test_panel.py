import datetime as dt

import pytest

from platterflow.operators import panel
from platterflow.sources import dimensions

PANEL = "station_code string, station_name string, date date, order_count bigint, revenue double, vendor_capacity bigint"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n - 1)


def make(spark, counts, code="A"):
    return spark.createDataFrame([(code, code, day(n), c, float(c), 2) for n, c in counts], PANEL)


def calendar(spark, *rows):
    schema = ("date string, event_name string, event_type string, festival_flag string, holiday_flag string, "
              "local_event_flag string, row_order bigint")
    return dimensions.collapse_calendar(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema))


def test_a_gap_starts_a_segment(spark):
    frame = panel.daily_features(make(spark, [(1, 5), (2, 7), (4, 9)]), calendar(spark))
    got = [(r.segment, r.lag_1_demand) for r in frame.orderBy("date").collect()]
    assert got == [(1, None), (1, 5.0), (2, None)]


def test_rolling_mean_needs_two_values(spark):
    frame = panel.daily_features(make(spark, [(n, n) for n in range(1, 10)]), calendar(spark))
    got = [r.rolling_7_demand for r in frame.orderBy("date").collect()]
    assert got == [None, None, 1.5, 2, 2.5, 3, 3.5, 4, 5]


def test_lags_stay_inside_a_station(spark):
    both = make(spark, [(1, 5), (2, 7)]).unionByName(make(spark, [(3, 1), (4, 2)], "B"))
    got = {(r.station_code, r.date.day): r.lag_1_demand for r in panel.daily_features(both, calendar(spark)).collect()}
    assert got == {("A", 1): None, ("A", 2): 5.0, ("B", 3): None, ("B", 4): 1.0}


def test_lagged_capacity(spark):
    frame = panel.daily_features(make(spark, [(1, 5), (2, 7)]), calendar(spark), lagged_capacity=True)
    assert [r.vendor_capacity for r in frame.orderBy("date").collect()] == [None, 2]


def test_events_of_a_date_collapse(spark):
    got = calendar(
        spark, ("2024-01-02", "Holi", "Festival", "1", "0", None), ("01/02/2024", "Bank day", None, "0", "2", "x"),
        ("2024-01-02", "Holi", "Festival", "-1", "0", "0"), ("junk", "Lost", "Holiday", "1", "1", "1")).collect()
    assert [tuple(r) for r in got] == [(dt.date(2024, 1, 2), "Holi / Bank day", "Festival / Holiday", 1, 1, 0)]


def test_calendar_without_its_columns(spark):
    rows = spark.createDataFrame([("2024-01-02",)], "date string")
    got = dimensions.collapse_calendar(rows).first()
    assert tuple(got) == (dt.date(2024, 1, 2), "Known calendar event", "Holiday", 0, 0, 0)


def test_flags_join_the_panel(spark):
    frame = panel.daily_features(
        make(spark, [(1, 5), (2, 7)]), calendar(spark, ("2024-01-02", "Holi", "Festival", "1", "0", "0")))
    got = [(r.festival_flag, r.holiday_flag, r.event_name) for r in frame.orderBy("date").collect()]
    assert got == [(0, 0, None), (1, 0, "Holi")]


def test_null_audit(spark):
    frame = panel.daily_features(make(spark, [(1, 5), (2, 7), (4, 9)]), calendar(spark))
    got = {r.feature: r.missing for r in panel.null_audit(frame, ["lag_1_demand", "rolling_7_demand", "month"]).collect()}
    assert got == {"lag_1_demand": 2, "rolling_7_demand": 3, "month": 0}
    clean = panel.null_audit(panel.complete_days(frame), ["lag_1_demand", "rolling_7_demand"]).collect()
    assert all(r.missing == 0 for r in clean)


@pytest.mark.parametrize("k, want", [(1, ["A"]), (5, ["A", "B"])])
def test_busiest_stations(spark, k, want):
    both = make(spark, [(1, 5), (2, 7)]).unionByName(make(spark, [(3, 1)], "B"))
    assert [r.station_name for r in panel.busiest_stations(both, k).collect()] == want
