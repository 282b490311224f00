import datetime as dt

import pytest
from pyspark.sql import functions as F

from platterflow.functions import aggregates, coerce, dates, scores


def one(spark, schema, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_text_strips_every_blank_and_falls_back(spark):
    rows = [("  ",), ("\tX ",), (None,), ("",), (" Y　",), ("a b",)]
    got = one(spark, "v string", rows, coerce.text(F.col("v"), "FB"))
    assert [g[0] for g in got] == ["FB", "X", "FB", "FB", "Y", "a b"]


def test_numbers(spark):
    rows = [("1.5",), (" 12 ",), ("abc",), ("NaN",), (None,), ("1.5d",), ("1e3",), ("-2",)]
    got = one(spark, "v string", rows, coerce.number(F.col("v")), coerce.number_or_zero(F.col("v")))
    assert [g[0] for g in got] == [1.5, 12.0, None, None, None, None, 1000.0, -2.0]
    assert [g[1] for g in got] == [1.5, 12.0, 0.0, 0.0, 0.0, 0.0, 1000.0, -2.0]


def test_double_cells_lose_nan_only(spark):
    got = one(spark, "v double", [(float("nan"),), (2.5,), (None,)], coerce.number(F.col("v"), "double"))
    assert [g[0] for g in got] == [None, 2.5, None]


@pytest.mark.parametrize("cell, want", [
    ("2024-03-01", dt.datetime(2024, 3, 1)),
    ("2024-03-01 04:05:06", dt.datetime(2024, 3, 1, 4, 5, 6)),
    ("2024-03-01T04:05:06", dt.datetime(2024, 3, 1, 4, 5, 6)),
    ("03/01/2024", dt.datetime(2024, 3, 1)),
    ("3/1/2024 4:05", dt.datetime(2024, 3, 1, 4, 5)),
    ("25/03/2024", dt.datetime(2024, 3, 25)),
    ("25-03-2024 10:00:00", dt.datetime(2024, 3, 25, 10)),
    ("3/1/2024 4:05 PM", dt.datetime(2024, 3, 1, 16, 5)),
    ("25-Mar-2024", dt.datetime(2024, 3, 25)),
    ("25 Mar 2024", dt.datetime(2024, 3, 25)),
    ("not a date", None), ("", None), (None, None),
])
def test_instants(spark, cell, want):
    assert one(spark, "v string", [(cell,)], coerce.instant(F.col("v")))[0][0] == want


def test_flags_are_clamped(spark):
    rows = [("2",), ("-1",), ("bad",), (None,), ("1",), ("0",), ("0.4",)]
    got = one(spark, "v string", rows, coerce.flag(F.col("v")))
    assert [g[0] for g in got] == [1, 0, 0, 0, 1, 0, 0]


def test_statuses(spark):
    rows = [("cancel req",), ("CANCELLED",), (None,), ("Delivered",), ("Partially Delivered",), ("delivered",)]
    got = one(spark, "v string", rows, coerce.is_cancelled(F.col("v")), coerce.is_fulfilled(F.col("v")))
    assert got == [(True, False), (True, False), (False, False), (False, True), (False, True), (False, False)]


def test_week_of_month_and_weekday(spark):
    days = [(dt.date(2024, 1, d),) for d in (1, 7, 8, 29, 31)]
    got = one(spark, "d date", days, dates.week_of_month(F.col("d")), dates.weekday(F.col("d")), dates.weekend(F.col("d")))
    assert [g[0] for g in got] == [1, 1, 2, 5, 5]
    assert [g[1] for g in got] == [0, 6, 0, 0, 2]
    assert [g[2] for g in got] == [0, 1, 0, 0, 0]


def test_risk_edges(spark):
    rows = [(s,) for s in (0.0, 0.059, 0.06, 0.18, 0.30, 0.9)]
    got = one(spark, "s double", rows, scores.risk_level(F.col("s")))
    assert [g[0] for g in got] == ["Normal", "Normal", "Medium", "High", "Critical", "Critical"]


def test_readiness_limits(spark):
    got = one(spark, "s double", [(0.0,), (0.1,), (0.9,)], scores.readiness(F.col("s")))
    assert [g[0] for g in got] == [100, 80, 20]


def test_rounding_is_half_even(spark):
    got = one(spark, "v double", [(0.5,), (1.5,), (2.5,), (-0.5,)], scores.whole(F.col("v")))
    assert [g[0] for g in got] == [0, 2, 2, 0]


def test_texts(spark):
    got = one(spark, "r string, g bigint, m double", [("Normal", 0, 1234567.0), ("High", 3, 99.0)],
              scores.action(F.col("r"), F.col("g")), scores.lakh(F.col("m")), scores.grouped_digits(F.col("m")))
    assert got[0] == ("Maintain normal operations and monitor live demand.", "INR 12.35L", "1,234,567")
    assert got[1] == ("Add 3 vendor(s), stage inventory and review the next peak window.", "INR 0.00L", "99")


def test_one_large_amount_stops_nothing(spark):
    rows = [(1e12,), (2.5,), (None,), (1e30,), (0.1234567,), (-1e14,)]
    frame = spark.createDataFrame(rows, "v double")
    units, money = frame.agg(aggregates.units_sum(F.col("v")), aggregates.money_sum(F.col("v"))).first()
    assert units == pytest.approx(1e12 + 2.5 + 0.123457 - 1e14, rel=1e-12) and money == pytest.approx(1e12 + 2.5 + 0.1235 - 1e14, rel=1e-12)
    parts = frame.groupBy((F.col("v") > 0).alias("k")).agg(aggregates.exact_sum(F.col("v")).alias("m"), aggregates.exact_units(F.col("v")).alias("u"))
    assert tuple(parts.agg(aggregates.units_rollup(F.col("u")), aggregates.money_rollup(F.col("m"))).first()) == (units, money)
    nothing = frame.filter("v > 1e29").agg(aggregates.exact_sum(F.col("v")), aggregates.money_sum(F.col("v"))).first()
    assert tuple(nothing) == (None, 0.0)
