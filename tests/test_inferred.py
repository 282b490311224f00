"""Columns of one inferred format, against pandas."""

import random
import warnings

import pandas as pd
import pytest
from pyspark.sql import functions as F

from platterflow.functions import inferred
from platterflow.operators import cleaning

TEXTS = ["2024-01-05", "2024-1-5", "2024-01-05 10:00", "2024-01-05 10:00:00", "2024-01-05T10:00:00", "2024-01-05 1:02:03", "2024-01-05 10:00:00.5",
         "2024-01-05 10:00:00.123456", "01/05/2024", "1/5/2024", "13/05/2024", "05/13/2024", "1/5/2024 9:05", "01/05/2024 09:05:07", "1-5-2024",
         "13-05-2024", "05.01.2024", "5-Jan-2024", "05-feb-2024 10:00", "5 Jan 2024", "Jan 5, 2024", "2024/01/05", "2024/1/5 10:00", "20240105",
         "20240230", "2024-02-30", "bad", "", "2024-13-01", "NaT"]


def both(spark, column):
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(column)], "line_order int, d string").repartition(3)
    got = [r.d for r in frame.select("line_order", cleaning.column_instant(frame, "d").alias("d")).orderBy("line_order").collect()]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        want = pd.to_datetime(pd.Series(column, dtype=object), errors="coerce")
    return got, [None if pd.isna(w) else w.to_pydatetime() for w in want]


@pytest.mark.parametrize("first", [t for t in TEXTS if t not in ("bad", "2024-02-30", "20240230", "2024-13-01", "05-feb-2024 10:00")])
def test_the_first_text_decides(spark, first):
    r = random.Random(first)
    got, want = both(spark, [None, "", first, *r.sample(TEXTS, len(TEXTS)), None])
    assert got == want


def test_without_a_known_shape_each_cell_counts(spark):
    frame = spark.createDataFrame([(0, "about noon"), (1, "2024-01-05"), (2, "1/6/2024 10:00")], "line_order int, d string")
    got = [str(r[0]) for r in frame.select(cleaning.column_instant(frame, "d").alias("d"), "line_order").orderBy("line_order").collect()]
    assert got == ["None", "2024-01-05 00:00:00", "2024-01-06 10:00:00"]
    empty = spark.createDataFrame([(0, None)], "line_order int, d string")
    assert empty.select(cleaning.column_instant(empty, "d")).first()[0] is None


def test_jobs_of_one_format_drop_the_others(spark):
    rows = [("a", "Delivered", "2024-01-05 10:00:00", 0), ("b", "Delivered", "1/6/2024 10:00", 1), ("c", "Delivered", "2024-01-07", 2)]
    lines = spark.createDataFrame(rows, "order_id string, order_status string, booking_date string, line_order int")
    for c in ("eta", "station_code", "station_name", "outlet_name", "item_name", "food_type", "payment_type", "is_veg", "quantity", "selling_price",
              "discount", "amount_payable", "gross_item_amount"):
        lines = lines.withColumn(c, F.lit(None).cast("string"))
    assert [r.order_id for r in cleaning.dashboard_lines(lines).collect()] == ["a"]
    assert [r.order_id for r in cleaning.booking_lines(lines).collect()] == ["a"]
    assert sorted(r.order_id for r in cleaning.booked_lines(lines).collect()) == ["a", "b", "c"]


def test_shapes_are_told_apart():
    assert len({pattern for _, pattern in inferred.SHAPES}) == len(inferred.SHAPES)
