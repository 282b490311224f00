import datetime as dt

from platterflow.operators import cleaning, orders, panel

LINE = ("order_id string, order_status string, booking_date string, delivery_date string, eta string, "
        "station_code string, station_name string, outlet_name string, train_no string, train_name string, "
        "item_name string, food_type string, payment_type string, is_veg string, quantity string, "
        "selling_price string, discount string, amount_payable string, gross_item_amount string, line_order int")


def line(order_id, n, **cells):
    base = dict(
        order_status="Delivered", booking_date="2024-01-01 10:00:00", delivery_date="2024-01-02",
        eta="2024-01-01 16:30:00", station_code="A", station_name="Alpha", outlet_name="V", train_no="1",
        train_name="One", item_name="rice", food_type="meal", payment_type="cash", is_veg="1", quantity="2",
        selling_price="10", discount="0", amount_payable="100", gross_item_amount="40") | cells
    names = [c.split()[0] for c in LINE.split(", ")][1:-1]
    return (order_id, *[base[c] for c in names], n)


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), LINE)


def delivered(spark, *rows):
    got = orders.delivered_orders(cleaning.delivered_lines(lines(spark, *rows))).collect()
    return {r.order_id: r for r in got}


def test_revenue_chain(spark):
    got = delivered(
        spark,
        line("spread", 1), line("spread", 2), line("spread", 3, amount_payable=None),
        line("gross", 1, amount_payable=None), line("gross", 2, amount_payable="abc"),
        line("none", 1, amount_payable=None, gross_item_amount="bad"))
    assert got["spread"].revenue == 100.0
    assert got["gross"].revenue == 80.0
    assert got["none"].revenue == 0.0


def test_first_line_wins_whatever_the_partitions(spark):
    rows = [line("o", n, station_code=f"S{n}", outlet_name=f"V{n}") for n in range(50, 0, -1)]
    frame = lines(spark, *rows).repartition(8)
    got = orders.delivered_orders(cleaning.delivered_lines(frame)).first()
    assert (got.station_code, got.outlet_name) == ("S1", "V1")


def test_rows_without_key_date_or_delivery_are_dropped(spark):
    got = delivered(
        spark, line(None, 1), line("bad date", 1, delivery_date="not a date"),
        line("cancelled", 1, order_status="Cancelled"), line("ok", 1, order_status="Partially Delivered"))
    assert set(got) == {"ok"}


def test_cancelled_when_any_line_is(spark):
    frame = lines(spark, line("o", 1), line("o", 2, order_status="cancel req"), line("p", 1, order_status=None))
    got = {r.order_id: r for r in orders.booked_orders(cleaning.booked_lines(frame)).collect()}
    assert got["o"].is_cancelled and not got["p"].is_cancelled
    assert got["o"].week_of_month == 1 and got["o"].month == "2024-01"


def test_dashboard_order_takes_last_status_and_first_month(spark):
    frame = lines(
        spark, line("o", 1, booking_date="2024-02-01", order_status="Delivered"),
        line("o", 2, booking_date="2024-01-31", order_status="Confirmed"))
    got = orders.dashboard_orders(cleaning.dashboard_lines(frame)).first()
    assert (got.month, got.status) == ("2024-01", "Delivered")


def test_booking_features_skip_missing_values(spark):
    frame = lines(
        spark, line("o", 1, food_type=None, eta=None, item_name="rice"),
        line("o", 2, food_type="snack", item_name="rice", quantity="abc"), line("o", 3, item_name=None))
    got = orders.booking_features(cleaning.booking_lines(frame)).first()
    assert got.food_type == "snack" and got.item_count == 1 and got.total_quantity == 4.0
    assert got.eta_lead_hours == 6.5 and got.booking_day_of_week == 0 and got.eta_hour == 16
    assert got.total_selling_price == 30.0 and not got.cancelled


def test_one_name_per_station_code(spark):
    cube = spark.createDataFrame(
        [("A", "Beta", dt.date(2024, 1, 1), "v", "1", "r", 1, 5.0), ("A", "Alpha", dt.date(2024, 1, 1), "v", "1", "r", 2, 5.0),
         ("A", "Beta", dt.date(2024, 1, 2), "w", "1", "r", 3, 5.0)],
        "station_code string, station_name string, date date, outlet_name string, train_no string, "
        "train_name string, orders bigint, revenue double")
    cube = cube.withColumn("revenue", cube.revenue.cast("decimal(28,4)"))
    got = sorted((r.station_name, r.date.day, r.order_count, r.vendor_capacity) for r in panel.station_days(cube).collect())
    assert got == [("Alpha", 1, 3, 1), ("Alpha", 2, 3, 1)]


def test_one_order_holding_most_lines(spark):
    rows = [line("hot", n, amount_payable=None, gross_item_amount="1.1") for n in range(3000)]
    rows += [line(f"o{n}", n, amount_payable=None) for n in range(100)]
    got = delivered(spark, *rows)
    assert got["hot"].revenue == 3300.0 and len(got) == 101


def test_one_order_with_most_booked_lines(spark):
    """Lines of one order lie in all tasks, and leave each as one row per item."""
    rows = [line("hot", n, item_name=f"i{n % 3}", selling_price="1", food_type=None if n < 40 else f"f{n}") for n in range(3000)]
    rows += [line(f"o{n}", n) for n in range(50)]
    frame = lines(spark, *rows).repartition(8)
    features = orders.booking_features(cleaning.booking_lines(frame))
    plan = features._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.rindex("Exchange hashpartitioning(order_id"):]
    assert "partial_min" in before_shuffle and "REPARTITION_BY_COL" not in plan
    got = {r.order_id: r for r in features.collect()}
    assert (got["hot"].item_count, got["hot"].food_type, got["hot"].total_selling_price, len(got)) == (3, "f40", 3000.0, 51)
