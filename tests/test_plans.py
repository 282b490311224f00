"""Whole jobs on the given tables, with small ensembles."""

import json
import os

import pytest
from pyspark.sql import functions as F

from checks import tables as T
from platterflow import constants as K
from platterflow.operators import item_demand, metrics, monthly, prepare
from platterflow.plans import best_seller_report, cancellation, daily_forecast, dashboard_data, item_forecast, learning, monthly_forecast, publish
from platterflow.sources import dimensions

FOLDER = "/root/testdata/sf0.01"
SMALL = {"trees": 4, "depth": 3}


def records(path):
    out, path = [], str(path)
    output, name = os.path.split(path)
    if os.path.isdir(f"{output}/_manifests"):
        with open(f"{output}/_manifests/{max(n for n in os.listdir(f'{output}/_manifests') if n.endswith('.json') and n[0] != '.')}") as file:
            path = f"{output}/_versions/{json.load(file)['version']}/{name}"
    for name in sorted(os.listdir(path)):
        if name.endswith(".json"):
            with open(f"{path}/{name}") as file:
                out += [json.loads(line) for line in file]
    return out


def test_daily_forecast(spark, tmp_path):
    lines = T.order_lines(spark, FOLDER, T.DELIVERED)
    result = daily_forecast.run(lines, T.calendar_rows(spark, FOLDER), K.DAILY_TREES | SMALL)
    parts = {name: frame.collect() for name, frame in best_seller_report.printed_parts(result).items()}
    counters = daily_forecast.write(result, str(tmp_path)).first()
    daily = records(tmp_path / "dailyForecasts")
    assert len(daily) == 30 * 5 and counters.stations == 5 and counters.alerts == len(records(tmp_path / "eventAlerts"))
    assert {"eventName", "forecastOrders", "riskLevel"} <= set(daily[0])
    meta = records(tmp_path / "metadata")[0]
    assert (meta["forecastStart"], meta["forecastEnd"], meta["forecastDays"]) == ("2001-08-04", "2001-09-02", 30)
    assert counters.evaluation.testRows > 0 and counters.evaluation.trainingRows >= 100
    assert parts["kpis"][0].stations == 5 and len(parts["stations"]) == 5 and parts["routes"][0][0].count(";") == 2


def test_daily_training_guard(spark):
    lines = T.order_lines(spark, "/root/testdata/sf0.001", T.DELIVERED)
    with pytest.raises(ValueError, match="at least 100"):
        daily_forecast.run(lines, T.calendar_rows(spark, "/root/testdata/sf0.001"), K.DAILY_TREES | SMALL)


def test_monthly_forecast(spark, tmp_path):
    lines = T.order_lines(spark, FOLDER, T.BOOKED + T.STATIONS + ("item_name",))
    result = monthly_forecast.run(lines, 2002, estimator=monthly_forecast.tree_estimate(K.MONTHLY_TREES | SMALL))
    counters = monthly_forecast.write(result, str(tmp_path)).first()
    assert (counters.stations, counters.monthlyCards, counters.details) == (5, 25, 25)
    for record in records(tmp_path / "stationDetails"):
        assert sum(w["forecastOrders"] for w in record["weeklyForecast"]) == record["forecastOrders"]
        assert sum(w["predictedRevenue"] for w in record["weeklyForecast"]) == record["predictedRevenue"]
        assert len(record["topItemsByYear"]) == 5 and record["trend"][-1]["isForecast"]
    assert records(tmp_path / "metadata")[0]["months"][0] == "2002-08"


def test_monthly_forecast_with_the_plain_trend(spark):
    lines = T.order_lines(spark, FOLDER, T.BOOKED + T.STATIONS + ("item_name",))
    result = monthly_forecast.run(lines, 2002, estimator=monthly.trend_estimate)
    assert result.cards.count() == 25


def test_item_forecast_from_csv(spark, tmp_path):
    lines = T.order_lines(spark, FOLDER, T.DEMAND).drop("line_order")
    publish.write_csv(lines.coalesce(2), str(tmp_path / "in"))
    paths = [str(p) for p in sorted((tmp_path / "in").glob("*.csv"))]
    best = item_forecast.run_files(spark, paths, str(tmp_path / "out"), K.ITEM_TREES | SMALL).first()
    ranked = dimensions.read_item_forecast(spark, str(tmp_path / "out")).orderBy("rank").collect()
    assert best["rank"] == 1 and best.food_item == ranked[0].food_item and best.forecast_month == "2001-09"
    assert [r["rank"] for r in ranked] == list(range(1, len(ranked) + 1))
    quantities = [r.forecast_quantity for r in ranked]
    assert quantities == sorted(quantities, reverse=True) and min(quantities) >= 0


def test_item_guard(spark):
    raw = spark.createDataFrame([("2024-01-05", "rice", 2.0)], "date string, food_item string, quantity_sold double")
    with pytest.raises(ValueError, match="at least 8"):
        item_forecast.run(raw)


def test_item_holdout_error(spark):
    monthly_rows = item_demand.item_months(item_demand.adapt_schema(T.order_lines(spark, FOLDER, T.DEMAND)))
    pairs = item_demand.training_pairs(item_demand.with_month_lags(monthly_rows))
    error = item_forecast.holdout_mape(pairs, K.ITEM_TREES | SMALL).first().mape
    assert error > 0
    assert item_forecast.holdout_mape(pairs.limit(0)) is None


def test_cancellation_run(spark, tmp_path):
    # The few orders of the last month are all of one class; the month before has both.
    lines = T.order_lines(spark, FOLDER, T.BOOKING).filter("booking_date < '2001-08-01'")
    result = cancellation.run(lines, maximum=4000, trees=K.CANCELLATION_TREES | SMALL)
    scored = result.scored.agg(F.min("score"), F.max("score")).first()
    cancellation.write(result, str(tmp_path))
    record = records(tmp_path / "metrics")[0]
    assert record["status"] == "trained" and record["training_orders"] == 4000 and record["test_month"] == "2001-07"
    assert 0 <= scored[0] <= scored[1] <= 1 and 0 <= record["roc_auc"] <= 1
    assert len(record["factors"]) == K.TOP_FACTORS
    weights = [f["importance"] for f in record["factors"]]
    assert weights == sorted(weights, reverse=True)


def test_model_survives_saving_and_finds_a_signal(spark, tmp_path):
    rows = [("ab"[i % 2], float(i % 5), None if i % 7 == 0 else 1.0, float(10 * (i % 2) + i % 5)) for i in range(400)]
    frame = spark.createDataFrame(rows + [("rare", 1.0, 1.0, 3.0)], "code string, x double, gone double, y double")
    model = learning.fit_trees(frame, ["code"], ["x", "gone"], "y", 3, K.DAILY_TREES | {"trees": 20, "step": 0.3})
    fresh = spark.createDataFrame([("a", 0.0, None), ("b", 4.0, 1.0), ("new", 2.0, 1.0), (None, 2.0, 1.0)], "code string, x double, gone double")
    before = {(r.code, r.x): r.prediction for r in model.score(fresh).collect()}
    model.save(str(tmp_path / "m"))
    after = {(r.code, r.x): r.prediction for r in learning.FittedModel.load(spark, str(tmp_path / "m")).score(fresh).collect()}
    assert before == after and len(before) == 4
    assert before["b", 4.0] - before["a", 0.0] > 8
    importance = {r.feature: r.importance for r in model.importance(spark).collect()}
    assert set(importance) == {"code", "x", "gone"} and importance["code"] > 0.5
    errors = metrics.regression_metrics(model.score(frame), "y", "prediction").first()
    assert errors.r2 > 0.9


def test_no_two_levels_share_a_place(spark, many_slices):
    """20,000 levels, none merged: each keeps a place of its own, in the order of the levels."""
    count = 20_000
    frame = spark.range(count).selectExpr("concat('level ', id) AS code", "CAST(id % 2 AS DOUBLE) AS x", "CAST(id % 3 AS DOUBLE) AS y")
    levels = prepare.placed_levels(prepare.level_counts(frame, "code", 1), "code")
    placed = prepare.place_levels(frame, levels, "code", "place")
    assert placed.agg(F.count_distinct("place")).first()[0] == count
    wanted = {code: float(i) for i, code in enumerate(sorted(f"level {i}" for i in range(count)))}
    assert {r.code: r.place for r in placed.collect()} == wanted
    model = learning.fit_trees(frame, ["code"], ["x"], "y", 1, K.ITEM_TREES | {"trees": 1, "depth": 2})
    assert model.sizes() == {"code": count}
    importance = {r.feature: r.importance for r in model.importance(spark).collect()}
    assert set(importance) == {"code", "x"}


def test_levels_of_one_value_are_told_apart(spark):
    """Each of 300 levels has a value of its own, which the model finds again."""
    frame = spark.range(1500).selectExpr("concat('l', id % 300) AS code", "0.0D AS x", "CAST(IF(id % 300 = 7, 50, 0) AS DOUBLE) AS y")
    model = learning.fit_trees(frame, ["code"], ["x"], "y", 1, K.ITEM_TREES | {"trees": 3, "depth": 2, "columns": 1.0, "step": 1.0})
    got = {r.code: r.prediction for r in model.score(frame.select("code", "x").distinct()).collect()}
    assert got.pop("l7") > 40 and max(got.values()) < 5
    empty = learning.fit_trees(frame.withColumn("code", F.lit(None).cast("string")), ["code"], ["x"], "y", 1, K.ITEM_TREES | {"trees": 1})
    assert empty.sizes() == {} and empty.score(frame.limit(3)).count() == 3


def test_dashboard(spark, tmp_path):
    lines = T.order_lines(spark, FOLDER, T.BOOKED + T.STATIONS + ("item_name", "outlet_name"))
    forecast = spark.createDataFrame([("2001-09", 1, "red widget", 9.0)], dimensions.ITEM_FORECAST_SCHEMA)
    station_map = str(tmp_path / "map")
    sections = dashboard_data.run(lines, forecast, station_map)
    os.makedirs(tmp_path / "metrics")
    (tmp_path / "metrics" / "m.json").write_text('{"status": "trained"}')
    dashboard_data.write(sections, str(tmp_path / "out"), str(tmp_path / "metrics"))
    meta = records(tmp_path / "out/metadata")[0]
    assert meta["state_mapping_coverage"] == 0.0 and meta["cancellation_model_available"] is True
    assert meta["forecast_month"] == "2001-09" and meta["latest_observed_month"] == "2001-08"
    assert len(records(tmp_path / "out/monthly")) == 80 and records(tmp_path / "out/cancellationModel") == [{"status": "trained"}]
    assert dimensions.read_station_map(spark, station_map).count() == 5


def test_best_seller_files(spark, tmp_path):
    os.makedirs(tmp_path / "data")
    (tmp_path / "data/2024.csv").write_text(
        "order_id,order_status,created_at,item_name,outlet_name,station_name,quantity\n"
        "1,Delivered,2024-01-02 10:00:00,rice,v,S,2\n2,Delivered,bad,rice,v,S,9\n3,Cancelled,2024-01-02 11:00:00,dal,v,S,50\n"
        "4,Partially Delivered,2024-01-03 09:00:00,dal,v,S,1\n")
    got = best_seller_report.run_files(spark, str(tmp_path / "data/[0-9]*.csv"), str(tmp_path / "out")).collect()
    assert [tuple(r) for r in got] == [("2024-01", 1, "rice", 2.0, 1, 1, 1)]
    summary = records(tmp_path / "out/summary")[0]
    assert (summary["observed_months"], summary["total_delivered_units"], summary["source_files"]) == (1, 3, ["2024.csv"])
    assert summary["rows"][0]["top_seller"] == "rice"


def test_many_levels_do_not_widen_the_vector(spark, tmp_path):
    count = 200
    frame = spark.range(4000).selectExpr(
        f"concat('level ', id % {count}) AS code", "concat('k', id % 3) AS kind", "CAST(id % 7 AS DOUBLE) AS x",
        f"CAST(id % {count} % 2 * 10 + id % 3 AS DOUBLE) AS y")
    model = learning.fit_trees(frame, ["code", "kind"], ["x"], "y", 1, K.ITEM_TREES | {"trees": 10, "columns": 1.0, "step": 0.5})
    assert model.pipeline.stages[-1].numFeatures == 1 + 1 + 3 and model.sizes() == {"code": count, "kind": 3}
    fresh = frame.unionByName(spark.sql("SELECT 'new' AS code, 'k1' AS kind, 3D AS x, 0D AS y UNION ALL SELECT 'level 1', 'new', 3D, 0D"))
    assert metrics.regression_metrics(model.score(frame), "y", "prediction").first().r2 > 0.9
    formula = model.formula()({"x": F.col("x")})
    found = model.predict(model.with_levels(fresh).withColumn("formula", formula)).filter("abs(prediction - formula) > 1e-9 OR formula IS NULL")
    assert found.isEmpty()
    importance = {r.feature: r.importance for r in model.importance(spark).collect()}
    assert set(importance) == {"code", "kind", "x"} and importance["code"] > 0.5
    model.save(str(tmp_path / "m"))
    loaded = learning.FittedModel.load(spark, str(tmp_path / "m"))
    assert loaded.sizes() == model.sizes()
    assert loaded.score(fresh).agg(F.sum("prediction")).first()[0] == pytest.approx(model.score(fresh).agg(F.sum("prediction")).first()[0])
