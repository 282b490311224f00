import csv

import pytest

from platterflow.operators import cleaning
from platterflow.plans import publish
from platterflow.sources import dimensions, exports


def write(path, header, *rows):
    with open(path, "w", newline="") as file:
        csv.writer(file).writerows([header, *rows])
    return str(path)


def test_files_align_by_name_and_keep_their_order(spark, tmp_path):
    write(tmp_path / "2023.csv", ["order_id", "item_name"], *[[f"a{i}", "rice, plain"] for i in range(50)])
    write(tmp_path / "2024.csv", ["item_name", "order_id", "discount"], ["dal", "b0", "5"], ["NA", "b1", ""])
    write(tmp_path / "2025.csv", ["order_id", "item_name"], ["c0", 'say "hi"'])
    write(tmp_path / "calendar.csv", ["order_id"], ["no"])
    lines = exports.read_exports(spark, str(tmp_path / "[0-9]*.csv"))
    got = lines.orderBy("line_order").collect()
    assert [r.order_id for r in got] == [f"a{i}" for i in range(50)] + ["b0", "b1", "c0"]
    assert got[0].item_name == "rice, plain" and got[0].discount is None
    assert (got[50].discount, got[51].item_name, got[51].discount) == ("5", None, None)
    assert got[52].item_name == 'say "hi"'
    assert {tuple(r) for r in exports.source_files(lines).collect()} == {("2023.csv", 50), ("2024.csv", 2), ("2025.csv", 1)}


def test_line_order_survives_a_shuffle(spark, tmp_path):
    write(tmp_path / "1.csv", ["order_id", "v"], *[["o", i] for i in range(500)])
    lines = exports.read_exports(spark, str(tmp_path / "1.csv")).repartition(8)
    assert [r.v for r in lines.orderBy("line_order").collect()] == [str(i) for i in range(500)]


def test_parquet_exports(spark, tmp_path):
    spark.range(5).withColumnRenamed("id", "order_id").write.parquet(str(tmp_path / "a.parquet"))
    assert exports.read_exports(spark, [str(tmp_path / "a.parquet")], "parquet").count() == 5


def test_missing_inputs_are_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="No source files"):
        exports.read_exports(spark, str(tmp_path / "[0-9]*.csv"))
    there = write(tmp_path / "1.csv", ["a"], ["1"])
    with pytest.raises(FileNotFoundError, match="gone.csv"):
        exports.read_exports(spark, [there, str(tmp_path / "gone.csv")])


def test_required_columns(spark):
    with pytest.raises(ValueError, match="b, c"):
        exports.require_columns(spark.createDataFrame([(1,)], "a int"), ["a", "c", "b"])


def test_station_template_is_written_once(spark, tmp_path):
    path = str(tmp_path / "map")
    lines = spark.createDataFrame([("a", "Alpha"), ("a", "Alpha"), ("b", "Beta")], "station_code string, station string")
    publish.write_missing_csv(dimensions.station_template(lines).orderBy("station_code"), path)
    publish.write_missing_csv(dimensions.station_template(lines.limit(1)), path)
    got = dimensions.read_station_map(spark, path).orderBy("station_code").collect()
    assert [tuple(r) for r in got] == [("a", "Alpha", ""), ("b", "Beta", "")]


def test_strict_json_refuses_nan(spark, tmp_path):
    bad = spark.createDataFrame([(1.0,), (float("nan"),)], "v double")
    with pytest.raises(ValueError, match="NaN"):
        publish.write_json(bad, str(tmp_path / "out"))
    publish.write_json(publish.nulls_for_nan(bad), str(tmp_path / "out"))
    assert [r.v for r in dimensions.read_payload(spark, str(tmp_path / "out")).orderBy("v").collect()] == [None, 1.0]
    with pytest.raises(ValueError):
        publish.write_json(spark.createDataFrame([(float("inf"),)], "v double"), str(tmp_path / "out"))


def test_outputs_are_replaced(spark, tmp_path):
    for n in (3, 2):
        publish.write_csv(spark.range(n), str(tmp_path / "x/y"))
    assert spark.read.option("header", True).csv(str(tmp_path / "x/y")).count() == 2


def test_absent_results_read_as_nothing(spark, tmp_path):
    assert dimensions.read_payload(spark, str(tmp_path / "none")) is None
    assert dimensions.read_item_forecast(spark, str(tmp_path / "none.csv")).count() == 0


def test_a_line_order_is_made_up_from_all_columns(spark):
    frame = spark.createDataFrame([("b", 1), ("a", 2)], "x string, y int")
    assert [r.x for r in frame.orderBy(cleaning.line_order(frame)).collect()] == ["a", "b"]


def test_quoted_line_breaks_stay_in_their_cell(spark, tmp_path):
    write(tmp_path / "1.csv", ["order_id", "item_name"], ["1", 'two\nlines, "quoted"'], ["2", "plain"])
    read = exports.read_exports(spark, str(tmp_path / "*.csv"))
    assert [(r.order_id, r.item_name) for r in read.orderBy("line_order").collect()] == [("1", 'two\nlines, "quoted"'), ("2", "plain")]
    publish.write_csv(read.drop("line_order"), str(tmp_path / "again"))
    again = exports.read_exports(spark, str(tmp_path / "again" / "*.csv"))
    assert {(r.order_id, r.item_name) for r in again.collect()} == {("1", 'two\nlines, "quoted"'), ("2", "plain")}


def test_strict_json_looks_into_nested_values(spark, tmp_path):
    nested = "array(named_struct('items', array(named_struct('units', {}))))"
    good, bad = spark.range(1).selectExpr(f"{nested.format('1.5D')} AS years"), spark.range(1).selectExpr(f"{nested.format("double('NaN')")} AS years")
    assert publish.not_finite(good).first().bad == 0 and publish.not_finite(bad).first().bad == 1
    endless = spark.range(2).selectExpr("map('a', double('Infinity'), 'b', 1.0D) AS m", "named_struct('x', CAST(NULL AS DOUBLE)) AS s", "id")
    assert publish.not_finite(endless).first().bad == 2
    with pytest.raises(ValueError, match="NaN"):
        publish.write_json(bad, str(tmp_path / "out"))
