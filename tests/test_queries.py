"""Every registered query with a SQL counterpart, compared at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import TABLES, rows_of
from platterflow import constants as K
from platterflow.session import Run

FOLDER, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# These fit a model, for which the smallest scale has too few rows.
MODELS = ("daily_model_evaluation", "recursive_forecast_boosted", "monthly_station_forecast_boosted",
          "item_forecast_boosted", "cancellation_model", "feature_importance", "saved_model")


def both_sides(spark, name, folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    with Run(spark):
        frame = QUERIES[name](spark, folder)
        found = frame.columns, frame.collect()
    cursor = connection.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(found[0])
    return rows_of(*found), rows_of(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n not in MODELS and not n.startswith("op")))
def test_query_equals_sql(spark, name):
    found, expected = both_sides(spark, name, FOLDER)
    assert found == expected


@pytest.mark.parametrize("name", MODELS)
def test_model_query_equals_sql(spark, name, monkeypatch):
    # What SQL can state holds for any number of trees.
    for model in ("DAILY", "MONTHLY", "ITEM", "CANCELLATION"):
        monkeypatch.setattr(K, f"{model}_TREES", getattr(K, f"{model}_TREES") | {"trees": 3, "depth": 3})
    found, expected = both_sides(spark, name, LARGER)
    assert found == expected


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_counterpart_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
