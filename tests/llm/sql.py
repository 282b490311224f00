"""Comparison of a frame with the result of SQL over the given tables."""

import duckdb

from checks.compare import rows_of


def same_as_sql(frame, sql, folder):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    expected = rows_of(columns, cursor.fetchall())
    assert rows_of(frame.columns, frame.collect()) == expected and expected
