import duckdb
import pytest
from pyspark.sql import functions as F

from checks.compare import rows_of
from platterflow.llm import exact_dedup, queries
from tests.llm.cases import no_documents, odd_documents

FOLDER = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    cursor = sql.execute(queries.ORACLES["op4_exact_dedup"])
    names = [d[0] for d in cursor.description]
    frame = queries.QUERIES["op4_exact_dedup"](spark, FOLDER)
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, cursor.fetchall())


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_odd_documents(spark, block):
    docs = odd_documents(spark).filter("doc_id IS NULL OR doc_id <> 11")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs, block).collect()), key=str)
    groups = {}
    for row in docs.collect():
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row.text or "")
        groups.setdefault(text, []).append(row.doc_id)
    expected = []
    for ids in groups.values():
        ids.sort(key=lambda i: (i is not None, i or 0))
        expected += [(i, ids[-1], len(ids), at == len(ids) - 1) for at, i in enumerate(ids)]
    assert got == sorted(expected, key=str)


def test_colliding_keys_are_found_and_replaced(spark, monkeypatch):
    real = exact_dedup._key

    def weak(block, seed):
        return real(block, seed) if seed else F.struct(F.length(block).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))
    monkeypatch.setattr(exact_dedup, "_key", weak)
    docs = spark.createDataFrame([(1, "ab"), (2, "cd"), (3, "AB")], "doc_id bigint, text string")
    assert exact_dedup.collisions(docs, 1024, 0).count() == 1
    assert {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(docs).collect()} == {1: 3, 2: 2, 3: 3}


def test_documents_that_stay(spark):
    docs = odd_documents(spark)
    left = exact_dedup.without_copies(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(ids, key=str) == sorted([2, 4, 5, 6, 7, 8, 9, 10, 11, 2**62, -5], key=str)
    assert exact_dedup.without_copies(no_documents(spark)).collect() == []
    assert exact_dedup.exact_groups(no_documents(spark)).collect() == []
