import pytest

import corpus_pipeline
from platterflow.llm import exact_dedup, packing, quality, simhash, substring_dedup
from platterflow.session import keep
from tests.llm.cases import no_documents, odd_documents

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{FOLDER}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "simhash_dedup", "substring_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        after = keep(stage(spark, docs, FOLDER))
        before_ids, ids = ({r.doc_id for r in f.select("doc_id").collect()} for f in (docs, after))
        if name == "quality":
            expected = {r.doc_id for r in quality.classified(docs, labels).collect() if r.keep}
        elif name == "exact_dedup":
            expected = {r.doc_id for r in exact_dedup.exact_groups(docs).collect() if r.kept}
        elif name == "simhash_dedup":
            expected = {r.component_id for r in simhash.near_groups(docs).collect()}
        else:
            expected = before_ids - (before_ids - ids if name == "substring_dedup" else set())
        assert ids == expected
        if name == "substring_dedup":
            assert substring_dedup.repeated_passages(after).count() <= 0.1 * max(10, substring_dedup.repeated_passages(docs).count())
        assert name == "packing" or after.columns == columns
        docs = after


def test_run(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and {r.start == 0 for r in rows} == {True, False} or all(r.start == 0 for r in rows)
    assert max(r.offset + r.length for r in rows) <= packing.WINDOW


@pytest.mark.parametrize("make", [odd_documents, no_documents])
def test_stages_take_odd_documents(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, FOLDER))
        assert name == "packing" or "clash" not in docs.columns
    assert (docs.count() > 0) == (make is odd_documents)
