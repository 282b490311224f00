import math
import random

import numpy as np

from platterflow.llm import quality
from tests.llm.cases import no_documents, odd_documents

LABELS = "doc_id bigint, quality int, toxic int"


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    taught, held = labels.filter("doc_id % 4 <> 0"), labels.filter("doc_id % 4 = 0")
    found = quality.classified(docs, taught).join(held, "doc_id").select("keep", "quality", "toxic").collect()
    clean = [r.keep for r in found if r.quality == 1 and r.toxic == 0]
    toxic = [r.keep for r in found if r.toxic == 1]
    junk = [r.keep for r in found if r.quality == 0 and r.toxic == 0]
    assert sum(clean) >= 0.98 * len(clean)
    assert sum(toxic) <= 0.05 * len(toxic) and sum(junk) <= 0.05 * len(junk)


def test_estimation_finds_the_accuracies():
    r = random.Random(1)
    accuracy = {"g": [(0.97, 0.01)] * 3, "b": [(0.1, 0.7), (0.2, 0.6), (0.1, 0.8)]}
    counts, truth = {}, {}
    for _ in range(20_000):
        kind = "b" if r.random() < 0.2 else "g"
        pattern = ""
        for good, bad in accuracy[kind]:
            x = r.random()
            pattern += "g" if x < good else "b" if x < good + bad else "-"
        counts[pattern] = counts.get(pattern, 0) + 1
        truth.setdefault(pattern, []).append(kind == "b")
    found = quality.estimate(counts)
    error = sum(abs(found[p] - np.mean(t)) * len(t) for p, t in truth.items()) / 20_000
    assert error < 0.05 and quality.estimate({}) == {}


def test_scorer_separates():
    r = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(4000):
        bad = i % 2
        index = np.r_[r.integers(0, 500, 20), 600 + bad].astype(np.int32)
        rows.append(index)
        labels.append(float(bad))
    weights = quality.train(rows, np.array(labels))
    margins = [weights[i] @ quality.scales(i, np.array([len(i)])) for i in rows]
    assert np.mean((np.array(margins) > 0) == np.array(labels)) > 0.98


def test_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 0, 1), (8, 0, None), (9, None, 1)], LABELS)
    rows = quality.classified(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in rows)
    assert all(r.keep for r in rows if r.doc_id in (3, 4, 5))
    assert quality.classified(docs, spark.createDataFrame([], LABELS)).count() == docs.count()
    assert quality.classified(no_documents(spark), labels).collect() == []
    left = quality.without_rejected(docs, labels)
    assert left.columns == docs.columns and left.count() <= docs.count()
