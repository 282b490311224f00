import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from platterflow.llm import importance
from platterflow.llm.queries import ORACLES, op13_importance
from tests.llm.cases import no_documents, odd_documents, words
from tests.llm.sql import same_as_sql

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = WORD.findall(lower)
    runs = [" ".join(found[i:i + n]) for n in (1, 2, 3) for i in range(len(found) - n + 1)]
    return len(found), [zlib.crc32(r.encode()) % 10000 for r in runs]


def expected(docs, target, percent=5, least=20):
    split = [features(text) for _, text in docs]
    s, t = Counter(b for _, f in split for b in f), Counter(b for text in target for b in features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log(((t[b] + 1) * (s_all + 10000)) / ((s[b] + 1) * (t_all + 10000))))

    rows = []
    for (doc, _), (n, f) in zip(docs, split):
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(b) for b in f)
        rows.append((doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    fit = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = fit[:percent * len(fit) // 100]
    left = [r for r in rows if r[4] < least] + fit[len(drawn):]
    return ordered([r[:4] + (i + 1,) for i, r in enumerate(drawn)] + [r[:4] + (None,) for r in left])


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x or 0) for x in r))


def check(found, docs, target, **options):
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert ordered(found.collect()) == expected(docs, target, **options)


@pytest.mark.parametrize("pivots", [1, 3, 16])
def test_given_documents(spark, monkeypatch, pivots):
    monkeypatch.setattr(importance, "PIVOTS", pivots)
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    check(op13_importance(spark, folder), docs, target)


def test_given_documents_equal_sql(spark):
    same_as_sql(op13_importance(spark, "/root/testdata/sf0.01"), ORACLES["op13_importance"], "/root/testdata/sf0.01")


def test_odd_documents(spark):
    docs, target = odd_documents(spark), ["the cat sat on the mat", None, "", "É é 日本語"]
    wanted = spark.createDataFrame([(t, "clash") for t in target], "text string, n_words string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(importance.resampled(docs, wanted, 50, 3), rows, target, percent=50, least=3)
    check(importance.resampled(docs, wanted, 100, 0), rows, target, percent=100, least=0)
    check(importance.resampled(docs, wanted.limit(0)), rows, [])
    check(importance.resampled(docs, wanted, 0), rows, target, percent=0)
    assert importance.resampled(no_documents(spark), wanted).collect() == []


def test_a_third_of_equal_rows_around_the_last_place(spark, many_slices):
    """Half of the draw are rows equal to the last one drawn: as many as needed of them are ranked, in no special order."""
    r = random.Random(1)
    docs = [(i, words(i, r.randint(20, 40))) for i in range(300)] + [(7, words(7, 30))] * 150
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    target = [docs[0][1], docs[7][1], docs[9][1]]
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (5, 20, 40, 60):
        check(importance.resampled(frame, wanted, percent), docs, target, percent=percent)


def test_kth_key_by_pivots(spark, monkeypatch):
    monkeypatch.setattr(importance, "PIVOTS", 2)
    rows = importance.keyed(spark.range(200).select(
        F.when(F.col("id") % 50 > 0, F.col("id") % 9).alias("doc_id"), (F.col("id") % 5).alias("score"), (F.col("id") % 3).alias("n_features")))
    keys = sorted(tuple(r) for r in rows.select(*importance.KEY).collect())
    assert [importance.kth_key(rows, k) for k in (1, 2, 77, 199, 200)] == [keys[k - 1] for k in (1, 2, 77, 199, 200)]


def test_words_are_of_bytes_beyond_ascii():
    assert importance.buckets("Ab-c1 É x")[0] == 3
    assert importance.buckets("")[1].tolist() == []
