"""Whole-table ranks, totals and medians against plain Python, with many slices and hot values."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from platterflow.operators import metrics, ordering, prepare, split


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(7)
    return [(i, 0.0 if i % 3 == 0 else float(rng.randint(0, 400)), rng.randint(1, 9)) for i in range(4000)]


def test_running_totals(spark, many_slices, skewed):
    frame = spark.createDataFrame(skewed, "id int, v double, n bigint").repartition(8)
    got = {r.id: r.n_before for r in ordering.running_totals(frame, [F.col("v"), F.col("id")], ["n"]).collect()}
    total, want = 0, {}
    for i, v, n in sorted(skewed, key=lambda r: (r[1], r[0])):
        want[i], total = total, total + n
    assert got == want


def test_rank_with_a_third_of_the_rows_tied(spark, many_slices, skewed):
    frame = spark.createDataFrame(skewed, "id int, v double, n bigint")
    ranked = ordering.global_rank(frame, [F.col("v").desc(), F.col("id")])
    want = [r[0] for r in sorted(skewed, key=lambda r: (-r[1], r[0]))]
    assert [r.id for r in ranked.orderBy("rank").collect()] == want
    assert ranked.agg(F.min("rank"), F.max("rank"), F.count_distinct("rank")).first()[:] == (1, 4000, 4000)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 4000])
def test_medians(spark, many_slices, skewed, size):
    rows = skewed[:size]
    frame = spark.createDataFrame(rows, "id int, v double, n bigint").withColumn(
        "gone", F.lit(None).cast("double"))
    got = {r.feature: r["median"] for r in ordering.exact_medians(frame, ["v", "n", "gone"]).collect()}
    assert got == {"v": statistics.median(r[1] for r in rows), "n": statistics.median(r[2] for r in rows)}


def test_most_frequent_takes_the_smallest_of_a_tie(spark):
    frame = spark.createDataFrame([("b", "x"), ("a", "y"), ("b", "y"), ("a", None), (None, None)], "p string, q string")
    got = {r.feature: r["mode"] for r in ordering.most_frequent(frame, ["p", "q"]).collect()}
    assert got == {"p": "a", "q": "y"}


def test_impute(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "t string, n double")
    fills = prepare.fill_values(train, ["t"], ["n"])
    frame = spark.createDataFrame([(None, None), ("z", 9.0)], "t string, n double")
    assert [tuple(r) for r in prepare.impute(frame, fills, ["t"], ["n"]).collect()] == [("a", 2.0), ("z", 9.0)]


def test_rare_levels(spark):
    train = spark.createDataFrame([("a",)] * 3 + [("b",)], "t string")
    levels = prepare.level_counts(train, "t", 2)
    frame = spark.createDataFrame([("a",), ("b",), ("new",)], "t string")
    got = {r.t: r.level for r in prepare.pool_levels(frame, levels, "t", "level").collect()}
    assert got == {"a": "a", "b": "__infrequent__", "new": None}


@pytest.mark.parametrize("maximum, kept, cancelled", [(100, 50, 50), (1000, 334, 334), (5000, 3666, 334)])
def test_balanced_sample_sizes(spark, maximum, kept, cancelled):
    rows = [(f"o{i}", i % 12 == 0) for i in range(4000)]
    frame = spark.createDataFrame(rows, "order_id string, cancelled boolean")
    got = split.balanced_sample(frame, "cancelled", "order_id", maximum)
    counts = {r.cancelled: r["rows"] for r in split.class_counts(got, "cancelled").collect()}
    assert counts == {False: kept, True: cancelled}
    assert got.select("order_id").distinct().count() == kept + cancelled


def test_balanced_sample_does_not_depend_on_partitions(spark):
    rows = [(f"o{i}", i % 3 == 0) for i in range(2000)]
    frame = spark.createDataFrame(rows, "order_id string, cancelled boolean")
    draw = lambda f: {r.order_id for r in split.balanced_sample(f, "cancelled", "order_id", 600).collect()}
    first = draw(frame)
    assert first == draw(frame.repartition(13)) and len(first) == 600


def brute_scores(rows):
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    ap = before = 0.0
    for score in sorted({s for _, s in rows}, reverse=True):
        flagged = [y for y, s in rows if s >= score]
        recall = sum(flagged) / len(pos)
        ap, before = ap + (recall - before) * sum(flagged) / len(flagged), recall
    return auc, ap


@pytest.mark.parametrize("levels", [2, 5, 1000])
def test_auc_and_average_precision(spark, many_slices, levels):
    rng = random.Random(levels)
    rows = [(rng.random() < 0.3, float(rng.randint(0, levels))) for _ in range(300)]
    got = metrics.binary_scores(spark.createDataFrame(rows, "y boolean, s double"), "y", "s").first()
    auc, ap = brute_scores(rows)
    assert got.roc_auc == pytest.approx(auc, abs=1e-12) and got.average_precision == pytest.approx(ap, abs=1e-12)


def test_equal_scores_count_half(spark):
    frame = spark.createDataFrame([(True, 0.5), (False, 0.5)], "y boolean, s double")
    got = metrics.binary_scores(frame, "y", "s").first()
    assert (got.roc_auc, got.average_precision) == (0.5, 0.5)


def test_one_class_gives_no_auc(spark):
    got = metrics.binary_scores(spark.createDataFrame([(True, 0.5)], "y boolean, s double"), "y", "s").first()
    assert got.roc_auc is None and got.average_precision == 1.0


def test_regression_metrics(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (6.0, 4.0)], "y double, p double")
    got = metrics.regression_metrics(frame, "y", "p").first()
    assert (got.rmse, got.mae, got.r2, got["rows"]) == (1.29, 1.0, 0.6429, 3)
    assert metrics.mape(frame, "y", "p").first().mape == pytest.approx((1 + 0 + 1 / 3) / 3 * 100)


def test_chronological_split(spark):
    frame = spark.sql("select date_add(date'2024-01-01', cast(id as int)) date from range(100)")
    train, test = split.split_last_days(frame)
    last, first = train.agg(F.max("date")).first()[0], test.agg(F.min("date")).first()[0]
    assert last < first and test.count() == 30 and train.count() == 70


def test_small_training_sets_are_refused(spark):
    frame = spark.range(5)
    with pytest.raises(ValueError, match="at least 8"):
        split.require_rows(frame, None, 8)
    with pytest.raises(ValueError):
        split.require_rows(frame, spark.range(0), 2)


def test_scores_of_very_many_rows(spark):
    counts = spark.createDataFrame([(2.0, 2 * 10**10, 10**10), (1.0, 10**10, 3 * 10**10)], "score double, pos bigint, neg bigint")
    found = metrics.counted_scores(counts).first()
    assert (found.positives, found.negatives) == (3 * 10**10, 4 * 10**10)
    won = 10**10 * 10**10 + 3 * 10**10 * (2 * 10**10 + 10**10 / 2)
    assert found.roc_auc == pytest.approx(won / (12 * 10**20))
    assert found.average_precision == pytest.approx((2 * 2 / 3 + 1 * 3 / 7) / 3)
