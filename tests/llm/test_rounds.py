"""What the rounds of the searches move."""

import contextlib

from platterflow.llm import exact_dedup, passages, simhash, substring_dedup


@contextlib.contextmanager
def joined_by_hints_alone(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def watched(monkeypatch, module):
    """The frames that a module stores, as they are stored."""
    frames, real = [], module.keep

    def kept(frame):
        frames.append((frame.columns, frame._jdf.queryExecution().executedPlan().toString()))
        return real(frame)
    monkeypatch.setattr(module, "keep", kept)
    return frames


def test_texts_that_come_once_are_not_shuffled(spark, monkeypatch):
    frames = watched(monkeypatch, passages)
    texts = spark.createDataFrame([(1, 0, "a b"), (2, 0, "c"), (3, 0, "d")], "doc_id bigint, digest bigint, text string")
    wanted = spark.createDataFrame([(1, 0), (3, 0), (3, 0)], "doc_id bigint, digest bigint")
    want = [(1, 0, "a b"), (3, 0, "d")]
    assert sorted(map(tuple, passages.texts_of(texts, wanted).collect())) == want
    with_text = [plan for columns, plan in frames if "text" in columns]
    assert with_text and not any("hashpartitioning" in plan for plan in with_text)
    assert sorted(map(tuple, passages.texts_of(texts.unionByName(texts), wanted).collect())) == want


def test_rounds_join_stored_texts_to_few_pairs_without_a_shuffle(spark, monkeypatch):
    frames = watched(monkeypatch, substring_dedup)
    texts = spark.createDataFrame([(1, 0, "a b"), (2, 0, "c"), (3, 0, "d")], "doc_id bigint, digest bigint, text string")
    pairs = spark.createDataFrame([(3, 0, 1, 0)], "doc_id bigint, digest bigint, from_id bigint, from_digest bigint")
    with joined_by_hints_alone(spark):
        held = substring_dedup._held(texts, pairs)
    assert sorted(map(tuple, held.collect())) == [(1, 0, "a b"), (3, 0, "d")]
    assert frames and not any("hashpartitioning" in plan for _, plan in frames)


def test_names_and_first_documents_come_back_by_a_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "x" * 3000), (2, "x" * 3000), (3, "y")], "doc_id bigint, text string")
    frames = watched(monkeypatch, exact_dedup)
    with joined_by_hints_alone(spark):
        named = exact_dedup._named(docs.selectExpr("doc_id AS row_id", "1 AS n", "0 AS at", "text AS a"), "a").collect()
    assert len({r.name for r in named}) == 2 and len(named) == 3
    assert frames and not any("SortMergeJoin" in plan for _, plan in frames)
    frames = watched(monkeypatch, simhash)
    with joined_by_hints_alone(spark):
        assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == [1, 3]
    plans = [plan for columns, plan in frames if "document" in columns or columns == ["__id", "__digest"]]
    assert len(plans) == 2 and not any("SortMergeJoin" in plan for plan in plans)


def test_periods_are_looked_for_where_a_gram_comes_three_times():
    import numpy as np

    def plain(grams, longest):
        return [i for i in range(len(grams)) if not any(
            grams[i] == grams[i - p] == grams[i - 2 * p] for p in range(1, min(longest, (len(grams) - 1) // 2) + 1) if i >= 2 * p)]
    r = np.random.default_rng(2)
    for size in (0, 1, 2, 3, 9, 40):
        for kinds in (2, 5, 1000):
            grams = r.integers(0, kinds, size).astype(np.uint64)
            assert passages.unsteady(grams, 4).tolist() == plain(grams, 4)
