import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from platterflow.llm import lm_score as L
from tests.llm.cases import no_documents, odd_documents

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(autouse=True)
def short_training(monkeypatch):
    monkeypatch.setattr(L.Attention.train, "__defaults__", (60, 11))


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), ""]


def check(found, rows):
    held = [d is None or zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    counts = Counter(t for (_, text), h in zip(rows, held) if not h for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    expected = []
    for (doc, text), h in zip(rows, held):
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens(text))
        expected.append((doc, h, len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), total, round(base, 5)))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert all(r.score < 0 for r in found)


@pytest.mark.parametrize("common", [20, L.COMMON])
def test_given_documents(spark, monkeypatch, common):
    monkeypatch.setattr(L, "COMMON", common)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = L.scored(docs, PATH, PATTERN).collect()
    check(found, [(r.doc_id, r.text) for r in docs.collect()])
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    check(L.scored(docs, PATH, PATTERN).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert L.scored(no_documents(spark), PATH, PATTERN).collect() == []
    untaught = docs.filter("doc_id IS NULL")
    assert L.scored(untaught, PATH, PATTERN).count() == untaught.count()


def small_model():
    r = np.random.default_rng(2)
    model = L.Attention(np.log(r.dirichlet(np.ones(L.CLASSES), 40)))
    ids = [r.integers(0, 39, n) for n in (1, 24, 25, 60)]
    cut = np.concatenate([L.windows(i) for i in ids])
    read = np.where(cut[:, :-1] == L.START, 0, np.where(cut[:, :-1] < 0, L.PAD, cut[:, :-1] + 1))
    coming = np.where(cut[:, L.CONTEXT + 1:] < 0, L.PAD, cut[:, L.CONTEXT + 1:] % L.CLASSES)
    return model, ids, read, coming


def test_each_id_is_scored_once_and_causally():
    model, ids, read, coming = small_model()
    assert (coming >= 0).sum() == sum(map(len, ids))
    everything = np.ones(L.CLASSES, bool)
    chosen, begun = model.log_likelihood(read, coming, everything)
    assert np.allclose(begun, 0, atol=1e-4)
    later = read.copy()
    later[:, L.CONTEXT + 5:] = 3
    again, _ = model.log_likelihood(later, coming, everything)
    assert np.allclose(chosen[:, :5], again[:, :5], atol=1e-5)
    total = sum(np.exp(model.log_likelihood(read[-1:], np.full_like(coming[-1:], c), everything)[0]) for c in range(L.CLASSES))
    assert np.allclose(total, 1, atol=1e-4)


def test_gradients():
    model, _, read, coming = small_model()
    for name in model.weights:
        model.weights[name] = model.weights[name].astype(np.float64)
    grads = model.gradients(read, coming)
    there = coming >= 0

    def loss():
        return -(model.log_likelihood(read, coming, np.ones(L.CLASSES, bool))[0] * there).sum() / there.sum()
    r = np.random.default_rng(3)
    for name, grad in grads.items():
        for _ in range(5):
            at = tuple(r.integers(0, n) for n in grad.shape)
            kept = model.weights[name][at]
            model.weights[name][at] = kept + 1e-2
            high = loss()
            model.weights[name][at] = kept - 1e-2
            low = loss()
            model.weights[name][at] = kept
            assert (high - low) / 2e-2 == pytest.approx(grad[at], abs=2e-4)


def test_word_probabilities_sum_to_less_than_one():
    ids = L.subwords(PATH, PATTERN)
    assert ids(L.words_of("The house")).tolist()[-1] == ids.end
    assert ids.word(ids(L.words_of("house"))[:-1]) == "house"
    parts = [ids(L.words_of(w))[:-1].tolist() for w in ("été", "c'est", "日本", "x y", " z")]
    assert ids(L.words_of("été c'est 日本 x y  z"))[:-1].tolist() == sum(parts, [])


def test_the_weights_learn_from_documents_outside_the_sample(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "one two three four five six seven " * 40) for i in range(60)], "doc_id bigint, text string")
    monkeypatch.setattr(L, "SAMPLE", 0)

    def total(rate):
        monkeypatch.setattr(L, "PASS_RATE", rate)
        return sum(r.score for r in L.scored(docs, PATH, PATTERN).collect())
    assert total(0.02) > total(0.0) + 0.05


def test_mean_of_the_tasks_is_weighted_by_windows(spark):
    encode = L.subwords(PATH, PATTERN)
    groups = L.Groups(np.ones(len(encode.begins)), encode.begins)
    texts = [encode(L.words_of("lorem ipsum dolor " * 30 * (i + 1))) for i in range(4)]
    model = L.Attention(np.zeros((groups.rows, L.CLASSES)))
    start = model.flat()
    frame = spark.createDataFrame([(bytearray(t.tobytes()),) for t in texts], "ids binary").repartition(2).localCheckpoint()
    L._trained(frame, model, groups)
    one = L.Attention(np.zeros((groups.rows, L.CLASSES)))
    L._trained(frame.coalesce(1), one, groups)
    assert np.abs(model.flat() - start).max() > 0 and np.abs(one.flat() - start).max() > 0
    L._trained(frame.limit(0), one, groups)
    after = L._taught(frame, groups).collect()
    assert sum(r.n for r in after) == sum(map(len, texts))
    seen = Counter()
    for t in texts:
        seen.update((np.r_[0, groups.row[t[:-1]]] * L.CLASSES + groups.of_id[t]).tolist())
    assert {r.key: r.n for r in after} == seen


def test_ids_of_words_on_their_own():
    ids = L.subwords(PATH, PATTERN)
    words = L.words_of("été c'est 1234567 日本 x y's  z     　  q ---")
    assert ids.apart(words) == [ids(L.words_of(w.decode()))[:-1].tobytes() for w in words]
    assert ids.apart([]) == []
