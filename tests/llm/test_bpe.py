import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from platterflow.llm import bpe
from tests.llm.cases import no_documents, odd_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = "abc ÉéßΣσς İıǅ'sTt ́  \x1c\x1d\x85\n\t日本語🤖½²5٣Ⅷ_-<|>endoftext　ﬁÅￂ"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_and_decoding_equal_the_library(library):
    r = random.Random(5)
    texts = ["", "a" * 600, "<|endoftext|>", "x<|startoftext|>É Y", "<|ENDOFTEXT|>", "ab" * 2000, "日本語テキスト" * 60]
    texts += ["".join(r.choice(LETTERS) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    own = bpe.Vocabulary(PATH)
    for text, ids in zip(texts, own.encode(texts)):
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_short_and_long_words_merge_alike(monkeypatch):
    r = random.Random(6)
    texts = ["".join(r.choice("etaoinsh") for _ in range(r.randint(1, 60))) for _ in range(500)]
    short = bpe.Vocabulary(PATH).encode(texts)
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert bpe.Vocabulary(PATH).encode(texts) == short


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own = bpe.Vocabulary(PATH)
    assert [own.encode(["one two three"]), own.encode(["four one two"])] == [
        bpe.Vocabulary(PATH).encode(["one two three"]), bpe.Vocabulary(PATH).encode(["four one two"])]


def test_query_on_odd_documents(spark, library):
    docs = odd_documents(spark)
    got = sorted(map(tuple, bpe.round_trips(docs, PATH).collect()), key=str)
    expected = []
    for row in docs.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        digests = [" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)]
        expected.append((row.doc_id, len(ids), *(hashlib.sha256(d.encode()).hexdigest() for d in digests)))
    assert got == sorted(expected, key=str)
    assert bpe.round_trips(no_documents(spark), PATH).collect() == []


def test_round_trip_of_frames(spark, library):
    coded = bpe.encoded(odd_documents(spark), PATH)
    texts = {r.doc_id: r.text for r in bpe.decoded(coded, PATH).collect()}
    assert texts[6] == library.decode(library.encode("one", add_special_tokens=False).ids) and texts[4] == ""
