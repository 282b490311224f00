import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from platterflow.llm import packing
from tests.llm.cases import no_documents, odd_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_place_takes_the_least_sum_of_squares():
    r = random.Random(1)
    window, lengths = 16, [r.randint(1, 16) for _ in range(400)]
    where, offsets, fills = packing.place(lengths, window)
    levels = []
    for size, slot, offset in zip(lengths, where, offsets):
        def cost(before):
            after = levels.copy()
            if before is None:
                after.append(size)
            else:
                after[before] += size
            return sum(after.count(h) ** 2 for h in range(1, window))
        possible = [cost(i) for i, h in enumerate(levels) if h + size <= window] + [cost(None)]
        chosen = slot if slot < len(levels) else None
        assert cost(chosen) == min(possible) and offset == (0 if chosen is None else levels[slot])
        if chosen is None:
            levels.append(size)
        else:
            levels[slot] += size
    assert levels == fills


def check(rows, texts, window=packing.WINDOW):
    library = Tokenizer.from_file(PATH)
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_document[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert len(by_document) == len(texts)
    for doc, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_document[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding, sum(r.length for r in rows)


@pytest.mark.parametrize("per_packer", [40, packing.PIECES_PER_PACKER])
def test_documents_are_packed_whole(spark, per_packer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.packed(docs, PATH, per_packer=per_packer).collect()
    padding, total = check(rows, {r.doc_id: r.text for r in docs.collect()})
    assert padding < (0.05 if per_packer == 40 else 0.01) * total


def test_odd_documents(spark):
    docs = odd_documents(spark).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    check(packing.packed(docs, PATH).collect(), {r.doc_id: r.text for r in docs.collect()})
    repeated = packing.packed(odd_documents(spark), PATH).collect()
    assert sum(r.start == 0 and r.doc_id == 2 for r in repeated) == 2 and sum(r.doc_id is None and r.start == 0 for r in repeated) == 2
    assert packing.packed(no_documents(spark), PATH).collect() == []


def test_pieces_without_the_library(spark):
    encode, library = packing.IdBytes(PATH), Tokenizer.from_file(PATH)
    r = random.Random(5)
    letters = "abc Éé'sTt ́  \x1c\x85\n\t日本語🤖½²5Ⅷ_-<|>endoftext　"
    for _ in range(3000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 40)))
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_third_of_equal_rows_is_dealt_over_all_packers(spark):
    rows = [(None, "")] * 1000 + [(i, "a b c " * (i % 50)) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    loose = packing.keep(packing.pieces(docs, PATH))
    sizes = [r["count"] for r in packing._placed(loose, 2048, 50).groupBy("packer").count().collect()]
    assert sum(sizes) == 3000 and len(sizes) == 60 and max(sizes) < 3 * 50


def test_texts_of_all_kinds_have_the_tokenizers_ids():
    tokenizer, encode = Tokenizer.from_file(PATH), packing.IdBytes(PATH)
    assert encode.ranks is not None
    r = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "\r\n", "a", "bc", "The", "é", "日本", "1", "'s", "...", "<|endoftext|>", "<", "\xa0", " ", "\x85", "\x1f", "🤖", "ſ",
             "ǅ", "²", "x" * 400, " " * 90]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert encode(text) == array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
    long = "ab" * 200_000
    assert encode(long) == array("I", tokenizer.encode(long, add_special_tokens=False).ids).tobytes()
