import random
import re

import numpy as np
import pytest
import xxhash

from platterflow.llm import simhash
from platterflow.llm.components import components
from platterflow.session import keep
from tests.llm.cases import no_documents, odd_documents


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(values, bits):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    ordered = sorted(values)
    for i, v in enumerate(ordered):
        for w in ordered[i + 1:]:
            if (v ^ w).bit_count() <= bits:
                a, b = find(v), find(w)
                root[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("bits, leaf", [(2, 128), (2, 8), (1, 4)])
def test_components_equal_brute_force(spark, bits, leaf):
    r = random.Random(3)
    base, values = r.getrandbits(64), set()
    for _ in range(250):  # a dense region, so that nodes are refined
        value = base
        for b in r.sample(range(40), r.randint(0, 5)):
            value ^= 1 << b
        values.add(value)
    for _ in range(60):
        value = r.getrandbits(64)
        values |= {value, value ^ 1 << r.randrange(64), value ^ 5 << r.randrange(60)}
    frame = keep(spark.createDataFrame([(signed(v),) for v in values], "fp bigint"))
    found = {r.member: r.root for r in components(simhash.links(frame, bits, leaf)).collect()}
    groups, expected = {}, {}
    for v in values:
        groups.setdefault(found.get(signed(v), signed(v)), set()).add(v)
    for v, root in slow_groups(values, bits).items():
        expected.setdefault(root, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_tree_search_equals_all_pairs():
    r = np.random.default_rng(1)
    prints = np.unique(r.integers(0, 1 << 12, 300).astype(np.uint64))
    prints = prints[np.argsort(simhash.gray_rank(prints))]
    left, right = simhash.near_pairs(prints, 2)
    expected = {(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints)) if int(prints[i] ^ prints[j]).bit_count() <= 2}
    assert set(zip(left.tolist(), right.tolist())) == expected and len(left) == len(expected)


def test_query_on_odd_documents(spark):
    docs = odd_documents(spark)
    rows = docs.collect()
    prints = [slow_print(r.text) for r in rows]
    roots = slow_groups(set(prints), 2)
    ids = {}
    for row, value in zip(rows, prints):
        if row.doc_id is not None:
            ids[roots[value]] = min(ids.get(roots[value], row.doc_id), row.doc_id)
    expected = [(row.doc_id, f"{value:016x}", ids.get(roots[value])) for row, value in zip(rows, prints)]
    got = [tuple(r) for r in simhash.near_groups(docs).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert simhash.near_groups(no_documents(spark)).collect() == []


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = " ".join(str(i) for i in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == whole == signed(slow_print(text))


def test_one_of_each(spark):
    docs = odd_documents(spark)
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert 1 in ids and 2 not in ids and 3 in ids and 4 not in ids and None not in ids
    assert simhash.one_of_each(no_documents(spark)).collect() == []
