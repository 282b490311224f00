import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from platterflow.llm import prefix_trie
from platterflow.llm.queries import ORACLES, op12_prefix_trie
from tests.llm.sql import same_as_sql

SCHEMA = "conv_id bigint, turn bigint, role string, text string, path string, sizes string, depth int, shard string, family string"
EXTRA = ("clash", None, 3, "s", "f")


def frame(spark, rows):
    return spark.createDataFrame([r + EXTRA for r in rows], SCHEMA)


def expected(rows):
    """Nodes by grouping every prefix of every conversation."""
    def digest(role, text):
        return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()

    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, digest(role, text), role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    below = defaultdict(list)
    for path in members:
        if path:
            below[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[p] for p in below[path]) or 1
        own_saved = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        saved[path] = own_saved + sum(saved[p] for p in below[path])
    return sorted((min(ids), len(path), min(members[path[:-1]]) if path else -10**18, len(ids), len(below[path]), leaves[path], saved[path],
                   hashlib.sha256(",".join(str(c) for c in sorted(ids) if rebuilt[c] == path).encode()).hexdigest())
                  for path, ids in members.items())


def got(found):
    return sorted((r.conv_id, r.depth, -10**18 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in found.collect())


def conversations(seed, many, copies=0, first=0.3):
    r = random.Random(seed)
    rows = []
    for c in range(many):
        for t in range(r.randint(1, 9)):
            common = r.random() < first
            rows.append((c, t, r.choice(["user", "assistant", "é"]), "hello" if common else r.choice("abcdeé日") * r.randint(0, 3)))
    for c in range(copies):
        rows += [(10_000 + c, t, "user", "hello" if t % 2 else "copy") for t in range(6)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("shards", [1, 3, 8, 40])
def test_random_conversations(spark, monkeypatch, shards):
    """Copies are a third of the conversations, so their end node is on the skeleton; pieces are short here."""
    monkeypatch.setattr(prefix_trie, "PIECE", 40)
    monkeypatch.setattr(prefix_trie, "ROWS", 50)
    rows = conversations(shards, 120, 60)
    assert got(prefix_trie.prefix_nodes(frame(spark, rows), shards)) == expected(rows)


def test_a_small_skeleton_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SKELETON", 12)
    rows = conversations(5, 100, 30)
    assert got(prefix_trie.prefix_nodes(frame(spark, rows), 30)) == expected(rows)


def test_odd_conversations(spark):
    rows = [(0, None, "user", "a"), (0, None, "user", "b"), (0, 1, None, None), (0, 1, None, None), (0, 1, "", ""), (None, 0, "user", "x"),
            (None, None, None, None), (7, 0, "user", "a" * 100_000), (-3, 5, "user", "日本"), (-4, 2, "user", "日本"), (2**61, 1, "u", "t"),
            (2**61 - 1, 1, "u", "t"), (12, 3, "a:b", ""), (13, 3, "a", ":b")]
    rows += [(20, t, "user", "long") for t in range(3000)] + [(21, t, "user", "long") for t in range(3000)]
    assert got(prefix_trie.prefix_nodes(frame(spark, rows), 4)) == expected(rows)
    assert got(prefix_trie.prefix_nodes(frame(spark, []), 4)) == []
    one = [(6, 0, "user", "only")]  # no family opener, and the only turn may be cut
    assert got(prefix_trie.prefix_nodes(frame(spark, one))) == expected(one)
    assert got(prefix_trie.prefix_nodes(frame(spark, [(None, 0, "user", "x")]))) == []


def test_turnless_conversations_belong_to_the_root(spark):
    rows = [(c, 0, "user", "t") for c in (1, 2, 3, 4, 6, 7, 8, 9)]
    nodes = expected(rows)
    assert got(prefix_trie.prefix_nodes(frame(spark, rows), 3)) == nodes
    assert any(n[1] == 0 and n[7] != hashlib.sha256(b"").hexdigest() for n in nodes)


def test_given_conversations(spark):
    folder = "/root/testdata/sf0.01"
    same_as_sql(op12_prefix_trie(spark, folder), ORACLES["op12_prefix_trie"], folder)
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/conversations.parquet").collect()]
    assert got(op12_prefix_trie(spark, "/root/testdata/sf0.1")) == expected(rows)
