import math

import numpy as np
import pytest

from platterflow.llm import embedding_dedup
from platterflow.llm.queries import ORACLES, op11_embedding_dedup
from tests.llm.sql import same_as_sql

SCHEMA = "vec_id bigint, embedding array<double>, label int, list string, class string, k1 int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "clash", "c", 1, None)
                                  for i, v in rows], SCHEMA)


def expected(rows, threshold=0.9):
    """n_links and component per place, by comparing all pairs."""
    good = [k for k, (_, v) in enumerate(rows) if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {k: [] for k in range(len(rows))}
    if good:
        points = np.array([rows[k][1] for k in good], dtype=float)
        points /= np.abs(points).max(axis=1, keepdims=True)
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        for a, near in zip(good, points @ points.T >= threshold):
            links[a] = [b for b, hit in zip(good, near) if hit and b != a]
    seen, out = {}, {}
    for k in links:
        if k not in seen:
            stack, group = [k], {k}
            while stack:
                for b in links[stack.pop()]:
                    if b not in group:
                        group.add(b)
                        stack.append(b)
            seen |= dict.fromkeys(group, group)
        ids = [rows[b][0] for b in seen[k] if rows[b][0] is not None]
        out[k] = (rows[k][0], len(links[k]), min(ids) if ids else None)
    return [out[k] for k in range(len(rows))]


def got(found):
    rows = [(r.vec_id, r.n_links, r.component_id) for r in found.collect()]
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.collect())
    return rows


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def near(rng, base, cosine):
    other = rng.standard_normal(len(base))
    base = base / np.linalg.norm(base)
    other -= other @ base * base
    return cosine * base + math.sqrt(1 - cosine ** 2) * other / np.linalg.norm(other)


def planted(seed, plain, groups, width=32):
    rng = np.random.default_rng(seed)
    points = [*rng.standard_normal((plain, width))]
    for size, cosine in groups:
        base = rng.standard_normal(width)
        points += [near(rng, base, cosine) for _ in range(size)]
    return [(i, p) for i, p in enumerate(points)]


@pytest.mark.parametrize("groups", [[(2, 0.99)] * 150, [(60, 0.985), (200, 0.975), (3, 0.97)]])
def test_planted_copies_against_all_pairs(spark, groups):
    rows = planted(1, 1500, groups)
    want, found = order(expected(rows)), order(got(embedding_dedup.near_vectors(frame(spark, rows))))
    assert [r[0] for r in found] == [r[0] for r in want]
    assert all(f[1] <= w[1] for f, w in zip(found, want))  # nothing below the threshold
    assert sum(f[1] for f in found) >= 0.97 * sum(w[1] for w in want)
    assert sum(f == w for f, w in zip(found, want)) >= 0.97 * len(want)


def test_recall_at_the_threshold(spark):
    """Pairs of cosine 0.9 to 0.92, one for each of 600 vectors: the hardest to find."""
    rng = np.random.default_rng(2)
    base = rng.standard_normal((600, 64))
    rows = [(i, p) for i, p in enumerate([*base, *(near(rng, b, rng.uniform(0.9001, 0.92)) for b in base), *rng.standard_normal((3000, 64))])]
    want = sum(r[1] for r in expected(rows))
    found = sum(r[1] for r in got(embedding_dedup.near_vectors(frame(spark, rows))))
    assert want >= 1200 and 0.95 * want <= found <= want


def test_crowds_have_hubs(spark, monkeypatch):
    """A third of all rows in one near group and some just outside of it; blocks and hubs are small here."""
    monkeypatch.setattr(embedding_dedup, "HOT", 60)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 50)
    rows = planted(3, 900, [(400, 0.98), (100, 0.93), (100, 0.985)])
    rng = np.random.default_rng(4)
    rows += [(5000 + i, near(rng, rows[950][1], c)) for i, c in enumerate(rng.uniform(0.8, 0.95, 200))]
    classes = frame(spark, rows)
    seen = []
    monkeypatch.setattr(embedding_dedup, "hubs", lambda *a, plain=embedding_dedup.hubs: seen.append(plain(*a)) or seen[-1])
    want, found = order(expected(rows)), order(got(embedding_dedup.near_vectors(classes)))
    assert len(seen[0]) >= 1
    assert all(f[1] <= w[1] for f, w in zip(found, want))
    assert sum(f[1] for f in found) >= 0.98 * sum(w[1] for w in want)
    assert [f[2] for f in found] == [w[2] for w in want]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1, 0]), (2, [1, 0.1]), (2, [1, 0.1]), (3, [0, 0]), (4, None), (5, []), (6, [nan, 1]), (7, [None, 1]), (8, [inf, 1]),
            (None, [1, 0]), (None, None), (9, [1e200, 0]), (10, [1e-200, 0]), (11, [-1, 0]), (12, [0, 1]), (12, [0, 1])]
    assert order(got(embedding_dedup.near_vectors(frame(spark, rows)))) == order(expected(rows))
    other = [(13, [1, 0, 0]), (14, [1, 0, 0])]  # of another length than most
    found = order(got(embedding_dedup.near_vectors(frame(spark, rows + other))))
    assert found == order(expected(rows) + [(13, 0, 13), (14, 0, 14)])
    assert got(embedding_dedup.near_vectors(frame(spark, []))) == []
    assert got(embedding_dedup.near_vectors(frame(spark, [(None, [1.0, 2.0]), (None, [1.0, 2.0])]))) == [(None, 1, None)] * 2
    assert got(embedding_dedup.near_vectors(frame(spark, [(1, [2.0]), (2, [3.0]), (3, [-1.0])]))) != []


def test_copies_of_a_third_are_one_class(spark):
    rows = planted(5, 600, [])
    rows += [(1000 + i, rows[0][1]) for i in range(300)]
    assert order(got(embedding_dedup.near_vectors(frame(spark, rows)))) == order(expected(rows))


def test_traversal_is_in_order_and_whole():
    rng = np.random.default_rng(6)
    for _ in range(50):
        a, b = rng.random(7).round(1), rng.random(5).round(1)
        found = list(embedding_dedup.traversal(a, b, 0.6))
        gaps = {i * 5 + j: a[i] + b[j] - a.min() - b.min() for i in range(7) for j in range(5)}
        assert [g for g, _ in found] == sorted(g for g, _ in found)
        clear = {c for c, g in gaps.items() if abs(g - 0.6) > 1e-9}
        assert {c for _, c in found} & clear == {c for c in clear if gaps[c] <= 0.6} and len({c for _, c in found}) == len(found)


def test_given_vectors_equal_sql(spark):
    same_as_sql(op11_embedding_dedup(spark, "/root/testdata/sf0.01"), ORACLES["op11_embedding_dedup"], "/root/testdata/sf0.01")
