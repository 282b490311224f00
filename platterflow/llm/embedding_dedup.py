"""Near-duplicate embeddings by an inverted multi-index: independent codebooks on vector halves, a grid of their products.

Vectors are scaled to length one. Two codebooks, one per half, are fitted by k-means on a sample; a vector belongs to the cell
(its nearest codeword in each half). A vector visits cells in order of distance, by the multi-sequence traversal, as far beyond
its nearest cell as `reach`, and is compared in double precision with all vectors of each cell it visits. To meet every pair
once, it visits only its own cell and cells of higher number. The reach is chosen for the target recall on vectors turned away
from sampled ones by just the threshold's angle, the hardest pairs to find; closer pairs are found more often.

No pair leaves a task. A task compares a block of a cell's vectors with those that visit it and returns numbers of links per
vector, and edges that connect what is connected: one per vector, not one per link.

Skew. Vectors equal in all components are one class with a size. A cell of over `HOT` classes, or one in `PARTS` of all, is a
crowd: its mean direction becomes a hub, and the vectors within half the threshold's angle of a hub are its core. Two of them
link by the triangle inequality, so a core of any size needs no comparisons inside; vectors further off than one and a half
angles cannot link to it, and only those between visit the core. Cores and cells over `BLOCK` classes are dealt into blocks.

Bounds: `SAMPLE` vectors train the codebooks; the driver also holds at most `PARTS` hubs, and a number of blocks for at most
`16 * PARTS` cells. All rows are indexed.

Defined results: a vector that is null, empty or zero, or holds null or non-finite components, links with nothing, nor does one
whose length is not the most frequent one (of equally frequent lengths the larger). Such rows, and rows without links, are
their own component. Every row is a vector of its own, repeated ids too; a component's id is its smallest vec_id, null where it
has none, and `kept` says that a row's id is its component's. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterflow.llm.components import components
from platterflow.session import keep

THRESHOLD, TARGET = 0.9, 0.97
SAMPLE, TURNED, ROUNDS = 16_384, 2_000, 8
# Vectors a cell holds on average, codewords at most, classes of a crowd or block at least, and hubs at most.
FILL, CODEWORDS, HOT, BLOCK, PARTS = 128, 1024, 1024, 1024, 4096
CHUNK = 1024


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, ok): v the vector as doubles, ok whether it can be compared."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.when(ok, v).alias("v"), ok.alias("ok"))


def unit(column: pa.Array, width: int) -> np.ndarray:
    """Rows of length one, scaled first so that squares neither overflow nor vanish."""
    rows = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def distances(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distances of rows to codewords."""
    return np.maximum((rows * rows).sum(1)[:, None] - 2 * rows @ words.T + (words * words).sum(1)[None], 0)


def codebook(rows: np.ndarray, size: int, seed: int) -> np.ndarray:
    """k-means on sampled half vectors; a codeword that no row chose stays where it was."""
    words = rows[np.random.default_rng(seed).permutation(len(rows))[:size]].copy()
    for _ in range(ROUNDS):
        near = distances(rows, words).argmin(1)
        held = np.bincount(near, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, near, rows)
        words[held > 0] = sums[held > 0] / held[held > 0, None]
    return words


def traversal(first: np.ndarray, second: np.ndarray, reach: float) -> Iterator[tuple[float, int]]:
    """Multi-sequence: (distance beyond the nearest cell, cell) in rising order up to `reach`, of one vector.

    Both halves' codewords are sorted by distance; a cell enters the heap when its left and lower neighbours have left it.
    """
    rows, columns = first.argsort(kind="stable"), second.argsort(kind="stable")
    a, b = (first[rows] - first[rows[0]]).tolist(), (second[columns] - second[columns[0]]).tolist()
    heap, left = [(0.0, 0, 0)], [0] * (len(a) + 1)  # left[i]: columns of row i that have left the heap
    while heap:
        gap, i, j = heapq.heappop(heap)
        if gap > reach:
            return
        yield gap, int(rows[i]) * len(second) + int(columns[j])
        left[i] = j + 1
        if i + 1 < len(a) and left[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or left[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))


@dataclass
class Index:
    """What every task needs: codebooks, reach, hubs, and the number of blocks of large lists."""

    width: int
    first: np.ndarray
    second: np.ndarray
    threshold: float
    reach: float = 0.0
    hubs: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    blocks: dict[int, int] = field(default_factory=dict)

    @property
    def angle(self) -> float:
        return math.acos(self.threshold)

    def halves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (distances(rows[:, :self.width // 2], self.first), distances(rows[:, self.width // 2:], self.second))

    def cells(self, rows: np.ndarray) -> np.ndarray:
        a, b = self.halves(rows)
        return a.argmin(1) * len(self.second) + b.argmin(1)

    def to_hubs(self, rows: np.ndarray) -> np.ndarray:
        """Angles of rows to hubs."""
        return np.arccos(np.clip(rows @ self.hubs.T, -1, 1)) if len(self.hubs) else np.full((len(rows), 0), np.inf)

    def lists(self, rows: np.ndarray) -> np.ndarray:
        """The list that holds each row: its cell, or -1 - h in the core of hub h."""
        cells, angles = self.cells(rows), self.to_hubs(rows)
        if not len(self.hubs):
            return cells
        near = angles.argmin(1)
        # A hair inside half the angle, so that rounding cannot join two vectors below the threshold.
        core = angles[np.arange(len(rows)), near] <= self.angle / 2 - 1e-7
        return np.where(core, -1 - near, cells)

    def visits(self, rows: np.ndarray, own: np.ndarray) -> Iterator[list[int]]:
        """The lists each row is compared with, so that every pair meets in one list at most."""
        a, b = self.halves(rows)
        near = self.to_hubs(rows) <= 1.5 * self.angle + 1e-7
        for r, home in enumerate(own.tolist()):
            found = [-1 - int(h) for h in np.flatnonzero(near[r])]
            if home < 0:  # of two cores the earlier hub's visits the other; cells come to cores
                yield [h for h in found if h < home]
            else:
                yield found + [cell for _, cell in traversal(a[r], b[r], self.reach) if cell > home] + [home]


def reach_for(index: Index, sample: np.ndarray, target: float) -> float:
    """Distance beyond the nearest cell that finds the target part of vectors turned by the threshold's angle.

    Half of them turn in any direction, half towards other sampled vectors, so that a sample that fills few
    directions counts as well; the larger reach of the two is taken.
    """
    draw = np.random.default_rng(7)
    base = sample[draw.permutation(len(sample))[:TURNED]]
    towards = sample[draw.integers(0, len(sample), len(base))]
    found = []
    for other in (draw.standard_normal(base.shape), towards):
        other = other - (other * base).sum(1, keepdims=True) * base
        length = np.sqrt((other * other).sum(1, keepdims=True))
        other = np.where(length > 1e-9, other / np.maximum(length, 1e-9), 0)
        turned = index.threshold * base + math.sqrt(1 - index.threshold ** 2) * other
        turned /= np.sqrt((turned * turned).sum(1, keepdims=True))
        here, there = index.cells(base), index.cells(turned)
        lower = np.where((here <= there)[:, None], base, turned)
        cell = np.maximum(here, there)
        a, b = index.halves(lower)
        at = np.arange(len(lower))
        gap = a[at, cell // len(index.second)] - a.min(1) + b[at, cell % len(index.second)] - b.min(1)
        found.append(float(np.quantile(gap, target, method="higher")))
    return max(found) + 1e-12


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows], pa.binary())


def fitted(classes: DataFrame, rows: int, width: int, threshold: float, target: float) -> Index:
    """Codebooks and reach from at most `SAMPLE` classes, chosen by a hash."""
    sample = classes.orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    points = unit(sample, width)
    size = max(1, min(CODEWORDS, round(math.sqrt(rows / FILL)), len(points)))
    index = Index(width, codebook(points[:, :width // 2], size, 1), codebook(points[:, width // 2:], size, 2), threshold)
    index.reach = reach_for(index, points, target)
    return index


def hubs(classes: DataFrame, index: Index, rows: int) -> np.ndarray:
    """Mean directions of crowded cells. A crowd within half the angle of a larger one is added to that."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            points = unit(batch["v"], index.width)
            cells = index.cells(points)
            for cell in np.unique(cells):
                own = points[cells == cell]
                total = sums.setdefault(int(cell), np.zeros(index.width + 1))
                total[:-1] += own.sum(0)
                total[-1] += len(own)
        yield pa.record_batch({"cell": pa.array(list(sums), pa.int64()),
                               "total": pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))})

    parts = classes.select("v").mapInArrow(add, "cell bigint, total array<double>")
    # Sizes first: only crowded cells, at most PARTS, are added up.
    least = max(HOT, rows // PARTS)
    sizes = parts.groupBy("cell").agg(F.sum(F.element_at("total", -1)).alias("n")).filter(F.col("n") > least)
    crowded = {r.cell: r.n for r in sizes.collect()}
    if not crowded:
        return np.zeros((0, index.width))
    wanted = parts.filter(F.col("cell").isin(list(crowded))).select("cell", F.posexplode("total").alias("at", "x"))
    centres = {cell: np.zeros(index.width + 1) for cell in crowded}
    for r in wanted.groupBy("cell", "at").agg(F.sum("x").alias("x")).collect():
        centres[r.cell][r.at] = r.x
    chosen: list[tuple[np.ndarray, np.ndarray]] = []  # direction of the first crowd, and the sum of all joined to it
    for cell in sorted(crowded, key=lambda c: (-crowded[c], c)):
        total = centres[cell][:-1]
        length = math.sqrt(float((total ** 2).sum()))
        if length > 1e-9:
            near = next((c for c in chosen if float(c[0] @ total) >= length * math.cos(index.angle / 2)), None)
            if near:
                near[1][:] += total
            else:
                chosen.append((total / length, total.copy()))
    return np.array([t / math.sqrt(float((t ** 2).sum())) for _, t in chosen]).reshape(-1, index.width)


def placed(classes: DataFrame, index: Index) -> DataFrame:
    """(class, n, v, list): v as the bytes of the unit vector in double precision."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = unit(batch["v"], index.width)
            yield pa.record_batch({"class": batch["class"], "n": batch["n"], "v": _bytes(points),
                                   "list": pa.array(index.lists(points), pa.int64())})

    return classes.select("class", "n", "v").mapInArrow(place, "class bigint, n bigint, v binary, list bigint")


def routed(members: DataFrame, index: Index) -> DataFrame:
    """(list, block, visitor, class, n, home, v): the members of each block, and the vectors that visit it."""
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.frombuffer(b"".join(batch["v"].to_pylist()), dtype=np.float64).reshape(-1, index.width)
            home = batch["list"].to_numpy()
            lists, blocks, take, visitor = [], [], [], []
            classes = batch["class"].to_numpy()
            for r, visited in enumerate(index.visits(points, home)):
                lists.append(int(home[r]))
                blocks.append(int(classes[r]) % index.blocks.get(int(home[r]), 1))
                take.append(r)
                visitor.append(False)
                for name in visited:
                    many = index.blocks.get(name, 1)
                    lists += [name] * many
                    blocks += range(many)
                    take += [r] * many
                    visitor += [True] * many
            picked = batch.take(pa.array(take, pa.int64()))
            yield pa.record_batch({
                "list": pa.array(lists, pa.int64()), "block": pa.array(blocks, pa.int64()), "visitor": pa.array(visitor),
                "class": picked["class"], "n": picked["n"], "home": picked["list"], "v": picked["v"]})

    return members.mapInArrow(
        route, "list bigint, block bigint, visitor boolean, class bigint, n bigint, home bigint, v binary")


class _Block:
    """The members of one block, compared with one chunk of visitors after another."""

    def __init__(self, name: int, width: int, threshold: float):
        self.name, self.width, self.threshold = name, width, threshold
        self.parts: list[tuple] = []
        self.members: tuple | None = None
        self.edges: list[tuple[int, int]] = []
        self.counts: list[tuple[np.ndarray, np.ndarray]] = []

    def root(self, at: int) -> int:
        while self.above[at] != at:
            self.above[at] = self.above[self.above[at]]
            at = self.above[at]
        return at

    def meet(self, ids: np.ndarray, n: np.ndarray, home: np.ndarray, points: np.ndarray) -> None:
        if self.members is None:
            self.members = tuple(np.concatenate(x) for x in zip(*self.parts))
            self.above, self.gained = list(range(len(self.members[0]))), np.zeros(len(self.members[0]), dtype=np.int64)
        own, sizes, rows = self.members
        linked = (points @ rows.T >= self.threshold) & (ids[:, None] != own[None])
        self.counts.append((ids, linked @ sizes))
        # Visitors from elsewhere are not visited back; those of this list meet its members from both sides.
        self.gained += (n * (home != self.name)) @ linked
        some = linked.any(1)
        if not some.any():
            return
        linked, ids = linked[some], ids[some]
        one = linked.argmax(1)
        self.edges += zip(ids.tolist(), own[one].tolist())
        pairs_of, member = np.nonzero(linked)
        roots = np.array([self.root(i) for i in range(len(own))])
        apart = roots[member] != roots[one[pairs_of]]
        for r, m in dict.fromkeys(zip(one[pairs_of[apart]].tolist(), member[apart].tolist())):
            self.above[self.root(m)] = self.root(r)

    def close(self) -> None:
        if self.members is not None:
            own = self.members[0]
            self.counts.append((own, self.gained))
            self.edges += [(int(own[i]), int(own[r])) for i in range(len(own)) if (r := self.root(i)) != i]


def compared(pairs: DataFrame, index: Index) -> DataFrame:
    """(class, links, other): numbers of links to add up (other null), and edges (links null)."""
    def rows_of(block: _Block) -> pa.RecordBatch:
        ids = np.concatenate([i for i, _ in block.counts]) if block.counts else np.zeros(0, dtype=np.int64)
        links = np.concatenate([c for _, c in block.counts]) if block.counts else ids
        ids, links = ids[links > 0], links[links > 0]
        a, b = [e[0] for e in block.edges], [e[1] for e in block.edges]
        block.counts, block.edges = [], []
        return pa.record_batch({
            "class": pa.array([*ids.tolist(), *a], pa.int64()), "links": pa.array([*links.tolist(), *[None] * len(a)], pa.int64()),
            "other": pa.array([*[None] * len(ids), *b], pa.int64())})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in batches:
            lists, blocks = batch["list"].to_numpy(), batch["block"].to_numpy()
            visitor = batch["visitor"].to_numpy(zero_copy_only=False)
            ids, n, home = batch["class"].to_numpy(), batch["n"].to_numpy(), batch["home"].to_numpy()
            points = np.frombuffer(b"".join(batch["v"].to_pylist()), dtype=np.float64).reshape(-1, index.width)
            changes = np.flatnonzero((np.diff(lists) != 0) | (np.diff(blocks) != 0) | (np.diff(visitor) != 0)) + 1
            for lo, hi in zip([0, *changes.tolist()], [*changes.tolist(), len(lists)]):
                if (int(lists[lo]), int(blocks[lo])) != key:
                    if block:
                        block.close()
                        yield rows_of(block)
                    key = int(lists[lo]), int(blocks[lo])
                    block = _Block(key[0], index.width, index.threshold)
                if not visitor[lo]:
                    block.parts.append((ids[lo:hi], n[lo:hi], points[lo:hi]))
                elif block.parts:
                    for at in range(lo, hi, CHUNK):
                        to = min(at + CHUNK, hi)
                        block.meet(ids[at:to], n[at:to], home[at:to], points[at:to])
                    yield rows_of(block)
        if block:
            block.close()
            yield rows_of(block)

    return pairs.repartition("list", "block").sortWithinPartitions("list", "block", "visitor").mapInArrow(
        compare, "class bigint, links bigint, other bigint")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    rows = keep(valid(vectors))
    widths = rows.filter("ok").groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    most = widths.orderBy(F.desc("n"), F.desc("width")).first()
    alone = [F.col("vec_id"), F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"),
             F.lit(True).alias("kept")]
    if most is None:
        return rows.select(*alone)
    fit = F.col("ok") & (F.size("v") == most.width)
    key = [F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), F.col("v")).alias("k2")]
    rows = rows.withColumn("fit", fit)
    ids = keep(rows.filter("fit").select("vec_id", *key))
    classes = keep(rows.filter("fit").select("vec_id", *key, "v").groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"), F.first("v").alias("v"))
        .withColumn("class", F.monotonically_increasing_id()))
    count = classes.count()
    index = fitted(classes, count, most.width, threshold, target)
    index.hubs = hubs(classes, index, count)
    members = keep(placed(classes, index))
    sizes = keep(members.groupBy("list").agg(
        F.count(F.lit(1)).alias("classes"), F.sum("n").alias("n"), F.min("class").alias("least")))
    block = max(BLOCK, count // (16 * PARTS))
    # Lists of more than a block: at most 16 * PARTS.
    index.blocks = {r.list: -(-r.classes // block) for r in sizes.filter(F.col("classes") > block).collect()}
    found = keep(compared(routed(members, index), index))
    # One row per hub.
    cores = F.broadcast(sizes.filter("list < 0").select("list", F.col("n").alias("core"), F.col("least").alias("centre")))
    inside = members.filter("list < 0").join(cores, "list")
    counted = found.filter("other IS NULL").select("class", "links").unionByName(
        inside.select("class", (F.col("core") - F.col("n")).alias("links"))).groupBy("class").agg(F.sum("links").alias("links"))
    edges = found.filter("other IS NOT NULL").select(F.col("class").alias("a"), F.col("other").alias("b")).unionByName(
        inside.select(F.col("class").alias("a"), F.col("centre").alias("b")).filter("a <> b"))
    joined = keep(classes.select("class", "k1", "k2", "n", "least").join(counted, "class", "left").join(
        components(edges).withColumnRenamed("member", "class"), "class", "left").select(
        "k1", "k2", "n", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "class").alias("root")))
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    results = joined.join(named, "root").select(
        "k1", "k2", (F.col("n") - 1 + F.col("links")).alias("n_links"), "component_id")
    return ids.join(results, ["k1", "k2"]).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")).unionByName(
        rows.filter("NOT fit").select(*alone))
