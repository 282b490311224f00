"""Near duplicates by SimHash fingerprints and a hierarchical index in Gray order.

A fingerprint bit is 1 if it is set in over half of the 64-bit hashes of a text's word shingles.
Two fingerprints are linked if they differ in at most `BITS` bits.

The distinct fingerprints are the leaves of an index whose upper nodes are bit patterns under a
mask. Fingerprints that differ in at most two bits agree on at least one of three parts of their
bits, so a fingerprint belongs to three nodes at the first level, each of which fixes one part. A
node of more than `LEAF` fingerprints is replaced by the nodes that fix a third of what it leaves
free, and so on; the last level leaves so few bits free that a node cannot hold more. No link is
lost on the way. Inside a node the fingerprints are sorted by Gray rank, so that neighbours share
most bits; runs of them, and runs of runs, are factored into the bits that all members share. A
search goes down that tree for all fingerprints of the node together, adds up the differences from
the shared bits, and drops a whole run as soon as they exceed the distance.

A node gives only enough links to connect what is near, not all pairs. Copies share a fingerprint
and are one leaf. Texts with fewer words than a shingle have the whole sequence as their shingle,
texts without words (null and empty ones too) the fingerprint zero, linked like any other. Rows
with a null id take part, but only other ids can name a component. Only the id and the text are
read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterflow.llm.common import id_and_text, small_side
from platterflow.llm.components import components
from platterflow.session import keep

SHINGLE = 3
BITS = 2
LEAF = 128
FAN = 8
SEED = 42
# Shingles hashed at a time.
CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = text.encode().lower().split()  # of bytes: both know ASCII only
    if not words:
        return 0
    total = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, total, CHUNK):
        part = words[start:start + CHUNK + shingle - 1]
        shingles = map(b" ".join, zip(*[part[i:] for i in range(shingle)])) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text, shingle) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[::2], pa.array(prints, pa.int64())], names=["doc_id", "digest", "fp"])

    texts = id_and_text(docs, id_col, text_col).select("doc_id", "text", F.xxhash64("text").alias("digest"))
    return texts.mapInArrow(rows, "doc_id bigint, digest bigint, fp bigint")


def _children(mask: int, ways: int) -> list[int]:
    """The masks that fix, beside `mask`, one of `ways` parts of the bits it leaves free."""
    free = [b for b in range(63, -1, -1) if not mask >> b & 1]
    cuts = [len(free) * i // ways for i in range(ways + 1)]
    return [mask | sum(1 << b for b in free[low:high]) for low, high in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def gray_rank(prints: np.ndarray) -> np.ndarray:
    rank = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def near_pairs(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions i < j of distinct fingerprints, sorted by Gray rank, that differ in at most `bits`."""
    levels = [(prints, prints)]  # of each node, bottom up: the AND and the OR of its members
    while len(levels[-1][0]) > FAN:
        starts = np.arange(0, len(levels[-1][0]), FAN)
        levels.append((np.bitwise_and.reduceat(levels[-1][0], starts), np.bitwise_or.reduceat(levels[-1][1], starts)))
    count = len(levels[-1][0])
    query = np.repeat(np.arange(len(prints)), count)
    node = np.tile(np.arange(count), len(prints))
    fixed = np.zeros(len(query), np.uint64)  # the bits compared so far
    apart = np.zeros(len(query), np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        both, either = levels[depth]
        shared = ~(both ^ either)[node]
        apart = apart + np.bitwise_count((prints[query] ^ both[node]) & shared & ~fixed)
        # A node whose last member comes before the query has nothing to add.
        near = (apart <= bits) & ((node + 1) * FAN ** depth > query)
        query, node, fixed, apart = query[near], node[near], shared[near], apart[near]
        if depth:
            size = len(levels[depth - 1][0])
            node = (node[:, None] * FAN + np.arange(FAN)).ravel()
            query, fixed, apart = (np.repeat(x, FAN) for x in (query, fixed, apart))
            there = node < size
            query, node, fixed, apart = query[there], node[there], fixed[there], apart[there]
    pair = query < node
    return query[pair], node[pair]


def _roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    root = np.arange(count)
    while True:
        least = np.minimum(root[left], root[right])
        new = root.copy()
        for side in (left, right):
            np.minimum.at(new, root[side], least)
            np.minimum.at(new, side, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _leaf_links(bits: int):
    def links(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = members.view(np.uint64)
        prints = prints[np.argsort(gray_rank(prints))]
        root = _roots(len(prints), *near_pairs(prints, bits))
        moved = root != np.arange(len(prints))
        return prints[moved].view(np.int64), prints[root[moved]].view(np.int64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows sorted by node; a node may go on in the next batch."""
        held = [np.empty(0, np.int64)] * 3
        for batch in _then_end(batches):
            if batch is not None:
                held = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns)]
            mask, pattern, prints = held
            if not len(prints):
                continue
            begins = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])])
            ends = np.r_[begins[1:], len(prints)]
            if batch is not None:
                held = [h[begins[-1]:] for h in held]
                begins, ends = begins[:-1], ends[:-1]
            twos = ends - begins == 2
            first = begins[twos]
            near = np.bitwise_count((prints[first] ^ prints[first + 1]).view(np.uint64)) <= bits
            found = [(prints[first[near] + 1], prints[first[near]])]
            found += [links(prints[b:e]) for b, e in zip(begins[~twos], ends[~twos]) if e - b > 2]
            left, right = (np.concatenate(side) for side in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], names=["a", "b"])

    return rows


def _then_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def links(prints: DataFrame, bits: int = BITS, leaf: int = LEAF) -> DataFrame:
    """From distinct values `fp`: links (a, b) that connect all that differ in at most `bits` bits."""
    spark, ways = prints.sparkSession, bits + 1
    masks = _children(0, ways)
    pattern = F.col("fp").bitwiseAND(F.col("mask"))
    every = F.explode(F.array(*[F.lit(_signed(m)).cast("bigint") for m in masks])).alias("mask")
    rows, found = prints.select("fp", every).withColumn("pattern", pattern), []
    while True:
        sizes = keep(rows.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
        # With so few free bits a node is a leaf whatever it holds.
        bounded = max(64 - m.bit_count() for m in masks) <= max(bits, leaf.bit_length() - 1)
        rows = rows.join(sizes, ["mask", "pattern"])
        leaves = rows if bounded else rows.filter(F.col("n") <= leaf)
        node = leaves.select("mask", "pattern", "fp").repartition("mask", "pattern").sortWithinPartitions("mask", "pattern")
        found.append(node.mapInArrow(_leaf_links(bits), "a bigint, b bigint"))
        if bounded or sizes.filter(F.col("n") > leaf).isEmpty():
            break
        pairs = [(_signed(m), _signed(c)) for m in masks for c in _children(m, ways)]
        masks = sorted({c for m in masks for c in _children(m, ways)})
        # One row per mask of the level: at most ways to the power of the levels.
        finer = F.broadcast(spark.createDataFrame(pairs, "mask bigint, finer bigint"))
        rows = keep(rows.filter(F.col("n") > leaf).join(finer, "mask").select("fp", F.col("finer").alias("mask"))
                    .withColumn("pattern", pattern).distinct())
    linked = found[0]
    for more in found[1:]:
        linked = linked.unionByName(more)
    return linked


def _grouped(docs: DataFrame, shingle: int, bits: int, id_col: str, text_col: str) -> DataFrame:
    """Per document: (doc_id, digest of its text, fp, root, component_id)."""
    printed = keep(fingerprints(docs, shingle, id_col, text_col))
    distinct = keep(printed.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct.select("fp"), bits))
    rooted = keep(distinct.join(roots, F.col("fp") == F.col("member"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = keep(rooted.join(least, "root").select("fp", "root", "component_id"))
    return printed.join(small_side(named), "fp")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, fingerprint as 16 hex digits, component_id."""
    return _grouped(docs, shingle, bits, id_col, text_col).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Rows that agree in id and text are one document here. A null id is the largest.
    """
    grouped = keep(_grouped(docs, shingle, bits, id_col, text_col).withColumn("document", F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "digest")))
    stays = keep(grouped.groupBy("root").agg(F.min("document").alias("stays")))
    gone = keep(grouped.join(small_side(stays), "root").filter(F.col("document") != F.col("stays")).select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct())
    same = F.col(id_col).cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("__digest"))
    return docs.join(small_side(gone), same, "left_anti")
