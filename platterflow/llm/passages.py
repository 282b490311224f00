"""What the two passage operators share: word hashes, minimisers, sorted seeds, texts by reference.

A document is referred to by its id and a hash of its text; rows that agree in both are one document.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterflow.llm.common import id_and_text, small_side
from platterflow.session import keep

WORD = re.compile("[^\\x20\\x09-\\x0d]+")
MIX = np.uint64(0x9E3779B97F4A7C15)
NULL_ID = -(1 << 63)
# Documents of a batch that have a gram, from which on they are paired within the batch.
FREQUENT = 8


def references(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, text); a null id is the smallest number."""
    return id_and_text(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), F.xxhash64("text").alias("digest"), "text")


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()  # of bytes: both know ASCII only


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words."""
    count = max(0, len(hashes) - size + 1)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total = total * MIX + hashes[i:i + count]
    total ^= total >> np.uint64(29)
    return total * MIX


def unsteady(grams: np.ndarray, longest: int) -> np.ndarray:
    """Positions without those of a run that repeats every few words, from its third period on."""
    ordered = np.sort(grams)
    if not (ordered[2:] == ordered[:-2]).any():  # a third period has a gram for the third time
        return np.arange(len(grams))
    again = np.zeros(len(grams), bool)
    for period in range(1, min(longest, (len(grams) - 1) // 2) + 1):
        same = grams[period:] == grams[:-period]
        again[2 * period:] |= same[period:] & same[:-period]
    return np.flatnonzero(~again)


def minimisers(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions that hold the smallest hash of some window; of a shorter text, its smallest."""
    if len(grams) <= window:
        return np.array([grams.argmin()]) if len(grams) else np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    return np.unique(views.argmin(1) + np.arange(len(views)))


def seeds(texts: DataFrame, size: int, window: int, compared: int) -> DataFrame:
    """Minimiser positions: (gram, doc_id, digest, at). `gram` hashes `compared` words from there."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, places, sizes = [], [], []
            for text in batch.column(2).to_pylist():
                hashes = word_hashes(words_of(text))
                at = minimisers(gram_hashes(hashes, size), window)
                found = gram_hashes(hashes, compared)
                at = at[at < len(found)]
                grams.append(found[at])
                places.append(at)
                sizes.append(len(at))
            picked = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(grams).view(np.int64)), batch.column(0).take(picked), batch.column(1).take(picked),
                 pa.array(np.concatenate(places).astype(np.int32))], names=["gram", "doc_id", "digest", "at"])

    return texts.select("doc_id", "digest", "text").mapInArrow(rows, "gram bigint, doc_id bigint, digest bigint, at int")


def _grouped(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Over seeds sorted by gram and document: where the gram, and where the document of each begins."""
    at = np.arange(len(rows))
    new = np.r_[True, rows[1:, 0] != rows[:-1, 0]]
    group = np.maximum.accumulate(np.where(new, at, 0))
    return group, np.maximum.accumulate(np.where(new | np.r_[True, (rows[1:, 1:3] != rows[:-1, 1:3]).any(1)], at, 0))


def _partners(rows: np.ndarray, later: np.ndarray, group: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each of the seeds `later`, none of a gram's first document, with the last one of the document before, and with the first."""
    before = document[later] - 1
    far = (rows[group[later], 1:] != rows[before, 1:]).any(1)
    return rows[np.r_[later, later[far]]], rows[np.r_[before, group[later[far]]]]


SEED_PAIR = "doc_id bigint, digest bigint, at int, from_id bigint, from_digest bigint, from_at int"
# Bytes of text whose seeds one task sorts at once, about.
SHARD_BYTES = 24 << 20


def distinct_references(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`references` whose digest is 0 unless several texts have the id, since few columns differ less than many."""
    texts = references(docs, id_col, text_col)
    several = texts.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).filter("low <> high")
    several = keep(several.select("doc_id", F.lit(True).alias("several")))
    count = several.count()
    if not count:
        return texts.withColumn("digest", F.lit(0).cast("bigint"))
    return texts.join(small_side(several, count), "doc_id", "left").select(
        "doc_id", F.when(F.col("several"), F.col("digest")).otherwise(F.lit(0)).alias("digest"), "text")


def packed_seeds(rows: np.ndarray) -> bytes:
    """Seeds (gram, doc_id, digest, at) in the order of documents: six bytes of each gram, and the rest compressed."""
    fresh = np.flatnonzero(np.r_[True, (rows[1:, 1:3] != rows[:-1, 1:3]).any(1)])
    counts = np.diff(np.r_[fresh, len(rows)])
    steps = np.diff(rows[:, 3], prepend=0).astype("<i4").view(np.uint8).reshape(-1, 4)
    ids = np.diff(rows[fresh, 1], prepend=0)
    rest = zlib.compress(b"".join([ids.astype("<i8").tobytes(), rows[fresh, 2].astype("<i8").tobytes(), counts.astype("<u4").tobytes(),
                                   np.ascontiguousarray(steps.T).tobytes()]), 1)
    grams = np.ascontiguousarray(rows[:, 0].astype("<i8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()
    return len(fresh).to_bytes(4, "little") + len(rows).to_bytes(4, "little") + grams + rest


def unpacked_seeds(blob: bytes) -> np.ndarray:
    documents, count = int.from_bytes(blob[:4], "little"), int.from_bytes(blob[4:8], "little")
    out = np.empty((count, 4), np.int64)
    grams = np.zeros((count, 8), np.uint8)
    grams[:, 2:] = np.frombuffer(blob, np.uint8, 6 * count, 8).reshape(-1, 6)
    rest = zlib.decompress(blob[8 + 6 * count:])
    counts = np.frombuffer(rest, "<u4", documents, 16 * documents)
    out[:, 0] = grams.view("<i8")[:, 0]
    out[:, 1] = np.repeat(np.cumsum(np.frombuffer(rest, "<i8", documents)), counts)
    out[:, 2] = np.repeat(np.frombuffer(rest, "<i8", documents, 8 * documents), counts)
    steps = np.ascontiguousarray(np.frombuffer(rest, np.uint8, 4 * count, 20 * documents).reshape(4, -1).T).view("<i4")[:, 0]
    out[:, 3] = np.cumsum(steps)
    return out


def local_seeds(texts: DataFrame, size: int, period: int, shards: int) -> DataFrame:
    """Seeds of whole documents at all places, (shard, blob): those of a batch of documents whose grams lie in one share of the
    hashes' range, packed. A gram is the first 48 bits of its hash.

    Where `FREQUENT` or more documents of a batch have a gram, only the first and the last of them hand it to other batches: a
    gram that a third of all documents have leaves a batch as two documents' seeds. The documents between are paired here, with
    the one before and the first: a pair is two seeds of a gram of its own.
    """
    def cut(grams: np.ndarray) -> np.ndarray:
        return grams >> np.uint64(16) << np.uint64(16)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for doc, digest, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                grams = gram_hashes(word_hashes(words_of(text)), size)
                at = unsteady(grams, period)
                part = np.empty((len(at), 4), np.int64)
                part[:, 0], part[:, 1], part[:, 2], part[:, 3] = cut(grams[at]).view(np.int64), doc, digest, at
                parts.append(part)
            made = np.concatenate(parts) if parts else np.empty((0, 4), np.int64)
            if not len(made):
                continue
            order = _shared(made[:, 0])
            order = order[np.lexsort(made[order].T[::-1])]
            ordered = made[order]
            handed = np.ones(len(made), bool)
            if len(ordered):
                group, document = _grouped(ordered)
                at = np.arange(len(ordered))
                ends = at[np.r_[group[1:] != group[:-1], True]]
                last = document[ends[np.searchsorted(ends, at)]]  # where the last document of the gram begins
                number = np.cumsum(document == at)  # of documents, over all grams
                frequent = number[last] - number[group] + 1 >= FREQUENT
                middle = frequent & (document > group) & (document < last)
                handed[order] = ~middle
                if middle.any():
                    later, earlier = _partners(ordered, at[middle | frequent & (document == last)], group, document)
                    own = later[:, 0].view(np.uint64)
                    for i in (1, 2, 3):
                        own = (own ^ later[:, i].view(np.uint64)) * MIX
                        own = (own ^ own >> np.uint64(31) ^ earlier[:, i].view(np.uint64)) * MIX
                    own = cut(own ^ own >> np.uint64(29)).view(np.int64)
                    made = np.concatenate([made[handed], *(np.c_[own, side[:, 1:]] for side in (later, earlier))])
            share = ((made[:, 0].view(np.uint64) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)
            by_share = np.argsort(share, kind="stable")
            made, share = made[by_share], share[by_share]
            cuts = np.flatnonzero(np.diff(share)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(made)]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(share[low:low + 1]), pa.array([packed_seeds(made[low:high])], pa.binary())], names=["shard", "blob"])

    return texts.select("doc_id", "digest", "text").mapInArrow(rows, "shard int, blob binary")


def _shared(grams: np.ndarray) -> np.ndarray:
    """Places of the grams that occur twice or more, in the order of grams."""
    order = np.argsort(grams)
    same = grams[order[1:]] == grams[order[:-1]]
    return order[np.r_[False, same] | np.r_[same, False]]


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over packed seeds sorted by shard: each seed with its partners, a shard at a time."""
    def pairs(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate([unpacked_seeds(b) for b in blobs])
        rows = rows[_shared(rows[:, 0])]
        if not len(rows):
            return
        rows = rows[np.lexsort(rows.T[::-1])]
        group, document = _grouped(rows)
        sides = _partners(rows, np.flatnonzero(document > group), group, document)
        for low in range(0, len(sides[0]), 1 << 18):
            columns = [pa.array(side[low:low + (1 << 18), i].astype(np.int32 if i == 3 else np.int64)) for side in sides for i in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "at", "from_id", "from_digest", "from_at"])

    shard, held = None, []
    for batch in batches:
        for of, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if of != shard and held:
                yield from pairs(held)
                held = []
            shard = of
            held.append(blob)
    if held:
        yield from pairs(held)


def seed_pairs(texts: DataFrame, size: int, period: int) -> DataFrame:
    """Each seed with the previous document's of its gram, and with the first one's.

    Hashes are even, so an equal share of their range is a shard without a look at the data; there are as many shards as bound
    what a task sorts, whatever the number of partitions. The pairs of a gram grow with its seeds, not with their square, and
    connect all its documents.
    """
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    shards = partitions * max(1, math.ceil(held / (partitions * SHARD_BYTES)))
    made = local_seeds(texts, size, period, shards)
    dealt = made.repartitionById(partitions, (F.col("shard") % partitions).cast("int")).sortWithinPartitions("shard")
    return dealt.mapInArrow(_met, SEED_PAIR)


def texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the references in `wanted`, stored; whole texts travel only for these."""
    reference = ["doc_id", "digest"]
    wanted = keep(wanted.select(*reference).distinct())
    found = keep(texts.join(small_side(wanted), reference, "left_semi"))
    # Texts are dealt anew for equal rows only.
    once = found.groupBy(*reference).count().filter("count > 1").isEmpty()
    return found if once else keep(found.dropDuplicates(reference))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans (first, end) joined where they touch."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the words of some spans, and without the white space behind them."""
    places = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for low, high in merged(spans):
        kept.append(text[at:places[low][0]])
        at = places[high][0] if high < len(places) else len(text)
    return "".join([*kept, text[at:]])
