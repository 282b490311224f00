"""Documents drawn towards the word statistics of a target: array-scored weights, then a distributed quickselect.

Words are maximal runs of digits, letters a-z and characters beyond ASCII of a text whose A-Z are lower-cased; features are
all runs of one to three consecutive words, hashed to `BUCKETS` buckets. A bucket's gain says how much more frequent it is in
the target than in the documents; the gains of all buckets form one array of fixed size, and a document's weight is the sum
of that array over its features. Gumbel noise from its id is added, so that the highest scores are a weighted draw without
replacement.

The k highest scores are found without sorting the table: random keys are taken as pivots, one pass counts the rows before
and at each pivot, and the range that holds the k-th key narrows until a pivot is that key. Only the rows up to it are
sorted and ranked.

A text is split once: its buckets are stored two bytes each, and both the counts and the weights read these. Counts leave a
task as at most `BUCKETS` rows, whatever it read.

Defined results: a null or empty text, or one without words, has no features and weight 0. Only documents with `least_words`
words take part in the draw. Documents of one score are ordered by id, null ids last, then by number of features; rows that
are equal in all of these are interchangeable. A repeated row or id is drawn on its own. An empty table gives no rows, an
empty target gains that fall with a bucket's frequency. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platterflow.llm.common import id_and_text
from platterflow.operators.ordering import global_rank
from platterflow.session import keep

BUCKETS, LONGEST_RUN = 10_000, 3
LEAST_WORDS, PERCENT = 20, 5
# Pivots of a round: the range shrinks to about a sixteenth in each.
PIVOTS = 16
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def buckets(text: str) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every feature. CRC-32 goes on from a run to the run one word longer."""
    crc, found = zlib.crc32, []
    before: list[int] = []  # checksums of the runs that end at the last word, the shortest first
    words = WORD.findall(text.encode("utf-8", "surrogatepass").lower())
    for word in words:
        more = b" " + word
        before = [crc(word), *[crc(more, run) for run in before[:LONGEST_RUN - 1]]]
        found += before
    return len(words), (np.array(found, dtype=np.uint32) % BUCKETS).astype(np.uint16)


def hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, features) of all documents; features are the buckets, two bytes each."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [buckets(text) for text in batch["text"].to_pylist()]
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "n_words": pa.array([n for n, _ in pairs], pa.int64()),
                "features": pa.array([found.tobytes() for _, found in pairs], pa.binary())})

    return id_and_text(docs).mapInArrow(split, "doc_id bigint, n_words bigint, features binary")


def bucket_counts(features: DataFrame) -> np.ndarray:
    """Features per bucket over the whole table; each task adds up its rows first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for found in batch["features"]:
                total += np.bincount(np.frombuffer(found.as_buffer(), dtype=np.uint16), minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(held, pa.int32()), "n": pa.array(total[held], pa.int64())})

    counts = np.zeros(BUCKETS, dtype=np.int64)
    for row in features.select("features").mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(
            F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        counts[row.bucket] = row.n
    return counts


def gains(ours: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the two smoothed frequencies, rounded down, by bucket."""
    total, wanted = int(ours.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log(((t + 1) * total) / ((s + 1) * wanted)))
                     for s, t in zip(ours.tolist(), target.tolist())], dtype=np.int64)


def noise(doc_id: int | None) -> int:
    """Gumbel noise in thousandths from the id; a null id counts as the empty text."""
    drawn = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def scored(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score)."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(f.as_buffer(), dtype=np.uint16) for f in batch["features"]]
            weights = [int(gain[f].sum()) for f in found]
            ids = batch["doc_id"].to_pylist()
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "n_words": batch["n_words"],
                "n_features": pa.array([len(f) for f in found], pa.int64()), "weight": pa.array(weights, pa.int64()),
                "score": pa.array([w + noise(i) for w, i in zip(weights, ids)], pa.int64())})

    return features.mapInArrow(score, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


KEY = ("down", "no_id", "id", "size", "place")


def keyed(rows: DataFrame) -> DataFrame:
    """Adds the parts of the key that orders the draw; `place` tells equal rows apart and is to be stored."""
    return rows.withColumns({
        "down": -F.col("score"), "no_id": F.col("doc_id").isNull().cast("int"),
        "id": F.coalesce("doc_id", F.lit(0).cast("bigint")), "size": F.col("n_features"),
        "place": F.monotonically_increasing_id()})


def _compared(pivot: tuple) -> tuple[Column, Column]:
    """Whether a row comes before the pivot, and whether it is the pivot."""
    before, same = F.lit(False), F.lit(True)
    for name, value in zip(KEY, pivot):
        before = before | (same & (F.col(name) < F.lit(value)))
        same = same & (F.col(name) == F.lit(value))
    return before, same


def kth_key(rows: DataFrame, k: int, seed: int = 42) -> tuple:
    """The k-th smallest key, k from 1 to the number of stored rows, by counting passes over shrinking ranges.

    A pass returns two counts per pivot. The range that is left loses at least its pivots, so the end does not depend on luck.
    """
    left = rows.select(*KEY)
    while True:
        seed += 1
        # PIVOTS rows reach the driver, however many are left.
        pivots = sorted({tuple(r) for r in left.orderBy(F.rand(seed)).limit(PIVOTS).collect()})
        counts = left.agg(*[F.count(F.when(test, 1)).alias(f"{name}{i}") for i, pivot in enumerate(pivots)
                            for name, test in zip(("before", "at"), _compared(pivot))]).first()
        low = None
        for i, pivot in enumerate(pivots):
            before, at = counts[f"before{i}"], counts[f"at{i}"]
            if before < k <= before + at:
                return pivot
            if k <= before:
                left = left.filter(_compared(pivot)[0])
                break
            low = (pivot, before + at)
        if low:
            before, same = _compared(low[0])
            left, k = left.filter(~before & ~same), k - low[1]


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Per document: doc_id, n_features, weight, score, and the rank in the draw or null."""
    features = keep(hashed(docs))
    wanted = hashed(target.select(F.lit(None).cast("bigint").alias("doc_id"), "text"))
    gain = gains(bucket_counts(features), bucket_counts(wanted))
    rows = keep(keyed(scored(features, gain)))
    columns = [F.col(c) for c in ("doc_id", "n_features", "weight", "score")]
    fit = F.col("n_words") >= least_words
    k = percent * rows.filter(fit).count() // 100
    if not k:
        return rows.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    before, same = _compared(kth_key(rows.filter(fit), k))
    won = fit & (before | same)
    winners = global_rank(rows.filter(won), [F.col(c) for c in KEY])
    return winners.select(*columns, F.col("rank").cast("bigint")).unionByName(
        rows.filter(~won).select(*columns, F.lit(None).cast("bigint").alias("rank")))
