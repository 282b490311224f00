"""Quality classifier: weak labels from heuristic labellers, and a hashed linear scorer.

1. Insults differ by language, so they are learned: words, and beginnings of words, that are in far
   more toxic than other documents of a sample of at most `LABELLED` labelled ones.
2. Every document gets the votes of `LABELLERS`. A labeller says toxic, bad, or nothing; the
   labels of the sample vote too, as one more labeller, which also says good.
3. The votes of all documents are counted by pattern. Expectation-maximisation over the patterns
   estimates how often each labeller gives each vote to good, toxic and junk documents, and with
   that the probability of each pattern to be bad. There are at most 3 patterns to the power of
   the labellers, whatever the size of the corpus.
4. These probabilities label a sample of at most `TRAINED` documents, which trains a logistic
   scorer over hashed words, word beginnings and votes. It scores every document.

Texts are read whole. Null, empty and blank texts score 0 and are kept. Repeated rows are
scored alike; null ids are never in a sample. Without labels nothing is known of insults, and the
other labellers decide. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platterflow.llm.common import id_and_text, small_side
from platterflow.llm.spotsigs import ANCHORS
from platterflow.session import keep

# Labelled documents that teach insults and anchor the labellers, at most, about.
LABELLED = 20_000
# Documents with weak labels that train the scorer, at most, about.
TRAINED = 16_000
# An insult is in at least so many, and such a share, of the toxic documents of the sample, and so
# many times as often as in others.
LEAST_SEEN, LEAST_SHARE, ODDS = 4, 0.005, 8.0
# A document votes toxic whose distinct insults multiply to such odds.
TOXIC_ODDS = 200.0
INSULTS = 5_000
BEGINNING = 5
SLOTS = 1 << 18
UNLABELLED = 0.1
ROUNDS, EPOCHS, RATE, BATCH, DECAY = 40, 6, 0.3, 256, 1e-6
GOOD, NOTHING, TOXIC, BAD = "g", "-", "t", "b"
WORD = re.compile(r"[^\W\d_]+")
COMMON = frozenset(ANCHORS)

LABELLERS = ("symbols", "capitals", "tables", "repeats", "lines", "prose", "insults")


def votes(text: str, words: list[str], insults: dict[str, float]) -> str:
    """One letter per labeller, in the order of `LABELLERS`."""
    chunks = text.split()
    n, length = len(chunks), max(1, len(text))
    symbols = sum(map(text.count, "*#$%&|!{}<>=~^")) / length
    capitals = sum(1 for c in chunks if len(c) > 1 and c.isupper()) / max(1, n)
    tables = chunks.count("|") / max(1, n)
    distinct = len(set(chunks)) / max(1, n)
    lines = text.split("\n")
    again = 1 - len(set(lines)) / len(lines)
    common = sum(map(COMMON.__contains__, words)) / max(1, len(words))
    weight = insults.get
    evidence = sum(max(weight(w, 0.0), weight(w[:BEGINNING] + "-", 0.0)) for w in set(words))
    return "".join((
        BAD if symbols > 0.03 else NOTHING,
        BAD if n >= 5 and capitals > 0.4 else NOTHING,
        BAD if tables > 0.1 else NOTHING,
        BAD if n >= 20 and distinct < 0.4 else NOTHING,
        BAD if len(lines) >= 4 and again > 0.45 else NOTHING,
        BAD if n >= 40 and common < 0.02 else NOTHING,
        TOXIC if evidence >= math.log(TOXIC_ODDS) else NOTHING))


def _words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def terms_of(words: list[str]) -> set[str]:
    terms = set(words)
    return terms | {w[:BEGINNING] + "-" for w in terms if len(w) > BEGINNING}


def slots(pattern: str, words: list[str]) -> np.ndarray:
    """The features of a document: hashed terms, and behind them a slot for each vote."""
    hashed = np.fromiter(map(xxhash.xxh32_intdigest, terms_of(words)), np.uint32) % SLOTS
    cast = [SLOTS + 4 * k + (GOOD + NOTHING + TOXIC + BAD).index(vote) for k, vote in enumerate(pattern)]
    return np.r_[hashed.astype(np.int32), np.array(cast, np.int32)]


def scales(index: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The value of each feature: votes count in full, terms by the root of their number."""
    return np.where(index < SLOTS, np.repeat(1 / np.sqrt(sizes), sizes), 1.0)


def _sampled(frame: DataFrame, most: int, total: Column | int) -> DataFrame:
    """About `most` rows at most, the same ones whenever the ids are the same."""
    share = F.least(F.lit(1.0), F.lit(float(most)) / F.greatest(F.lit(1), total))
    return frame.filter(F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) < share * 1_000_000))


def label_sample(labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """(doc_id, toxic, quality) of about `most` labelled documents at most."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"), F.min("quality").alias("quality"))
    usable = keep(usable)
    return keep(_sampled(usable, most, usable.select(F.count(F.lit(1))).scalar()))


def learn_insults(texts: DataFrame, sample: DataFrame) -> dict[str, float]:
    """Terms of toxic documents, the strongest `INSULTS` at most, with the logarithms of their odds."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = Counter(), Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[toxic].update(terms_of(_words(text)) | {"."})
            terms = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array([seen[1][t] for t in terms], pa.int64()), pa.array([seen[0][t] for t in terms], pa.int64())],
                names=["term", "toxic", "other"])

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = []
            for text in batch.column(0).to_pylist():
                words = text.split()
                least.append(min(map(xxhash.xxh32_intdigest, map(" ".join, zip(words, words[1:], words[2:]))), default=-1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())], names=["text", "toxic", "least"])

    # The sample is bounded by LABELLED. Of copies and most near copies one counts.
    labelled = texts.join(F.broadcast(sample), "doc_id").select("text", "toxic")
    labelled = labelled.mapInArrow(sketched, "text string, toxic int, least bigint").groupBy("least").agg(
        F.min(F.struct("text", "toxic")).alias("one")).select("one.*")
    counts = keep(labelled.mapInArrow(rows, "term string, toxic bigint, other bigint").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    total = counts.filter("term = '.'").first()
    if total is None:
        return {}
    odds = (F.col("toxic") / (total["toxic"] + 1)) / ((F.col("other") + 0.5) / (total["other"] + 1))
    strong = counts.filter((F.col("toxic") >= max(LEAST_SEEN, LEAST_SHARE * total["toxic"])) & (odds >= ODDS) & (F.col("term") != "."))
    return {r.term: math.log(r.odds) for r in strong.select("term", odds.alias("odds")).orderBy(F.desc("odds"), "term").limit(INSULTS).collect()}


def voted(texts: DataFrame, insults: dict[str, float]) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [votes(text, _words(text), insults) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "votes"])

    return texts.mapInArrow(rows, "doc_id bigint, votes string")


def estimate(counts: dict[str, int], labelled: bool = False, rounds: int = ROUNDS) -> dict[str, float]:
    """The probability of each pattern of votes to be a bad document's.

    Documents are good, toxic or junk: what is bad about the latter two has little in common, and
    votes are taken to be independent within a kind only. A pattern starts as what its last vote
    against it says, as good where there is none. Where the last vote is a label, patterns without
    one together weigh `UNLABELLED` times as much as those with one: they say little about how
    often a labeller is wrong.
    """
    patterns = sorted(counts)
    if not patterns:
        return {}
    weight = np.array([counts[p] for p in patterns], float)
    known = np.array([labelled and p[-1] != NOTHING for p in patterns])
    if known.any() and not known.all():
        weight[~known] *= min(1.0, UNLABELLED * weight[known].sum() / weight[~known].sum())
    letters = GOOD + NOTHING + TOXIC + BAD
    cast = np.array([[letters.index(v) for v in p] for p in patterns])
    kind = np.where((cast == 2).any(1), 1, np.where((cast == 3).any(1), 2, 0))
    belongs = np.where(kind[:, None] == np.arange(3), 0.96, 0.02)
    for _ in range(rounds):
        mass = weight[:, None] * belongs
        odds = np.tile(np.log((mass.sum(0) + 1) / (weight.sum() + 3)), (len(patterns), 1))
        for votes_of in cast.T:
            given = np.stack([np.bincount(votes_of, m, 4) for m in mass.T], 1) + 0.01
            odds += np.log(given / given.sum(0))[votes_of]
        belongs = np.exp(odds - odds.max(1, keepdims=True))
        belongs /= belongs.sum(1, keepdims=True)
    return dict(zip(patterns, (1 - belongs[:, 0]).tolist()))


def train(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Weights of a logistic scorer by adaptive gradient steps over batches, in the given order."""
    width = SLOTS + 4 * len(LABELLERS)
    weights, squares = np.zeros(width), np.full(width, 1e-8)
    for _ in range(EPOCHS):
        for start in range(0, len(rows), BATCH):
            part = rows[start:start + BATCH]
            sizes = np.array([len(r) for r in part])
            index, doc = np.concatenate(part), np.repeat(np.arange(len(part)), sizes)
            scale = scales(index, sizes)
            margin = np.bincount(doc, weights[index] * scale, len(part))
            slope = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[start:start + BATCH]
            touched, at = np.unique(index, return_inverse=True)
            step = np.bincount(at, slope[doc] * scale) + DECAY * weights[touched]
            squares[touched] += step * step
            weights[touched] -= RATE * step / np.sqrt(squares[touched])
    return weights


def classified(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, keep, score (the probability to be bad), votes and their posterior."""
    texts = id_and_text(docs, id_col, text_col)
    sample = label_sample(labels)
    insults = learn_insults(texts, sample)
    cast = keep(voted(texts, insults))
    # The sample is bounded by LABELLED.
    label = F.when(F.col("toxic") == 1, TOXIC).when(F.col("quality") == 0, BAD).when(F.col("quality") == 1, GOOD).otherwise(NOTHING)
    patterns = cast.join(F.broadcast(sample), "doc_id", "left").select(F.concat("votes", label).alias("votes"))
    counts = {r.votes: r.n for r in patterns.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad = estimate(counts, labelled=True)
    # What a pattern says where no label is known.
    known = estimate_without_label(counts, bad)
    weights = train(*_training_rows(texts, insults, known, sum(counts.values())))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = [], []
            for text in batch.column(1).to_pylist():
                words = _words(text)
                pattern = votes(text, words, insults)
                at = slots(pattern, words)
                found.append(pattern)
                margin = float(weights[at] @ scales(at, np.array([len(at)])))
                # Without words there is nothing to hold against a document.
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, margin)))) if text.split() else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s < 0.5 for s in scores], pa.bool_()), pa.array(scores, pa.float64()), pa.array(found, pa.string()),
                 pa.array([known.get(p, 0.5) for p in found], pa.float64())], names=["doc_id", "keep", "score", "votes", "posterior"])

    return texts.mapInArrow(rows, "doc_id bigint, keep boolean, score double, votes string, posterior double")


def estimate_without_label(counts: dict[str, int], bad: dict[str, float]) -> dict[str, float]:
    """The mean probability by the votes before the last, which is the label."""
    total, mass = Counter(), Counter()
    for pattern, count in counts.items():
        total[pattern[:-1]] += count
        mass[pattern[:-1]] += count * bad[pattern]
    return {p: mass[p] / total[p] for p in total}


def _training_rows(texts: DataFrame, insults: dict[str, float], known: dict[str, float], total: int) -> tuple[list[np.ndarray], np.ndarray]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                words = _words(text)
                pattern = votes(text, words, insults)
                out.append((slots(pattern, words).tobytes(), known.get(pattern, 0.5)))
            index, label = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(index, pa.binary()), pa.array(label, pa.float64())], names=["doc_id", "index", "label"])

    # Bounded by TRAINED.
    sample = _sampled(texts, TRAINED, F.lit(total)).mapInArrow(rows, "doc_id bigint, index binary, label double")
    table = sample.orderBy(F.xxhash64("doc_id"), "index").select("index", "label").toArrow()
    return [np.frombuffer(b, np.int32) for b in table.column(0).to_pylist()], np.array(table.column(1).to_pylist(), float)


def without_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are kept, with all their columns. Rows of one id are rejected together."""
    rejected = keep(classified(docs, labels, id_col, text_col).filter("NOT keep").select(F.col("doc_id").alias("__id")).distinct())
    return docs.join(small_side(rejected), F.col(id_col).eqNullSafe(F.col("__id")), "left_anti")
