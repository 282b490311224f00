"""Language-model scores: a word unigram model, and causal self-attention over subword ids.

Both learn from the documents whose crc32 of the id, as text, modulo 10 is not 0; the others are held
out. All texts are scored, whole. Texts are lower-cased (A-Z) and split at ASCII white space.

The base model counts words over all training documents. The counts of the `COMMON` most frequent
words go to every task, those of all other words are joined to the words of the documents.

The attention model reads the subword ids of the words, each word with the space before it. Ids are
grouped in `CLASSES` classes, the most frequent ids in classes of their own. To the logarithms of
the class counts after each id, taken over all training documents, it adds the output of causal
self-attention over the ids before, weighted by content and distance. Texts are cut into windows of
`CONTEXT + STRIDE` ids that overlap by `CONTEXT`; each window scores its last `STRIDE` ids, so each id
is scored once, with the ids before it in its window as context and later ones masked.

A word's probability is that of the class of its first id, given that a word begins, times a mixture,
`KNOWN` parts of the word's smoothed share of its class by count and the rest the probability of its
ids, id by id, and of the next word to begin behind them.

All is learnt from all training documents: counts, the ids' classes, and the attention weights. Their
training begins on a sample, at most about `SAMPLE` training documents and `PER_TEXT` windows, evenly
spaced, of each. From there each task goes once over every window of its training documents, and the
weights are the means of what the tasks come to, by their windows. So the weights, and the last digits
of the scores, depend on how the documents are dealt over tasks.

Null and empty texts consist of the end token alone. A null id counts as held out. Rows are scored one
by one, repeated ones alike; other columns are not read. An empty table gives no rows; without any
training document all counts are zero.
"""

from __future__ import annotations

import base64
import copy
import math
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterflow.llm.common import id_and_text
from platterflow.session import keep

FOLDS = 10
ADDED = 0.1
COMMON = 50_000
SAMPLE, PER_TEXT = 3_000, 64
KNOWN = 0.9
CLASSES, SINGLE = 64, 48
ROWS = 2048
KEY, VALUE = 8, 16
CONTEXT, STRIDE = 8, 24
WINDOW = CONTEXT + STRIDE
BATCH = 256
STEPS, RATE = 500, 0.01
# Of the pass over all windows, of which so many are mixed at a time.
PASS_RATE, MIXED = 0.001, 16_384
HELD_WORDS = 300_000
PAD, START = -1, -2


class Subwords:
    """Ids of texts, by a file of ranks and the pattern that goes with it."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.end = len(ranks)
        self.tokens = sorted(ranks, key=ranks.__getitem__)
        self.begins = np.array([token[:1] == b" " for token in self.tokens] + [True])

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """The ids of a text and the end id. No id crosses words: the pattern keeps a space and what follows together."""
        return np.append(self._ids(words), np.uint16(self.end))

    def _ids(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.empty(0, np.uint16)
        text = " " + b" ".join(words).decode()
        return self.encoding.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype(np.uint16)

    def apart(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word on its own, as bytes."""
        ids = self._ids(words)
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(words):  # white space other than ASCII's, at the ends of two words
            return [self._ids([w]).tobytes() for w in words]
        raw, edges = ids.tobytes(), (2 * np.r_[starts, len(ids)]).tolist()
        return [raw[a:b] for a, b in zip(edges, edges[1:])]

    def word(self, ids: np.ndarray) -> str:
        return b"".join([self.tokens[i] for i in ids.tolist()])[1:].decode()


@cache
def subwords(path: str, pattern: str) -> Subwords:
    """Read once by every Python worker."""
    return Subwords(path, pattern)


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()  # of bytes: both know ASCII only


class Groups:
    """Class and row of every id, by their counts. Row 0 stands for the start.

    A class holds either ids that begin a word (and the end id) or ids that go on with one.
    """

    def __init__(self, counts: np.ndarray, begins: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        self.of_id = np.zeros(len(counts), np.int64)
        self.of_id[order[:SINGLE]] = np.arange(SINGLE)
        blocks = (CLASSES - SINGLE) // 2
        self.begins = np.r_[begins[order[:SINGLE]], np.repeat([True, False], blocks)]
        for side, first in ((True, SINGLE), (False, SINGLE + blocks)):
            rest = order[SINGLE:][begins[order[SINGLE:]] == side]
            share = np.cumsum(counts[rest] + 1e-3)
            self.of_id[rest] = first + np.minimum(blocks - 1, (share / share[-1:] * blocks).astype(int))
        self.row = 1 + ROWS + self.of_id
        self.row[order[:ROWS]] = 1 + np.arange(min(ROWS, len(order)))
        self.rows = 1 + ROWS + CLASSES


def windows(ids: np.ndarray) -> np.ndarray:
    """Windows over a text: what is read and, one place ahead, what is to come; `START` begins the text."""
    count = -(-len(ids) // STRIDE)
    padded = np.full(CONTEXT + count * STRIDE + 1, PAD, np.int64)
    padded[CONTEXT] = START
    padded[CONTEXT + 1:CONTEXT + 1 + len(ids)] = ids
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW + 1)[::STRIDE]


def split_windows(cut: np.ndarray, groups: Groups) -> tuple[np.ndarray, np.ndarray]:
    """The rows that windows read, and the classes to come at the scored places; PAD where nothing is."""
    read, coming = cut[:, :-1], cut[:, CONTEXT + 1:]
    rows = np.where(read == START, 0, groups.row[np.maximum(read, 0)])
    return np.where(read == PAD, PAD, rows), np.where(coming < 0, PAD, groups.of_id[np.maximum(coming, 0)])


class Attention:
    """Log-odds of the classes to come. `base` holds their log-counts after each row."""

    def __init__(self, base: np.ndarray, seed: int = 7):
        random = np.random.default_rng(seed)

        def some(*shape: int) -> np.ndarray:
            return random.normal(0, 0.2, shape).astype(np.float32)
        rows, classes = base.shape
        self.base = base.astype(np.float32)
        self.weights = {"query": some(rows, KEY), "key": some(rows, KEY), "value": some(rows, VALUE),
                        "far": np.zeros(WINDOW, np.float32), "out": some(VALUE, classes) * 0.1}
        ahead = np.arange(WINDOW)[None, :] - np.arange(CONTEXT, WINDOW)[:, None]
        self.distance = np.maximum(0, -ahead)
        self.masked = np.where(ahead > 0, np.float32(-1e4), np.float32(0))

    def forward(self, read: np.ndarray) -> tuple[np.ndarray, ...]:
        w, at = self.weights, np.maximum(read, 0)
        now = at[:, CONTEXT:]
        query, key, value = w["query"].take(now, 0), w["key"].take(at, 0), w["value"].take(at, 0)
        score = query @ key.transpose(0, 2, 1)
        score += w["far"][self.distance] + self.masked
        np.minimum(score, 60, out=score)
        np.exp(score, out=score)
        # Padding on the left is only in the first window of a text; on the right later ones are masked.
        score[read[:, 0] < 0, :, :CONTEXT] = 0
        total = (score @ np.ones(WINDOW, score.dtype))[:, :, None]
        mixed = score @ value
        mixed /= total
        logits = mixed.reshape(-1, VALUE) @ w["out"]
        logits += self.base.take(now.ravel(), 0)
        return query, key, value, score, total, mixed, logits

    def log_likelihood(self, read: np.ndarray, wanted: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per window and place: the natural logarithm of the probability of the class to come, and
        of all classes that begin a word together."""
        logits = self.forward(read)[-1]
        chosen = logits[np.arange(len(logits)), np.maximum(wanted.ravel(), 0)]
        np.exp(logits, out=logits)  # of logarithms of shares and a small term: no overflow
        sums = np.log(logits @ np.stack([np.ones_like(begins), begins], 1).astype(np.float32) + np.float32(1e-30))
        return (chosen - sums[:, 0]).reshape(wanted.shape), (sums[:, 1] - sums[:, 0]).reshape(wanted.shape)

    def gradients(self, read: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
        w, at = self.weights, np.maximum(read, 0)
        query, key, value, share, total, mixed, logits = self.forward(read)
        share /= total
        there = np.flatnonzero(wanted.ravel() >= 0)
        each = np.zeros(len(logits), logits.dtype)
        each[there] = 1 / max(1, len(there))
        np.clip(logits, -60, 60, out=logits)
        slope = np.exp(logits, out=logits)
        slope *= (each / (slope @ np.ones(slope.shape[1], slope.dtype)))[:, None]
        slope[there, wanted.ravel()[there]] -= each[there]
        d_mixed = (slope @ w["out"].T).reshape(mixed.shape)
        d_score = d_mixed @ value.transpose(0, 2, 1)
        # The mean of the slopes by the shares is that of the mixture.
        d_score -= np.einsum("ijk,ijk->ij", d_mixed, mixed)[:, :, None]
        d_score *= share
        grads = {"out": mixed.reshape(-1, VALUE).T @ slope,
                 "far": np.bincount(self.distance.ravel(), d_score.sum(0).ravel(), WINDOW).astype(np.float32)}
        slopes = {"value": share.transpose(0, 2, 1) @ d_mixed, "key": d_score.transpose(0, 2, 1) @ query, "query": np.zeros_like(key)}
        slopes["query"][:, CONTEXT:] = d_score @ key
        # The slopes of a row are summed in one run.
        flat = at.ravel().astype(np.uint16)
        order = np.argsort(flat, kind="stable")
        sorted_rows = flat[order]
        begins = np.flatnonzero(np.r_[True, sorted_rows[1:] != sorted_rows[:-1]])
        together = np.concatenate(list(slopes.values()), 2).reshape(len(flat), -1).take(order, 0)
        sums = np.add.reduceat(together, begins)
        for name, part in zip(slopes, np.split(sums, np.cumsum([x.shape[2] for x in slopes.values()])[:-1], 1)):
            grads[name] = np.zeros_like(w[name])
            grads[name][sorted_rows[begins]] = part
        return grads

    def train(self, read: np.ndarray, wanted: np.ndarray, steps: int = STEPS, seed: int = 11) -> None:
        """Adaptive-moment steps over random batches of windows."""
        random, moments = np.random.default_rng(seed), Moments(self)
        for step in range(1, steps + 1 if len(read) else 1):
            pick = random.integers(0, len(read), BATCH)
            moments.step(read[pick], wanted[pick], RATE * min(1.0, 4 * (1 - step / (steps + 1))))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.weights.values()])

    def take(self, flat: np.ndarray) -> None:
        """Weights as `flat` gives them."""
        for name, x in self.weights.items():
            self.weights[name], flat = flat[:x.size].reshape(x.shape).astype(np.float32), flat[x.size:]


class Moments:
    """Adaptive-moment steps of the weights of a model."""

    def __init__(self, model: Attention):
        self.model, self.done = model, 0
        self.first, self.second = ({n: np.zeros_like(x) for n, x in model.weights.items()} for _ in range(2))

    def step(self, read: np.ndarray, wanted: np.ndarray, rate: float) -> None:
        self.done += 1
        for name, grad in self.model.gradients(read, wanted).items():
            first, second = self.first[name], self.second[name]
            first *= 0.9
            first += 0.1 * grad
            second *= 0.99
            grad *= 0.1 * grad
            grad *= 0.1
            second += grad
            scale = np.sqrt(second, out=grad)
            scale *= (1 - 0.99 ** self.done) ** -0.5
            scale += 1e-8
            scaled = np.divide(first, scale, out=scale)
            scaled *= rate / (1 - 0.9 ** self.done)
            self.model.weights[name] -= scaled


class Model:
    """All that scoring needs: small tables, whatever the size of the corpus."""

    def __init__(self, groups: Groups, after: np.ndarray, id_counts: np.ndarray, class_words: np.ndarray, begins: np.ndarray):
        uniform = (after.sum(0) + ADDED) / (after.sum() + ADDED * CLASSES)
        self.groups, self.begins, self.end = groups, begins, len(begins) - 1
        self.attention = Attention(np.log((after + 5 * uniform) / (after.sum(1, keepdims=True) + 5)))
        size = np.bincount(groups.of_id, minlength=CLASSES)
        total = np.bincount(groups.of_id, id_counts, CLASSES)
        self.inner = (np.log10(id_counts + ADDED) - np.log10(total + ADDED * size)[groups.of_id]).astype(np.float32)
        # Of a class: the words whose first id is in it, all and distinct.
        self.class_size = class_words[:, 0] + ADDED * (class_words[:, 1] + 1)

    def words(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word of some texts, one after the other: where it begins in all their ids, and the logarithms of its class and of
        its ids; its class."""
        read, coming = split_windows(np.concatenate([windows(ids) for ids in texts]), self.groups)
        parts = [self.attention.log_likelihood(read[i:i + BATCH], coming[i:i + BATCH], self.groups.begins) for i in range(0, len(read), BATCH)]
        there = coming >= 0
        chosen, begun = (np.concatenate(side)[there] / math.log(10) for side in zip(*parts))
        ids = np.concatenate(texts)
        starts = np.flatnonzero(self.begins[ids])
        first = chosen[starts] - begun[starts]
        behind = np.where(ids[starts] == self.end, 0, np.r_[begun[starts][1:], 0])
        inside = np.add.reduceat(chosen + self.inner[ids], starts) - chosen[starts] + behind
        return starts, first, inside, self.groups.of_id[ids[starts]]

    def mixed(self, count, size, inside):
        return np.log10(KNOWN * (count + ADDED) / size + (1 - KNOWN) * 10.0 ** np.maximum(inside, -300))


def _sample(training: DataFrame, path: str, pattern: str) -> np.ndarray:
    """Windows of ids of a sample of the training documents; at most SAMPLE * PER_TEXT, about."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = subwords(path, pattern)
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                cut = windows(encode(words_of(text)))
                out.append(cut[np.unique(np.linspace(0, len(cut) - 1, PER_TEXT).astype(int))].astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["windows"])

    share = F.least(F.lit(1.0), F.lit(float(SAMPLE)) / F.greatest(F.lit(1), training.select(F.count(F.lit(1))).scalar()))
    chosen = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) < share * 1_000_000
    found = training.filter(chosen).select("text").mapInArrow(rows, "windows binary").toArrow()
    parts = sorted(found.column(0).to_pylist())
    return np.concatenate([np.frombuffer(p, np.int32).reshape(-1, WINDOW + 1) for p in parts]) if parts else np.empty((0, WINDOW + 1), np.int32)


def _encoded(texts: DataFrame, path: str, pattern: str) -> DataFrame:
    """The ids of each text (kind 3), and what each task has counted in training texts: words, as their ids, with the first id (0), and ids (2)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = subwords(path, pattern)
        end = np.uint16(encode.end).tobytes()
        known: dict[bytes, bytes] = {}  # the ids of words met; a word's ids do not depend on the words beside it
        seen: Counter = Counter()  # by their ids, which no two words share
        ids_seen = np.zeros(len(encode.begins), np.int64)

        def counts(kind: int, keys: list, words: list, numbers: list) -> pa.RecordBatch:
            n = len(keys)
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * n, pa.int8()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.binary()),
                 pa.array(words, pa.binary()), pa.array(keys, pa.int32()), pa.array(numbers, pa.int64())], names=NAMES)

        def words_seen() -> pa.RecordBatch:
            first = np.frombuffer(b"".join([word[:2] for word in seen]), np.uint16)
            return counts(0, first.tolist(), list(seen), list(seen.values()))

        for batch in batches:
            coded, taught = [], []
            for held, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = words_of(text)
                fresh = list(set(words).difference(known))
                if fresh:
                    known.update(zip(fresh, encode.apart(fresh)))
                own = [known[word] for word in words]
                own.append(end)
                coded.append(b"".join(own))
                if not held:
                    seen.update(own)
                    taught.append(coded[-1])
            if taught:
                ids_seen += np.bincount(np.frombuffer(b"".join(taught), np.uint16), minlength=len(ids_seen))
            n = len(coded)
            yield pa.RecordBatch.from_arrays(
                [pa.array([3] * n, pa.int8()), *batch.columns[:3], pa.array(coded, pa.binary()),
                 pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], names=NAMES)
            if len(known) > HELD_WORDS:
                known.clear()
            if len(seen) > HELD_WORDS:
                yield words_seen()
                seen.clear()
        yield words_seen()
        at = np.flatnonzero(ids_seen)
        yield counts(2, at.tolist(), [None] * len(at), ids_seen[at].tolist())

    return texts.select("row_id", "doc_id", "held_out", "text").mapInArrow(
        rows, "kind tinyint, row_id bigint, doc_id bigint, held_out boolean, ids binary, word binary, key int, n bigint")


def _taught(coded: DataFrame, groups: Groups) -> DataFrame:
    """(key, n): how often each class follows each row, over the ids of stored training texts."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after = np.zeros(groups.rows * CLASSES, np.int64)
        for batch in batches:
            texts = [np.frombuffer(b, np.uint16) for b in batch.column(0).to_pylist()]
            if not texts:
                continue
            ids = np.concatenate(texts)
            read = np.r_[0, groups.row[ids[:-1]]]
            read[np.cumsum([0, *map(len, texts[:-1])])] = 0
            after += np.bincount(read * CLASSES + groups.of_id[ids], minlength=len(after))
        at = np.flatnonzero(after)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(after[at])], names=["key", "n"])

    return coded.select("ids").mapInArrow(rows, "key int, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def _trained(coded: DataFrame, model: Attention, groups: Groups) -> None:
    """Trains a model over every window of stored training texts, from the weights it has: once in each task, then the mean."""
    size = model.flat().size

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, moments, count = copy.deepcopy(model), None, 0
        random, held, waiting = np.random.default_rng(13), [], 0

        def learn(cut: np.ndarray) -> None:
            for low in range(0, len(cut), BATCH):
                moments.step(*split_windows(cut[low:low + BATCH], groups), PASS_RATE)

        moments = Moments(own)
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                held.append(windows(np.frombuffer(ids, np.uint16)))
                waiting += len(held[-1])
                if waiting >= MIXED:
                    cut, held, waiting = np.concatenate(held), [], 0
                    count += len(cut)
                    learn(cut[random.permutation(len(cut))])
        if held:
            cut = np.concatenate(held)
            count += len(cut)
            learn(cut[random.permutation(len(cut))])
        if count:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1, dtype=np.int32)), pa.array(np.append(own.flat().astype(float), 1) * count)], names=["at", "n"])

    # As many rows as weights, whatever the number of tasks.
    summed = coded.select("ids").mapInArrow(rows, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    if len(summed):
        total = np.zeros(size + 1)
        total[summed.column(0).to_numpy()] = summed.column(1).to_numpy()
        model.take(total[:-1] / total[-1])


NAMES = ["kind", "row_id", "doc_id", "held_out", "ids", "word", "key", "n"]


def _dense(rows: list, size: int) -> np.ndarray:
    out = np.zeros(size)
    for r in rows:
        out[r.key] = r.n
    return out


def scored(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))
    texts = id_and_text(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", (F.col("doc_id").isNull() | (fold == 0)).alias("held_out"), "text")
    encode = subwords(path, pattern)
    made = keep(_encoded(texts, path, pattern))
    counts = keep(made.filter("kind < 3").groupBy("kind", "word", "key").agg(F.sum("n").alias("n")))
    words = counts.filter("kind = 0").select("word", "key", "n")
    # One row per id, per row and class: bounded by the vocabulary.
    id_counts = _dense(counts.filter("kind = 2").collect(), len(encode.begins))
    groups = Groups(id_counts, encode.begins)
    class_words = np.zeros((CLASSES, 2))
    for r in words.groupBy("key").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
        class_words[groups.of_id[r.key]] += r.n, r.words
    training = made.filter("kind = 3 AND NOT held_out")
    after = _dense(_taught(training, groups).collect(), groups.rows * CLASSES).reshape(groups.rows, CLASSES)
    model = Model(groups, after, id_counts, class_words, encode.begins)
    cut = _sample(texts.filter(~F.col("held_out")), path, pattern)
    model.attention.train(*split_windows(cut.astype(np.int64), groups))
    _trained(training, model.attention, groups)
    common = {bytes(r.word): r.n for r in words.orderBy(F.desc("n"), "word").limit(COMMON).collect()}
    common.setdefault(np.uint16(encode.end).tobytes(), int(class_words[groups.of_id[encode.end], 0] > 0 and id_counts[encode.end]))
    total, distinct = (float(x) for x in class_words.sum(0))
    all_words = math.log10(total + ADDED * (distinct + 1))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            rare_words, rare_inside, rare_size = [], [], []
            coded = [np.frombuffer(b, np.uint16) for b in batch.column(3).to_pylist()]
            for low in range(0, len(coded), 64):
                part = coded[low:low + 64]
                starts, first, inside, kinds = model.words(part)
                ids = np.concatenate(part)
                raw, edges = ids.tobytes(), (2 * np.r_[starts, len(ids)]).tolist()
                spelt = list(map(raw.__getitem__, map(slice, edges, edges[1:])))
                count = np.fromiter(map(common.get, spelt, repeat(-1)), float, len(spelt))
                here, size = count >= 0, model.class_size[kinds]
                rare = np.flatnonzero(~here)
                rare_words += [spelt[i] for i in rare.tolist()]
                rare_inside.append(inside[rare])
                rare_size.append(size[rare])
                scores, bases = first.astype(float), np.zeros(len(first))
                scores[here] += model.mixed(count[here], size[here], inside[here])
                bases[here] = np.log10(count[here] + ADDED)
                # Each text ends with a word, the end.
                begins = np.r_[0, np.flatnonzero(ids[starts] == model.end)[:-1] + 1]
                out += zip(np.diff(np.r_[begins, len(starts)]).tolist(), *(
                    np.add.reduceat(x, begins).tolist() for x in ((count > 0).astype(int), bases, scores, (~here).astype(int))))
            tokens, in_common, base, score, rare = zip(*out) if out else ((),) * 5
            flat = pa.StructArray.from_arrays(
                [pa.array(rare_words, pa.binary()), *(pa.array(np.concatenate([np.empty(0), *x]), k) for x, k in ((rare_inside, pa.float32()), (rare_size, pa.float64())))],
                fields=list(RARE))
            offsets = pa.array(np.cumsum([0, *rare]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(tokens, pa.int64()), pa.array(in_common, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64()),
                 pa.ListArray.from_arrays(offsets, flat)],
                names=["row_id", "doc_id", "held_out", "n_tokens", "known", "base", "part", "rare"])

    parts = keep(made.filter("kind = 3").select("row_id", "doc_id", "held_out", "ids").mapInArrow(
        rows, "row_id bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, part double, "
              "rare array<struct<word binary, inside float, size double>>"))
    rare = parts.select("row_id", F.explode("rare").alias("r")).select("row_id", "r.*").join(words.select("word", "n"), "word", "left")
    count = F.coalesce(F.col("n"), F.lit(0))
    mixed = F.log10(KNOWN * (count + ADDED) / F.col("size") + (1 - KNOWN) * F.pow(F.lit(10.0), F.greatest(F.col("inside").cast("double"), F.lit(-300.0))))
    sums = rare.groupBy("row_id").agg(
        F.sum(F.log10(count + ADDED)).alias("base_rare"), F.sum(mixed).alias("part_rare"), F.sum((count > 0).cast("bigint")).alias("known_rare"))
    nothing = F.lit(0)
    return parts.drop("rare").join(sums, "row_id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("known_rare", nothing)).alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_rare", nothing) - F.col("n_tokens") * all_words).alias("base_score"),
        (F.col("part") + F.coalesce("part_rare", nothing)).alias("score"))


RARE = pa.struct([("word", pa.binary()), ("inside", pa.float32()), ("size", pa.float64())])
