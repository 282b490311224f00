"""Byte-pair encoding and decoding with a given vocabulary of merges with word ends.

A word is held as the row of its parts and, beside it, the row of the ranks of adjacent parts. The
smallest rank is looked up again and again; its boundary is deleted and the ranks on both sides are
refreshed. All new words of a batch that have the same number of bytes are rows of one contiguous
array, and as every merge shortens a row by one, the array stays rectangular. That is a scan per
merge, which is the fastest way for the short words of a text; a word of over `SHORT` bytes takes
its merges from a heap instead, with the same result.

Texts are split and normalised as the vocabulary file says: special tokens first, on the raw text,
then NFC, white space, lower case, and the word pattern. Every task remembers about `REMEMBERED`
words that it has encoded.

Null and empty texts give no ids and an empty decoded text. Repeated rows give repeated results,
other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from platterflow.llm.common import id_and_text
from platterflow.llm.words import ALL_SPACES, Splitter

SHORT = 64
REMEMBERED = 400_000
# The word pattern of the vocabulary.
WORDS = "[{L}]+|'(?:s|t|re|ve|m|ll|d)|[{N}]|[^{S}{L}{N}]+"
NO_RANK = 1 << 30


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Ids, merges and special tokens of a vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.end: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        self.letters = byte_letters()
        self.split = Splitter(WORDS)
        self.spaces = re.compile(f"[{ALL_SPACES}]+")
        self.shown = [str(i) for i in range(max(self.tokens) + 1)]
        # Of every known stretch without white space: its ids and its tokens, joined by spaces.
        self.known: dict[str, tuple[str, str]] = {}
        # The merges by rank, and their pairs of ids as sorted keys.
        pairs = np.array([(self.ids[a], self.ids[b]) for a, b in self.ranks], np.int64).reshape(-1, 2)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        self.rank_of_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of_key]
        self.merged = np.array([self.ids[a + b] for a, b in self.ranks], np.int64)
        self.inner = np.array([self.ids[c] for c in self.letters], np.int64)
        self.final = np.array([self.ids[c + self.end] for c in self.letters], np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.rank_of_key[at], NO_RANK)

    def _merge_rows(self, words: list[str], coded: list[bytes]) -> None:
        """Encodes words of the same number of bytes."""
        letters = np.frombuffer(b"".join(coded), np.uint8).reshape(len(words), -1)
        parts = self.inner[letters]
        parts[:, -1] = self.final[letters[:, -1]]
        ranks, names = self._ranks(parts[:, :-1], parts[:, 1:]), np.arange(len(words))
        while len(names):
            if parts.shape[1] > 1:
                at = ranks.argmin(1)
                least = ranks[np.arange(len(names)), at]
                merging = least < NO_RANK
            else:
                merging = np.zeros(len(names), bool)
            done = ~merging
            for name, row in zip(names[done].tolist(), parts[done].tolist()):
                self.known[words[name]] = (" ".join([self.shown[i] for i in row]), " ".join([self.tokens[i] for i in row]))
            if not merging.any():
                break
            names, parts, ranks, at, least = (x[merging] for x in (names, parts, ranks, at, least))
            rows, width = np.arange(len(names)), parts.shape[1]
            parts[rows, at] = self.merged[least]
            columns = np.arange(width)
            parts = parts[columns != at[:, None] + 1].reshape(len(rows), width - 1)
            ranks = ranks[columns[:-1] != at[:, None]].reshape(len(rows), width - 2)
            for side in (at - 1, at):
                there = (side >= 0) & (side < width - 2)
                row, col = rows[there], side[there]
                ranks[row, col] = self._ranks(parts[row, col], parts[row, col + 1])

    def _merge_long(self, parts: list[str]) -> list[str]:
        """Encodes one word, in n log n steps."""
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        last, held = len(parts), list(parts)
        queue = [(self.ranks[p], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in self.ranks]
        heapq.heapify(queue)
        while queue:
            _, at, left, right = heapq.heappop(queue)
            follower = after[at]
            if held[at] != left or follower == last or held[follower] != right:
                continue
            held[at], held[follower], after[at] = left + right, "", after[follower]
            if after[at] != last:
                before[after[at]] = at
            for i in (before[at], at):
                if i >= 0 and after[i] != last:
                    pair = held[i], held[after[i]]
                    if pair in self.ranks:
                        heapq.heappush(queue, (self.ranks[pair], i, *pair))
        return [part for part in held if part]

    def learn(self, stretches: Iterable[str]) -> None:
        """Encodes the stretches that are not known yet, all together."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = set(stretches).difference(self.known)
        mixed = {s: self.split(s) for s in new if not s.isalpha()}
        words = {s for s in new if s not in mixed}.union(*mixed.values()).difference(self.known)
        by_length: dict[int, tuple[list[str], list[bytes]]] = defaultdict(lambda: ([], []))
        for word in words:
            coded = word.encode()
            if len(coded) > SHORT:
                parts = [self.letters[b] for b in coded]
                parts[-1] += self.end
                parts = self._merge_long(parts)
                self.known[word] = (" ".join([self.shown[self.ids[p]] for p in parts]), " ".join(parts))
            else:
                held = by_length[len(coded)]
                held[0].append(word)
                held[1].append(coded)
        for held in by_length.values():
            self._merge_rows(*held)
        for stretch, pieces in mixed.items():
            ids, tokens = zip(*map(self.known.__getitem__, pieces))
            self.known[stretch] = (" ".join(ids), " ".join(tokens))

    def stretched(self, text: str) -> list[str]:
        """The normalised text without its white space, which no word crosses."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # Lower case letter by letter: a final sigma is like any other.
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to str.split alone
            return [s for s in self.spaces.split(text) if s]
        return text.split()

    def encode_words(self, texts: list[str]) -> Iterator[list[tuple[str, str]]]:
        """Per text, of every stretch and special token: its ids and its tokens, joined by spaces."""
        cut = [self.cut.split(text) if "<" in text else [text] for text in texts]
        split = [[[s] if at % 2 else self.stretched(s) for at, s in enumerate(segments)] for segments in cut]
        self.learn(s for segments in split for segment in segments[::2] for s in segment)
        for segments in split:
            found: list[tuple[str, str]] = []
            for at, segment in enumerate(segments):
                if at % 2:
                    found.append((self.shown[self.special[segment[0]]], segment[0]))
                else:
                    found += map(self.known.__getitem__, segment)
            yield found

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [[int(i) for ids, _ in found for i in ids.split()] for found in self.encode_words(texts)]

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by a space: the vocabulary file names no decoder."""
        return " ".join(self.tokens[i] for i in ids)


@cache
def vocabulary(path: str) -> Vocabulary:
    """Read once by every Python worker."""
    return Vocabulary(path)


def round_trips(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, and digests of the ids and of the text decoded from them."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            counts, coded, decoded = [], [], []
            for found in words.encode_words(batch.column(1).to_pylist()):
                ids, back = map(" ".join, zip(*found)) if found else ("", "")
                counts.append(ids.count(" ") + bool(ids))
                coded.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded.append(hashlib.sha256(back.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        rows, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id and the array of its ids."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            ids = words.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(rows, "doc_id bigint, ids array<int>")


def decoded(coded: DataFrame, path: str) -> DataFrame:
    """The text decoded from the `ids` of each row."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            texts = [words.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(rows, "doc_id bigint, text string")
