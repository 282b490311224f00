"""Packing documents into token sequences by the sum-of-squares rule.

A document is its ids and one end id. What fills whole sequences is cut off its front, so that one
piece shorter than a sequence remains. These pieces are dealt over many packers. A packer places
each piece, in turn, into a partly filled window, or a new one, so that the sum of the squared
counts of windows at each fill level becomes least; all it knows of the windows is an array of
counts by level. Windows that a packer leaves with more than `SLACK` tokens free give their pieces
back. The pieces given back by all packers are packed once more, by fewer packers and each cut in
two: the larger part a multiple of `GRAIN` tokens, of which few sizes exist, the rest small enough
to fill what is left. So most documents stay in one piece, and there is little padding.

The number of packers follows the number of pieces, so a packer's work and memory are bounded and
the windows it leaves open are few beside those it fills. The ids themselves never leave the task
that made them: their checksum is taken there.

Null and empty texts are documents of one token, the end id. Repeated rows are documents of their
own. The result does not depend on other columns. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from platterflow.llm.bpe import byte_letters
from platterflow.llm.common import id_and_text
from platterflow.llm.words import BEYOND, LETTERS, NUMBERS, SPACES, Remembered, Splitter
from platterflow.session import keep

WINDOW = 2048
END_ID = 1
# Pieces that one packer places, about; windows with more free tokens are given back once.
PIECES_PER_PACKER = 4096
SLACK = 8
GRAIN = 256
REMEMBERED = 150_000
# Words and gaps that go piece by piece.
LONG_WORD, LONG_GAP = 256, 64
# The pattern that splits text before byte-level merges.
PATTERN = " ?[{L}]+| ?[{N}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, front_crc32 bigint, rest_crc32 bigint"
SLOTS = f"{PIECE}, packer bigint, window bigint, offset bigint, fill bigint"


class IdBytes:
    """The ids of a text as little-endian 32-bit numbers, by the tokenizer of a file.

    Special tokens are found first, as the tokenizer does. A text of characters up to U+017F without very long words is encoded
    as a whole from the file's vocabulary as ranks, which gives the same ids if they follow the merges, as is checked. For other
    texts, each piece that the tokenizer's pattern makes, which no merge crosses, is encoded by the tokenizer and remembered.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: array("I", [i]).tobytes() for i, t in special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        self.split = Splitter(PATTERN)
        self.pieces = Remembered(self._encode, REMEMBERED)
        self.ranks = self._as_ranks(path)
        self.gap = re.compile(f"[{SPACES}]{{{LONG_GAP}}}")

    @staticmethod
    def _as_ranks(path: str) -> tiktoken.Encoding | None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = {letter: byte for byte, letter in enumerate(byte_letters())}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        vocabulary = [*(letter for letter in letters), *(a + b for a, b in merges)]
        ids = [model["vocab"].get(token) for token in vocabulary]
        if sorted(ids[:256]) != list(range(256)) or ids[256:] != list(range(256, len(ids))):
            return None
        ranks = {bytes(letters[c] for c in token): i for token, i in zip(vocabulary, ids)}
        pattern = PATTERN.replace("{L}", LETTERS).replace("{N}", NUMBERS).replace("{S}", SPACES)
        return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _encode(self, piece: str) -> bytes:
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def _plain(self, text: str) -> bool:
        return (self.ranks is not None and not BEYOND.search(text) and max(map(len, text.split()), default=0) < LONG_WORD
                and not self.gap.search(text))

    def __call__(self, text: str) -> bytes:
        found: list[bytes] = []
        segments = self.cut.split(text) if "<" in text else [text]
        for at, segment in enumerate(segments):
            if at % 2:
                found.append(self.special[segment])
            elif self._plain(segment):
                found.append(self.ranks.encode_to_numpy(segment, disallowed_special=()).astype("<u4").tobytes())
            else:
                found += map(self.pieces.__getitem__, self.split(segment))
        return b"".join(found)


@cache
def id_bytes(path: str) -> IdBytes:
    """Read once by every Python worker."""
    return IdBytes(path)


def pieces(docs: DataFrame, path: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of at most `window` tokens; only the last of a document may be shorter.

    A shorter piece comes with the checksums of its two parts, if it should be cut before the last `length % GRAIN` tokens.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = id_bytes(path), array("I", [END_ID]).tobytes()
        for batch in batches:
            out: list[tuple[int, ...]] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text) + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[start * 4:(start + window) * 4]
                    if len(part) == 4 * window:  # is a sequence, and never cut
                        out.append((doc, start, window, zlib.crc32(part), total, 0, 0))
                        continue
                    cut = len(part) - len(part) % (4 * GRAIN)
                    front = zlib.crc32(part[:cut])
                    out.append((doc, start, len(part) // 4, zlib.crc32(part[cut:], front), total, front, zlib.crc32(part[cut:])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "front_crc32", "rest_crc32"])

    return id_and_text(docs, id_col, text_col).mapInArrow(rows, PIECE)


def place(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int], list[int]]:
    """Window and offset of each length in turn, by the sum of squares, and the fill of the windows.

    `counts[h]` is the number of windows filled to level h. A length s moves a window from h to
    h + s, which changes the sum of squares by 2 (counts[h + s] - counts[h] + 1); a new window
    starts from no count, and a full one leaves the sum. Of equal changes the fullest window wins.
    """
    counts = np.zeros(window + 1, np.int64)
    open_at: dict[int, list[int]] = {}
    fills: list[int] = []
    where, offsets = [], []
    for size in lengths:
        best, level = (2 * int(counts[size]) + 1 if size < window else 0), 0
        if size < window:
            before = counts[1:window - size + 1]
            change = 2 * (counts[1 + size:window + 1] - before) + 2
            change[-1] -= 2 * int(counts[window]) + 1  # a full window counts for nothing
            change = np.where(before > 0, change, np.iinfo(np.int64).max)
            at = len(change) - 1 - int(change[::-1].argmin())
            if change[at] <= best:
                level = at + 1
        if level:
            held = open_at[level]
            slot = held.pop()
            counts[level] -= 1
        else:
            slot = len(fills)
            fills.append(0)
        where.append(slot)
        offsets.append(level)
        fills[slot] = level + size
        if fills[slot] < window:
            counts[fills[slot]] += 1
            open_at.setdefault(fills[slot], []).append(slot)
    return where, offsets, fills


def _placed(loose: DataFrame, window: int, per_packer: int) -> DataFrame:
    """Deals pieces over packers and lets each place its own."""
    def rows(frame: pd.DataFrame) -> pd.DataFrame:
        # Mixed by checksum: an order by id could follow the lengths.
        frame = frame.sort_values(["ids_crc32", "doc_id", "start", "length", "doc_tokens"], kind="stable")
        where, offsets, fills = place(frame["length"].tolist(), window)
        return frame.assign(window=where, offset=offsets, fill=np.array(fills, np.int64)[where])

    packers = F.greatest(F.lit(1), F.ceil(loose.select(F.count(F.lit(1))).scalar() / per_packer))
    # The place of a row in the stored table, so that equal rows, however many, are dealt over all packers.
    key = F.xxhash64("doc_id", "start", "length", "ids_crc32", F.monotonically_increasing_id())
    return loose.withColumn("packer", F.pmod(key, packers).cast("bigint")).groupBy("packer").applyInPandas(rows, SLOTS)


def _in_two(loose: DataFrame) -> DataFrame:
    front = F.col("length") - F.col("length") % GRAIN
    rest = F.col("length") % GRAIN
    same = [F.col("doc_tokens"), F.lit(0).cast("bigint").alias("front_crc32"), F.lit(0).cast("bigint").alias("rest_crc32")]
    parts = F.array(
        F.struct(F.col("start"), front.alias("length"), F.col("front_crc32").alias("ids_crc32")),
        F.struct((F.col("start") + front).alias("start"), rest.alias("length"), F.col("rest_crc32").alias("ids_crc32")))
    return loose.select("doc_id", F.explode(F.filter(parts, lambda p: p["length"] > 0)).alias("p"), *same).select(
        "doc_id", "p.start", "p.length", "p.ids_crc32", "doc_tokens", "front_crc32", "rest_crc32")


def packed(docs: DataFrame, path: str, window: int = WINDOW, per_packer: int = PIECES_PER_PACKER,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: where it lies in its document, its checksum, its sequence and its offset there.

    A sequence id is the number of its packer and its window: unique, not gapless.
    """
    made = keep(pieces(docs, path, window, id_col, text_col))
    loose = made.filter(F.col("length") < window)
    first = keep(_placed(loose, window, per_packer))
    power_of_two = F.col("fill").bitwiseAND(F.col("fill") - 1) == 0
    good = (F.col("fill") >= window - SLACK) | power_of_two
    last = _placed(_in_two(first.filter(~good)), window, per_packer)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def sequence(kind: int):
        return (F.lit(kind << 60) + F.shiftleft("packer", 24) + F.col("window")).alias("sequence_id")

    full = made.filter(F.col("length") == window).select(
        *columns, (F.lit(2 << 60) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return full.unionByName(first.filter(good).select(*columns, sequence(0), "offset")).unionByName(
        last.select(*columns, sequence(1), "offset"))
