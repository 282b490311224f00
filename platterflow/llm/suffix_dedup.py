"""Exact repeated passages by a sparse suffix array.

Of each document only the suffixes at minimiser positions are retained: places chosen by the content
around them, so that two documents that share `LEAST_WORDS` words retain a suffix at the same word of
the shared passage. A suffix whose first `COMPARED` words occur once in the corpus cannot lie in a
repeated passage at that place and is left out. The others are sorted over all tasks by the words that
follow, and each is compared with its neighbours, the nearest of other documents: the match is extended to the right and to the left, as
far as `RIGHT` and `LEFT` words, which reaches beyond the next retained suffix. The neighbour matches
furthest to the right; for the one that matches furthest to the left, suffixes that begin alike are
sorted once more, by the words before them. The matches of a document are joined, and those of at
least `LEAST_WORDS` words are repeated passages.

The order is spread by ranges of (following words, document), so a suffix that a third of all documents
share is dealt over tasks; at the edges of the ranges, the suffixes of their first and last documents are
compared in a second step. Neighbours are linear in the suffixes, whatever the size of a group.

Words are what ASCII white space separates, with A-Z in lower case. Null, empty and short texts have no
passages; of equal rows one counts; a null id comes first and is returned as null. A repetition within
one document does not count. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterflow.llm.passages import NULL_ID, merged, references, seeds, texts_of, words_of
from platterflow.session import keep

LEAST_WORDS = 50
GRAM, SAMPLED, COMPARED = 8, 25, 24
LEFT, RIGHT = 32, 64
SUFFIX = "after string, doc_id bigint, digest bigint, at int, before string"
SUFFIX_NAMES = [part.split()[0] for part in SUFFIX.split(", ")]
MATCH = "doc_id bigint, digest bigint, start int, end int, other_id bigint, edge boolean, after string, at int, before string"
MATCH_NAMES = [part.split()[0] for part in MATCH.split(", ")]


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words after each retained place, and those before it from the last to the first."""
    for batch in batches:
        for row in range(batch.num_rows):  # one document at a time: its suffixes are longer than itself
            doc, digest = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
            words = [w.decode() for w in words_of(batch.column(2)[row].as_py())]
            places = batch.column(3)[row].as_py()
            for low in range(0, len(places), 4096):
                part = places[low:low + 4096]
                after = [" ".join(words[at:at + RIGHT]) for at in part]
                before = [" ".join(words[max(0, at - LEFT):at][::-1]) for at in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(after), pa.array([doc] * len(part), pa.int64()), pa.array([digest] * len(part), pa.int64()),
                     pa.array(part, pa.int32()), pa.array(before, pa.string())], names=SUFFIX_NAMES)


def common_words(left: str, right: str) -> int:
    """Equal words at the beginning of two texts whose words are parted by one space."""
    if left == right:
        return left.count(" ") + bool(left)
    low, high = 0, min(len(left), len(right))
    while low < high:  # the longest common prefix, by comparisons of whole stretches
        middle = (low + high + 1) // 2
        if left.startswith(right[low:middle], low):
            low = middle
        else:
            high = middle - 1
    ended = low > 0 and left[low:low + 1] in ("", " ") and right[low:low + 1] in ("", " ")
    return left.count(" ", 0, low) + ended


def matches(this: tuple, other: tuple) -> list[tuple]:
    """The match of two suffixes, as seen from both documents."""
    if this[1:3] == other[1:3]:
        return []
    ahead = common_words(this[0], other[0])
    if ahead < COMPARED:
        return []
    back = common_words(this[4], other[4])
    return [(a[1], a[2], a[3] - back, a[3] + ahead, b[1], False, None, None, None) for a, b in ((this, other), (other, this))]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.string(), pa.int32(), pa.string()]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=MATCH_NAMES)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over sorted suffixes: matches with the nearest ones of other documents on both sides. The suffixes of
    the first and the last document in the slice are edges too."""
    other, same, edges = None, [], None  # the last of the document before, those of this one, the first document's

    def closed(after: tuple | None) -> list[tuple]:
        # Against the document behind, the last suffix is compared from there.
        found = [m for row in same if other is not None for m in matches(row, other)]
        return found + [m for row in same[:-1] if after is not None for m in matches(row, after)]

    for batch in batches:
        found = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if same and row[1:3] != same[-1][1:3]:
                found += closed(row)
                edges = same if edges is None else edges
                other, same = same[-1], []
            same.append(row)
        yield _batch(found)
    yield _batch(closed(None))
    yield _batch([(e[1], e[2], None, None, None, True, e[0], e[3], e[4]) for e in [*(edges or []), *same]])


def _compared_in(retained: DataFrame, order: list[str]) -> DataFrame:
    """The matches of neighbours in an order of all suffixes."""
    found = keep(retained.repartitionByRange(*order).sortWithinPartitions(*order).select(*SUFFIX_NAMES).mapInArrow(_neighbours, MATCH))
    # The suffixes of two documents for each range.
    edges = found.filter("edge").select(*SUFFIX_NAMES).withColumn("begin", F.xxhash64(F.substring_index("after", " ", COMPARED)))
    paired = edges.repartition(1).sortWithinPartitions(*order).select(*SUFFIX_NAMES).mapInArrow(_neighbours, MATCH)
    return found.unionByName(paired).filter(~F.col("edge"))


def passages(texts: DataFrame) -> DataFrame:
    """Per referenced document with repeated passages: their spans, with the documents matched there."""
    made = keep(seeds(texts, GRAM, SAMPLED, COMPARED))
    often = keep(made.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"))
    places = keep(made.join(often, "gram").groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set("at")).alias("places")))
    retained = texts_of(texts, places).join(places, ["doc_id", "digest"]).select("doc_id", "digest", "text", "places").mapInArrow(_suffixes, SUFFIX)
    retained = keep(retained.withColumn("begin", F.xxhash64(F.substring_index("after", " ", COMPARED))))
    ahead = _compared_in(retained, ["after", "doc_id", "digest", "at"])
    back = _compared_in(retained, ["begin", "before", "doc_id", "digest", "at"])
    everything = ahead.unionByName(back)
    spans = everything.groupBy("doc_id", "digest").agg(F.collect_set(F.struct("start", "end", "other_id")).alias("spans"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, digest, found in zip(*(c.to_pylist() for c in batch.columns)):
                for low, high in merged([(s["start"], s["end"]) for s in found]):
                    if high - low >= LEAST_WORDS:
                        others = {s["other_id"] for s in found if s["start"] < high and s["end"] > low}
                        out.append((doc, digest, low, high - low, [None if o == NULL_ID else o for o in sorted(others)]))
            columns = list(zip(*out)) if out else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "digest", "start", "words", "other_ids"])

    return spans.mapInArrow(joined, "doc_id bigint, digest bigint, start int, words int, other_ids array<bigint>")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per passage: doc_id, start and words (places in words), and the ids of documents matched there."""
    found = passages(references(docs, id_col, text_col))
    return found.select(F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "start", "words", "other_ids")
