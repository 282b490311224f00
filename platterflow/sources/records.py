"""CSV files cut into records by many tasks per file, though a quoted cell may hold line breaks.

Where a split of a file begins, nothing in it tells whether that place is inside a quoted cell. So each split is first
walked for both cases at once: it yields the state at its end had it begun outside of a cell, and had it begun inside. Put one
after another, these give the state at the beginning of every split. A second walk then cuts each split into records; what
a split holds of a record that began before it, or that goes on after it, is stitched in a last step that sees at most two
pieces per split.

Lines end with a line feed, with or without a carriage return before it. Quotes count where a cell begins with one; two
quotes in such a cell stand for one; a quote inside of a bare cell is text. Blank lines between records are no records.
"""

from __future__ import annotations

import contextlib
import csv
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from platterflow.operators.ordering import global_rank
from platterflow.session import keep

# Tables of a row per file or split may be broadcast up to so many rows; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 400_000
_ONE_FILE = 1 << 40  # bytes of a split, so that a task holds the beginning of one file


def files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, bytes, changed) of the files named by a glob or a list. Contents are not read."""
    found = spark.read.format("binaryFile").load(paths)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"),
                        F.col("modificationTime").alias("changed"))


def numbered_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """`files` with `file_no`, the position in the order of names: a key of fixed width for the order of lines."""
    return keep(global_rank(files(spark, paths), [F.col("file")], "file_no"))


def small(stored: DataFrame) -> DataFrame:
    """A table to be broadcast if it has few rows."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def met(lines: DataFrame, stored: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Lines with the columns of a stored table of a row per file or split, in their order within each split.

    Broadcasting few rows leaves the lines where they are; for more, lines are shuffled by split and sorted again.
    """
    if stored.count() <= BROADCAST_ROWS:
        return lines.join(F.broadcast(stored), keys, how)
    moved = lines.join(stored, keys, how)
    return moved.repartition("file_no", "split").sortWithinPartitions("file_no", "split", "row")


def open_after(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted cell, from whether it began inside one."""
    at = 0
    while True:
        if not inside and line[at:at + 1] == '"':
            inside, at = True, at + 1
        while inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line[at + 1:at + 2] == '"':
                at += 2
            else:
                inside, at = False, at + 1
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1


def _physical_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, split, row, line): `split` the byte where the split begins, `row` rising within a task."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The parts of a batch that lie in one split, with (file_no, split)."""
    file_no, split = batch["file_no"].to_numpy(), batch["split"].to_numpy()
    cuts = np.flatnonzero((np.diff(file_no) != 0) | (np.diff(split) != 0)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        if hi > lo:
            yield (int(file_no[lo]), int(split[lo])), batch.slice(lo, hi - lo)


def _with_quotes(lines: pa.Array) -> list[int]:
    """Places of the lines that hold a quote; others change no state."""
    return np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)).tolist()


def _split_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: the state at its end had it begun outside of a quoted cell, and inside of one."""
    def row(key: tuple[int, int], ends: list[bool]) -> pa.RecordBatch:
        return pa.record_batch({"file_no": [key[0]], "split": [key[1]], "from_outside": [ends[0]], "from_inside": [ends[1]]})

    at, ends = None, [False, True]
    for batch in batches:
        for key, part in _runs(batch):
            if key != at:
                if at:
                    yield row(at, ends)
                at, ends = key, [False, True]
            lines = part["line"]
            for i in _with_quotes(lines):
                line = lines[i].as_py()
                ends = [open_after(line, ends[0])] * 2 if ends[0] == ends[1] else [open_after(line, e) for e in ends]
    if at:
        yield row(at, ends)


PIECE = "file_no bigint, split bigint, row bigint, head boolean, part int, record string"
WHOLE, BEGUN, MIDDLE, ENDED = range(4)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records, and the pieces of those that reach over the ends of a split.

    `part` is WHOLE; BEGUN for the end of a split inside of a record; ENDED for the beginning of a split up to the end of the
    record before it; MIDDLE for a split without any end of a record. `head` marks the record that begins a file.
    """
    def pieces(key: tuple[int, int], rows: list, parts: list, texts: list) -> pa.RecordBatch:
        n = len(rows)
        return pa.record_batch({
            "file_no": pa.array([key[0]] * n, pa.int64()), "split": pa.array([key[1]] * n, pa.int64()),
            "row": pa.array(rows, pa.int64()), "head": pa.array([r == head for r in rows], pa.bool_()),
            "part": pa.array(parts, pa.int32()), "record": pa.array(texts, pa.string())})

    at, inside, carried, held, first, head = None, False, False, [], None, None

    def rest(key: tuple[int, int]) -> pa.RecordBatch:
        """What is open at the end of a split."""
        return pieces(key, [first], [MIDDLE if carried else BEGUN], ["\n".join(held)])

    for batch in batches:
        for key, part in _runs(batch):
            if key != at:
                if at and inside:
                    yield rest(at)
                at, held, first = key, [], None
                head = part["row"][0].as_py() if key[1] == 0 else None
                inside = carried = bool(part["inside"][0].as_py())
            lines, rows = part["line"], part["row"]
            whole = np.ones(part.num_rows, dtype=bool)
            out: tuple[list, list, list] = ([], [], [])
            seen = 0
            for i in [*_with_quotes(lines), part.num_rows]:
                if inside and i > seen:  # lines without quotes inside of a cell
                    first = rows[seen].as_py() if first is None else first
                    held += lines.slice(seen, i - seen).to_pylist()
                    whole[seen:i] = False
                seen = i + 1
                if i == part.num_rows:
                    break
                line = lines[i].as_py()
                after = open_after(line, inside)
                if not inside and not after:
                    continue
                whole[i] = False
                first = rows[i].as_py() if first is None else first
                held.append(line)
                inside = after
                if not inside:
                    for column, value in zip(out, (first, ENDED if carried else WHOLE, "\n".join(held))):
                        column.append(value)
                    held, first, carried = [], None, False
            kept = part.filter(pa.array(whole))
            if kept.num_rows:
                yield pa.record_batch({
                    "file_no": kept["file_no"], "split": kept["split"], "row": kept["row"],
                    "head": pa.array(kept["row"].to_numpy() == (-1 if head is None else head)), "part": pa.array(np.zeros(kept.num_rows, dtype=np.int32)), "record": kept["line"]})
            if out[0]:
                yield pieces(key, *out)
    if at and inside:
        yield rest(at)


def split_states(lines: DataFrame) -> DataFrame:
    """(file_no, split) of the splits that begin inside of a quoted cell."""
    ends = keep(lines.select("file_no", "split", "line").mapInArrow(
        _split_ends, "file_no bigint, split bigint, from_outside boolean, from_inside boolean"))
    # A split either ends in one state whatever came before, or hands its state on, or turns it. So the state before a
    # split is that after the last split of the first kind, turned as often as splits since then do so.
    fixed, turns = F.col("from_outside") == F.col("from_inside"), F.col("from_outside") & ~F.col("from_inside")
    order = Window.partitionBy("file_no").orderBy("split")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turned = ends.withColumns({
        "turned": F.count_if(turns).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "turned_before": F.coalesce(F.count_if(turns).over(before), F.lit(0))})
    last = F.last(F.when(fixed, F.struct("from_outside", "turned")), ignorenulls=True).over(before)
    placed = turned.withColumn("last", last)
    odd = (F.col("turned_before") - F.coalesce(F.col("last.turned"), F.lit(0))) % 2 == 1
    inside = F.coalesce(F.col("last.from_outside"), F.lit(False)) != odd
    return keep(placed.filter(inside).select("file_no", "split"))


def records(spark: SparkSession, paths: str | Sequence[str], numbers: DataFrame) -> DataFrame:
    """(file_no, split, row, head, record) of all files; `head` for the headers, `numbers` from `numbered_files`.

    (file_no, split, row) follows the order of the records in the files, however Spark packs splits into tasks.
    """
    lines = met(_physical_lines(spark, paths), numbers.select("file", "file_no"), ["file"]).drop("file")
    inside = split_states(lines)
    marked = met(lines, inside.withColumn("inside", F.lit(True)), ["file_no", "split"], "left").withColumn(
        "inside", F.coalesce("inside", F.lit(False)))
    cut = marked.select("file_no", "split", "row", "line", "inside").mapInArrow(_cut, PIECE)
    if not inside.isEmpty():
        cut = keep(cut)
        order = Window.partitionBy("file_no").orderBy("split", "row")
        # At most two rows per split: the pieces of a record follow the one that begins it.
        pieces = cut.filter(F.col("part") != WHOLE).withColumn("of", F.count_if(F.col("part") == BEGUN).over(order))
        listed = F.sort_array(F.collect_list(F.struct("split", "row", "head", "record")))
        stitched = pieces.groupBy("file_no", "of").agg(listed.alias("all")).select(
            "file_no", F.col("all")[0]["split"].alias("split"), F.col("all")[0]["row"].alias("row"),
            F.col("all")[0]["head"].alias("head"),
            F.array_join(F.transform("all", lambda p: p["record"]), "\n").alias("record"))
        cut = cut.filter(F.col("part") == WHOLE).drop("part").unionByName(stitched)
    else:
        cut = cut.drop("part")
    record = F.regexp_replace("record", "\r\\z", "")
    return cut.withColumn("record", record).filter(F.trim("record") != "")


@contextlib.contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _first_record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first record of each file whose beginning the task holds; reads no further than the last of them."""
    at, held, done = None, [], True
    for batch in batches:
        for file, line in zip(batch["file"].to_pylist(), batch["line"].to_pylist()):
            if file != at:
                at, held, done = file, [], False
            if done:
                continue
            held.append(line)
            if not open_after("\n".join(held), False):
                done = True
                yield pa.record_batch({"file": [file], "header": ["\n".join(held)]})
        if done and batch.num_rows:
            return


def headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, header) by a Spark job with a task per file that stops after the header."""
    bounds = {"spark.sql.files.maxPartitionBytes": str(_ONE_FILE), "spark.sql.files.openCostInBytes": str(_ONE_FILE)}
    with _settings(spark, **bounds):
        begun = _physical_lines(spark, paths).filter("split = 0").select("file", "line")
        return keep(begun.mapInArrow(_first_record, "file string, header string").withColumn(
            "header", F.regexp_replace(F.regexp_replace("header", "\r\\z", ""), "\\A\ufeff", "")))


def columns_of(header: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([header])))
