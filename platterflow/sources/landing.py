"""Order lines parsed once per source file into a typed Parquet table, with the file as their lineage.

    <store>/lines/batch=<id>/   the lines of the files that one call found new
    <store>/ledger/<id>.parquet (file, bytes, changed, batch) of these files, written after their lines

A file is known by its path, its length and its time. What is in the ledger as it is now is read from Parquet; anything else is
parsed, so a second call over the same files reads no byte of CSV, and a file that has changed is read again. Of lines whose
file has changed or gone, none are returned; `clean` removes them.

Numbers are typed here, as every job reads them the same way. Dates stay text, as jobs differ in how they read them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platterflow.functions import coerce
from platterflow.sources import exports, records
from platterflow.sources.published import hadoop

NUMBERS = ("quantity", "selling_price", "discount", "amount_payable", "gross_item_amount")
LEDGER = "file string, bytes bigint, changed timestamp, batch string"


def ledger(spark: SparkSession, store: str) -> DataFrame:
    """One row per file and state that was ever landed."""
    if not exports.exists(spark, f"{store}/ledger"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", True).parquet(f"{store}/ledger")


def _new_files(spark: SparkSession, paths: str | Sequence[str], store: str) -> list[str]:
    """Paths still to be parsed: as many as the scan of them lists as well."""
    listed = records.files(spark, paths)
    known = ledger(spark, store).select("file", "bytes", "changed")
    return sorted(r.file for r in listed.join(known, ["file", "bytes", "changed"], "left_anti").select("file").collect())


def land(spark: SparkSession, paths: str | Sequence[str], store: str, format: str = "csv") -> int:
    """Parses the files not in the ledger; returns their number. A call that dies leaves no trace that is read."""
    new = _new_files(spark, paths, store)
    if not new:
        return 0
    batch = uuid.uuid4().hex
    # Listed before the lines are read: a file that changes meanwhile has another time at the next call, and is read again.
    states = spark.createDataFrame(records.files(spark, new).collect(), "file string, bytes bigint, changed timestamp")
    lines = exports.read_exports(spark, new, format)
    types = dict(lines.dtypes)
    lines = lines.withColumns({c: coerce.number(F.col(c), types[c]) for c in NUMBERS if c in types})
    lines.write.parquet(f"{store}/lines/batch={batch}")
    states.withColumn("batch", F.lit(batch)).coalesce(1).write.parquet(f"{store}/ledger/{batch}.parquet")
    return len(new)


def read(spark: SparkSession, paths: str | Sequence[str], store: str) -> DataFrame:
    """The landed lines of the files as they are now, in the order of `read_exports`."""
    numbers = records.numbered_files(spark, paths)
    # The last batch counts, should two calls have landed one state of a file.
    current = numbers.join(ledger(spark, store), ["file", "bytes", "changed"]).groupBy("file", "file_no").agg(
        F.max("batch").alias("batch"))
    schemas = spark.read.option("mergeSchema", True).option("basePath", f"{store}/lines").parquet(f"{store}/lines")
    found = schemas.join(records.small(current.withColumnRenamed("file", "line_file")), ["line_file", "batch"])
    order = F.struct(F.col("file_no").alias("file"), "line_order.offset", "line_order.row").alias("line_order")
    kept = [F.col(f"`{c}`") for c in schemas.columns if c not in ("line_order", "batch")]
    return found.select(*kept, order)


def lines(spark: SparkSession, paths: str | Sequence[str], store: str, format: str = "csv") -> DataFrame:
    """All lines of the files, parsed at most once per state of a file."""
    if isinstance(paths, str) and not exports.exists(spark, paths):
        raise FileNotFoundError(f"No source files found for {paths}")
    paths = paths if isinstance(paths, str) else exports.existing(spark, paths)
    land(spark, paths, store, format)
    return read(spark, paths, store)


def clean(spark: SparkSession, paths: str | Sequence[str], store: str) -> int:
    """Removes batches that hold no line of a file as it is now; returns their number."""
    now = records.files(spark, paths)
    held = ledger(spark, store)
    live = {r.batch for r in held.join(now, ["file", "bytes", "changed"], "left_semi").select("batch").distinct().collect()}
    system, folder = hadoop(spark, f"{store}/lines")
    gone = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName().removeprefix("batch=") not in live]
    for path in gone:
        name = path.getName().removeprefix("batch=")
        system.delete(hadoop(spark, f"{store}/ledger/{name}.parquet")[1], True)
        system.delete(path, True)
    return len(gone)
