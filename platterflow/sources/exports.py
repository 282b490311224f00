"""Order-line exports: CSV or Parquet files with their own headers, aligned by column name."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.session import keep
from platterflow.sources import records


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob stands for anything, on any file system Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return bool(found is not None and len(found))


def existing(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """The given paths; raises FileNotFoundError naming every one that is absent."""
    paths = list(paths)
    missing = [path for path in paths if not exists(spark, path)]
    if missing:
        raise FileNotFoundError("Input not found: " + ", ".join(missing))
    return paths


def read_exports(
    spark: SparkSession, paths: str | Sequence[str], format: str = "csv", line_breaks: bool = True,
) -> DataFrame:
    """All lines of the files named by a glob or a list, columns matched by name.

    Adds `line_order`, numbers for (file, split, row): it follows the names of the files and the order of the lines in them,
    however Spark packs the splits into tasks; and `line_file`, the path. Many tasks share a CSV file. Its cells may hold
    line breaks, which takes one more pass over the text (`sources.records`); without `line_breaks` that pass is left out.
    Headers are read by a Spark job; files of one header are scanned together.
    """
    names = [paths] if isinstance(paths, str) and exists(spark, paths) else paths
    names = [] if isinstance(names, str) else existing(spark, names)
    if not names:
        raise FileNotFoundError(f"No source files found for {paths}")
    numbers = records.numbered_files(spark, names)
    if format == "parquet":
        lines = spark.read.option("mergeSchema", True).parquet(*names)
        return _in_order(lines.select("*", *_places()), numbers, lines.columns)
    heads = keep(numbers.join(records.headers(spark, names), "file", "left"))
    headless = heads.filter(F.coalesce(F.trim("header"), F.lit("")) == "").select("file").limit(3).collect()
    if headless:
        raise ValueError("No header in " + ", ".join(r.file for r in headless))
    # One row per distinct header. Paths are listed only where there are several, and each group's scan lists them as well.
    groups = heads.groupBy("header").agg(F.min("file_no").alias("first")).orderBy("first").collect()
    scans = []
    for group in groups:
        own = names if len(groups) == 1 else [
            r.file for r in heads.filter(F.col("header") == group.header).orderBy("file_no").select("file").collect()]
        scan = _scan_records if line_breaks else _scan_lines
        scans.append(scan(spark, own, records.columns_of(group.header), numbers))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _places() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row")]


def _in_order(lines: DataFrame, numbers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lines that have the columns of `_places`, with `line_order` and `line_file` in their stead."""
    order = F.struct(F.col("file_no").alias("file"), F.col("split").alias("offset"), "row").alias("line_order")
    numbered = records.met(lines, numbers.select("file", "file_no"), ["file"])
    return numbered.select(*[F.col(f"`{c}`") for c in columns], order, F.col("file").alias("line_file"))


def _cells(header: Sequence[str], prefix: str = "") -> list[Column]:
    return [F.when(~F.col(f"{prefix}`{c}`").isin(*K.MISSING_TEXT), F.col(f"{prefix}`{c}`")).alias(c) for c in header]


def _schema(header: Sequence[str]) -> str:
    return ", ".join(f"`{column}` string" for column in header)


def _scan_lines(spark: SparkSession, names: list[str], header: Sequence[str], numbers: DataFrame) -> DataFrame:
    lines = spark.read.option("header", True).option("escape", '"').schema(_schema(header)).csv(names)
    return _in_order(lines.select(*_cells(header), *_places()), numbers, header)


def _scan_records(spark: SparkSession, names: list[str], header: Sequence[str], numbers: DataFrame) -> DataFrame:
    body = records.records(spark, names, numbers).filter(~F.col("head"))
    parsed = body.withColumn("cells", F.from_csv("record", _schema(header), {"escape": '"'}))
    order = F.struct(F.col("file_no").alias("file"), F.col("split").alias("offset"), "row").alias("line_order")
    named = records.met(parsed, numbers.select("file", "file_no"), ["file_no"])
    return named.select(*_cells(header, "cells."), order, F.col("file").alias("line_file"))


def source_files(lines: DataFrame, level: int = 1) -> DataFrame:
    """Lines read per source file, from the `line_file` the reader adds; level 2 is its folder."""
    name = F.element_at(F.split(F.col("line_file"), "/"), -level)
    return lines.groupBy(name.alias("source_file")).agg(F.count(F.lit(1)).alias("lines"))


def require_columns(lines: DataFrame, required: Iterable[str]) -> None:
    missing = sorted(set(required) - set(lines.columns))
    if missing:
        raise ValueError("Input is missing required columns: " + ", ".join(missing))
