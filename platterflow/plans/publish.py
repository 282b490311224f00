"""Sinks: JSON records and CSV.

The sections of one job are published together: readers find either all sections of a run or all of the one before, wherever
a job dies (see `sources.published`). A single output is written beside its place and moved there when it is whole.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platterflow.sources.published import MANIFESTS, VERSIONS, current, hadoop, manifests


def _bad_numbers(value: Column, kind: T.DataType) -> Column | None:
    """Count of NaN and infinite numbers in a value of any depth; None where its type has no numbers."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.coalesce((F.isnan(value) | (F.abs(value) == float("inf"))).cast("bigint"), F.lit(0).cast("bigint"))
    if isinstance(kind, T.StructType):
        parts = [p for f in kind if (p := _bad_numbers(value[f.name], f.dataType)) is not None]
        return reduce(Column.__add__, parts) if parts else None
    if isinstance(kind, T.MapType):
        return _bad_numbers(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, T.ArrayType):
        if _bad_numbers(F.lit(None), kind.elementType) is None:
            return None
        total = F.aggregate(value, F.lit(0).cast("bigint"), lambda n, x: n + _bad_numbers(x, kind.elementType))
        return F.coalesce(total, F.lit(0).cast("bigint"))
    return None


def not_finite(frame: DataFrame) -> DataFrame:
    """Count of NaN and infinite numbers in all columns, nested ones included."""
    zero = F.lit(0).cast("bigint")
    bad = [n for f in frame.schema if (n := _bad_numbers(F.col(f"`{f.name}`"), f.dataType)) is not None]
    return frame.agg(F.coalesce(F.sum(reduce(Column.__add__, bad, zero)), zero).alias("bad"))


def nulls_for_nan(frame: DataFrame) -> DataFrame:
    """Records as published: a value that is not a number is null."""
    doubles = [f.name for f in frame.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return frame.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in doubles})


# Order of the records of a published section; a minus sign stands for descending.
SECTION_ORDER = {
    "stationForecasts": ("riskLevel", "-forecastOrders", "stationCode"),
    "routeForecasts": ("stationCode", "-forecastOrders", "trainNo", "trainName"),
    "dailyForecasts": ("date", "stationCode"),
    "eventAlerts": ("date",),
    "stationSummaries": ("month", "-forecastOrders", "stationCode"),
    "stationDetails": ("month", "-forecastOrders", "stationCode"),
    "monthly": ("month",),
    "topItems": ("month", "station", "rank"),
}


def in_section_order(frame: DataFrame, name: str) -> DataFrame:
    names = SECTION_ORDER.get(name, ())
    order = [F.desc(n[1:]) if n.startswith("-") else F.asc(n) for n in names]
    return frame.orderBy(*order) if order else frame


class Publication:
    """The sections of one run, published together when the block ends without an error.

        with Publication(spark, "output/daily") as sections:
            sections.write(stations, "stationForecasts")
            sections.write(days, "dailyForecasts")

    What an earlier run that died has left is removed by the next one that ends. The version before the current one
    stays, for readers that have begun on it.
    """

    def __init__(self, spark: SparkSession, output: str):
        self.spark, self.output = spark, output.rstrip("/")
        self.version, self.sections = uuid.uuid4().hex, {}

    def path(self, name: str) -> str:
        return f"{self.output}/{VERSIONS}/{self.version}/{name}"

    def write(self, frame: DataFrame, name: str, strict: bool = True, format: str = "json") -> DataFrame:
        """Writes one section, JSON records in their published order or CSV, and returns it as written."""
        ordered = in_section_order(frame, name)
        if format == "json":
            write_records(ordered, self.path(name), strict)
        else:
            _csv(ordered).csv(self.path(name))
        self.sections[name] = format
        reader = self.spark.read.schema(frame.schema)
        return (reader if format == "json" else reader.option("header", True).option("escape", '"')).format(format).load(self.path(name))

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, *_: object) -> None:
        if kind is None:
            self.commit()
        else:
            _remove(self.spark, f"{self.output}/{VERSIONS}/{self.version}")

    def commit(self) -> None:
        """One rename makes the run current. Of two runs that end at once the second fails, and the first one's sections stay."""
        before = current(self.spark, self.output)
        number = (before["number"] if before else 0) + 1
        name = f"{self.output}/{MANIFESTS}/{number:020d}.json"
        record = json.dumps({"version": self.version, "sections": self.sections, "before": before and before["version"]})
        system, staged = hadoop(self.spark, f"{self.output}/{MANIFESTS}/.{self.version}")
        stream = system.create(staged, False)
        try:
            stream.write(bytearray(record.encode()))
        finally:
            stream.close()
        _, final = hadoop(self.spark, name)
        if system.exists(final) or not system.rename(staged, final):
            system.delete(staged, False)
            raise RuntimeError(f"Another run published {name} meanwhile")
        self.clean()

    def clean(self) -> None:
        """Removes all versions but the current one and the one before it, and the manifests before theirs."""
        kept = current(self.spark, self.output)
        for old in manifests(self.spark, self.output)[2:]:
            _remove(self.spark, f"{self.output}/{MANIFESTS}/{old}")
        system, versions = hadoop(self.spark, f"{self.output}/{VERSIONS}")
        for status in system.listStatus(versions):
            if status.getPath().getName() not in (kept["version"], kept["before"]):
                system.delete(status.getPath(), True)


def _remove(spark: SparkSession, name: str) -> None:
    system, path = hadoop(spark, name)
    system.delete(path, True)


@contextlib.contextmanager
def _swapped_in(spark: SparkSession, path: str):
    """A folder to write to that takes the place of `path` when the block ends; on an error `path` stays as it was."""
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    try:
        yield f"{beside}.new"
        system, final = hadoop(spark, path)
        _, new = hadoop(spark, f"{beside}.new")
        _, old = hadoop(spark, f"{beside}.old")
        if system.exists(final):
            system.rename(final, old)
        system.mkdirs(final.getParent())
        if not system.rename(new, final):
            if system.exists(old):
                system.rename(old, final)
            raise RuntimeError(f"Could not move the output to {path}")
        system.delete(old, True)
    finally:
        _remove(spark, f"{beside}.new")


def _csv(frame: DataFrame):
    return frame.write.option("header", True).option("escape", '"')


def write_records(frame: DataFrame, path: str, strict: bool = True) -> None:
    """JSON records to a new folder; with `strict` a NaN or infinite number raises ValueError before the write."""
    if strict and not_finite(frame).first()["bad"]:
        raise ValueError(f"NaN or infinite numbers may not be written to {path}")
    frame.write.option("ignoreNullFields", False).json(path)


def write_json(frame: DataFrame, path: str, strict: bool = True) -> None:
    """JSON records in place of what the path held."""
    with _swapped_in(frame.sparkSession, path) as folder:
        write_records(frame, folder, strict)


def write_csv(frame: DataFrame, path: str) -> None:
    """CSV in place of what the path held."""
    with _swapped_in(frame.sparkSession, path) as folder:
        _csv(frame).csv(folder)


def write_missing_csv(frame: DataFrame, path: str) -> None:
    """CSV for a user to edit: an output that exists already is left alone."""
    _csv(frame).mode("ignore").csv(path)
