"""Instants of a column in one format, the one its first text has; texts in any other format are null.

The shapes below are products of a date and a time. The one that holds is chosen by a scalar subquery inside the plan: no
step of its own, and the driver sees no cell. Where the first text has none of the shapes, every cell is read in its own
format (`coerce.instant`).
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platterflow.functions import coerce

_MONTH, _LATE_DAY = "(0?[1-9]|1[0-2])", "(1[3-9]|2[0-9]|3[01])"
_DATES = [
    (r"\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"), (r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"),
    # Month first, unless the first text's month would be beyond twelve.
    *[(rf"{first}[{sep}]\d{{1,2}}[{sep}]\d{{4}}", f"{order[0]}{sep}{order[1]}{sep}yyyy")
      for sep in "/-." for first, order in ((_MONTH, "Md"), (_LATE_DAY, "dM"))],
    (r"\d{1,2}-[A-Z][a-z]{2}-\d{4}", "d-MMM-yyyy"), (r"\d{1,2} [A-Z][a-z]{2} \d{4}", "d MMM yyyy"),
    (r"[A-Z][a-z]{2} \d{1,2}, \d{4}", "MMM d, yyyy"), (r"\d{8}", "yyyyMMdd"),
]
_CLOCKS = [(r"\d{1,2}:\d{2}", "H:mm"), (r"\d{1,2}:\d{2}:\d{2}", "H:mm:ss"), (r"\d{1,2}:\d{2}:\d{2}\.\d{1,9}", "H:mm:ss.SSSSSSSSS")]
_TIMES = [("", ""), *[(gap + shape, literal + pattern) for (gap, literal), (shape, pattern) in product(
    ((" ", " "), ("T", "'T'")), _CLOCKS)]]
SHAPES = [(date + time, dates + times) for (date, dates), (time, times) in product(_DATES, _TIMES)]
NO_TEXT = ("", "NaT", "nat", "NaN", "nan", "None", "NULL", "null", "NA", "N/A", "n/a", "<NA>")


def pattern_of(text: Column) -> Column:
    """The pattern of the shape a text has, null for none."""
    found = F.lit(None).cast("string")
    for shape, pattern in reversed(SHAPES):
        found = F.when(text.rlike(f"^{shape}$"), pattern).otherwise(found)
    return found


def column_pattern(lines: DataFrame, column: str, order: Column) -> Column:
    """A scalar: the pattern of the column's first text, null where that has no known shape."""
    texts = lines.select(F.col(column).alias("text"), order.alias("at")).filter(~F.col("text").isin(*NO_TEXT))
    return texts.agg(F.min_by("text", "at").alias("first")).select(pattern_of(F.col("first")).alias("pattern")).scalar()


def instant(cell: Column, pattern: Column) -> Column:
    """Wall-clock timestamp of a text cell in the pattern, or in the cell's own format where there is no pattern."""
    strict = F.try_to_timestamp(cell, pattern).cast("timestamp_ntz")
    return F.when(pattern.isNull(), coerce.instant(cell)).otherwise(strict)
