"""Typing of text cells: names, numbers, instants, flags and order states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from platterflow import constants as K


def text(cell: Column, fallback: str) -> Column:
    """Strip the cell; a missing or blank one becomes `fallback`."""
    stripped = F.btrim(cell.cast("string"), F.lit(K.WHITESPACE))
    return F.coalesce(F.nullif(stripped, F.lit("")), F.lit(fallback))


def number(cell: Column, dtype: str = "string") -> Column:
    """Double value of the cell, null where it is not a number."""
    if dtype == "string":
        # The JVM parser takes a type suffix as in "1.5d"; an export means text by it.
        parsed = F.when(~cell.rlike(r"[0-9.]\s*[dDfF]\s*$"), cell.try_cast("double"))
    else:
        parsed = cell.cast("double")
    return F.when(~F.isnan(parsed), parsed)


def number_or_zero(cell: Column, dtype: str = "string") -> Column:
    return F.coalesce(number(cell, dtype), F.lit(0.0))


def instant(cell: Column, dtype: str = "string") -> Column:
    """Wall-clock timestamp of the cell in any of the known formats, null for the rest."""
    if dtype != "string":
        return cell.cast("timestamp_ntz")
    trimmed = F.btrim(cell)
    slashed = F.translate(trimmed, "-.", "//")
    other = None
    for shape, pattern in K.DATE_FORMATS:
        # The shape is tested first: a failed parse costs far more than a failed match.
        parsed = F.try_to_timestamp(slashed, F.lit(pattern)).cast("timestamp_ntz")
        hit = slashed.rlike(shape)
        other = F.when(hit, parsed) if other is None else other.when(hit, parsed)
    return F.coalesce(trimmed.try_cast("timestamp_ntz"), other)


def flag(cell: Column, dtype: str = "string") -> Column:
    """0 or 1: numbers are clamped, anything else counts as 0."""
    return F.least(F.greatest(number_or_zero(cell, dtype), F.lit(0.0)), F.lit(1.0)).cast("int")


def is_fulfilled(status: Column) -> Column:
    return F.coalesce(status.isin(*K.FULFILLED_STATUSES), F.lit(False))


def is_cancelled(status: Column) -> Column:
    return F.coalesce(status.ilike(K.CANCELLED_PATTERN), F.lit(False))
