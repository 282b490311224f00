"""Typed, filtered order lines for each of the jobs.

Every function takes raw lines (text or typed cells) and projects only what its job reads, so the
columns a job does not name are pruned at the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.functions import coerce, dates, inferred


def line_order(lines: DataFrame) -> Column:
    """Position of a line among the others; a full business key where the reader gave none."""
    if "line_order" in lines.columns:
        return F.col("line_order")
    return F.struct(*sorted(lines.columns))


def column_instant(lines: DataFrame, name: str) -> Column:
    """Timestamps of a column whose texts share one format; see `functions.inferred`."""
    if dict(lines.dtypes)[name] != "string":
        return coerce.instant(F.col(name), "typed")
    return inferred.instant(F.col(name), inferred.column_pattern(lines, name, line_order(lines)))


class _Cells:
    """Typed access to the cells of a raw line frame."""

    def __init__(self, lines: DataFrame):
        self.lines, self.types = lines, dict(lines.dtypes)

    def text(self, name: str, fallback: str | None = None) -> Column:
        return coerce.text(F.col(name), fallback or K.FALLBACK_TEXT[name]).alias(name)

    def number(self, name: str) -> Column:
        return coerce.number(F.col(name), self.types[name]).alias(name)

    def number_or_zero(self, name: str) -> Column:
        return coerce.number_or_zero(F.col(name), self.types[name]).alias(name)

    def instant(self, name: str) -> Column:
        return coerce.instant(F.col(name), self.types[name]).alias(name)

    def instant_of_column(self, name: str) -> Column:
        """In the one format that the column's first text has."""
        return column_instant(self.lines, name).alias(name)


def delivered_lines(lines: DataFrame) -> DataFrame:
    """Fulfilled lines with a delivery date, for the daily forecast."""
    cell = _Cells(lines)
    return (
        lines.filter(coerce.is_fulfilled(F.col("order_status")))
        .select(
            "order_id",
            cell.instant("delivery_date").cast("date").alias("date"),
            cell.text("station_code"), cell.text("station_name"), cell.text("outlet_name"),
            cell.text("train_no"), cell.text("train_name"),
            cell.number("amount_payable"), cell.number_or_zero("gross_item_amount"),
            line_order(lines).alias("line_order"),
        )
        .na.drop(subset=["order_id", "date"])
    )


def booked_lines(lines: DataFrame) -> DataFrame:
    """All booked lines, cancelled ones included, for the monthly forecast."""
    cell = _Cells(lines)
    return (
        lines.select(
            "order_id", cell.instant("booking_date"),
            cell.text("station_code"), cell.text("station_name"), cell.text("item_name"),
            cell.text("order_status"), cell.number_or_zero("quantity"),
            cell.number("amount_payable"), cell.number_or_zero("gross_item_amount"),
            line_order(lines).alias("line_order"),
        )
        .na.drop(subset=["booking_date", "order_id"])
        .withColumns({
            "year": F.year("booking_date"),
            "month_number": F.month("booking_date"),
            "month": dates.month_key(F.col("booking_date")),
            "week_of_month": dates.week_of_month(F.col("booking_date")),
            "is_cancelled": coerce.is_cancelled(F.col("order_status")),
            "is_fulfilled": coerce.is_fulfilled(F.col("order_status")),
        })
    )


def dashboard_lines(lines: DataFrame, code_fallback: str = K.FALLBACK_TEXT["station_code"]) -> DataFrame:
    """Booked lines under the dashboard's names; `outlet_name` stays as it came."""
    cell = _Cells(lines)
    return (
        lines.select(
            "order_id", cell.instant_of_column("booking_date"),
            cell.text("station_code", code_fallback),
            cell.text("station_name").alias("station"),
            cell.text("item_name").alias("item"),
            cell.text("order_status").alias("status"),
            F.col("outlet_name"), cell.number_or_zero("quantity"),
            cell.number("amount_payable"), cell.number_or_zero("gross_item_amount"),
            line_order(lines).alias("line_order"),
        )
        .na.drop(subset=["booking_date", "order_id"])
        .withColumns({
            "month": dates.month_key(F.col("booking_date")),
            "is_cancelled": coerce.is_cancelled(F.col("status")),
            "is_fulfilled": coerce.is_fulfilled(F.col("status")),
        })
    )


def report_lines(lines: DataFrame) -> DataFrame:
    """Fulfilled lines by creation month for the best-seller report, names untouched."""
    cell = _Cells(lines)
    return (
        lines.filter(coerce.is_fulfilled(F.col("order_status")))
        .select(
            dates.month_key(cell.instant_of_column("created_at")).alias("month"),
            F.col("item_name"), F.col("outlet_name"), F.col("station_name"),
            F.col("order_id"), cell.number_or_zero("quantity"),
        )
        .na.drop(subset=["month", "item_name"])
    )


def booking_lines(lines: DataFrame) -> DataFrame:
    """Lines as known when an order is booked, for the cancellation model; names untouched."""
    cell = _Cells(lines)
    return (
        lines.select(
            "order_id", cell.instant_of_column("booking_date"), cell.instant_of_column("eta"),
            coerce.is_cancelled(F.col("order_status")).alias("cancelled"),
            *[F.col(c).cast("string").alias(c) for c in K.CANCELLATION_CATEGORIES],
            F.col("item_name"),
            cell.number_or_zero("quantity"), cell.number_or_zero("selling_price"),
            cell.number_or_zero("discount"),
            line_order(lines).alias("line_order"),
        )
        .na.drop(subset=["booking_date", "order_id"])
    )
