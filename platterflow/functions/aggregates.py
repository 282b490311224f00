"""Aggregate expressions that give the same value for every partitioning of the rows.

Money is added as DECIMAL, so the total does not depend on the order of the rows; "first" and "last"
follow an explicit row order.  All of them combine map-side, so one group holding a large part of
the rows is merged from partial results and never gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts of up to 24 digits before the point. A larger one is no amount of an order: it counts as missing.
MONEY = "decimal(28,4)"
UNITS = "decimal(30,6)"


def rows() -> Column:
    return F.count(F.lit(1))


def exact_sum(amount: Column) -> Column:
    """Decimal sum of amounts rounded to four decimals, null when every amount is missing."""
    return F.sum(amount.try_cast(MONEY))


def money_sum(amount: Column) -> Column:
    """`exact_sum` as a double; 0 when every amount is missing."""
    return F.coalesce(exact_sum(amount).cast("double"), F.lit(0.0))


def money_rollup(subtotal: Column) -> Column:
    """Total of `exact_sum` subtotals as a double."""
    return F.coalesce(F.sum(subtotal).cast("double"), F.lit(0.0))


def exact_units(quantity: Column) -> Column:
    """Decimal sum of quantities rounded to six decimals, null when every quantity is missing."""
    return F.sum(quantity.try_cast(UNITS))


def units_sum(quantity: Column) -> Column:
    """`exact_units` as a double; 0 when every quantity is missing."""
    return F.coalesce(exact_units(quantity).cast("double"), F.lit(0.0))


def units_rollup(subtotal: Column) -> Column:
    """Total of `exact_units` subtotals as a double."""
    return F.coalesce(F.sum(subtotal).cast("double"), F.lit(0.0))


def first_row(columns: Sequence[str], order: Column) -> Column:
    """Struct of `columns` from the first row; use it for columns that are never null."""
    return F.min_by(F.struct(*columns), order)


def first_known(column: str, order: Column) -> Column:
    """First value that is not null."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), order))


def order_revenue(payable: str = "amount_payable", gross: str = "gross_item_amount") -> Column:
    """Payable amount once per order, else the sum of its item amounts, else 0."""
    return F.coalesce(F.max(payable), money_sum(F.col(gross)))
