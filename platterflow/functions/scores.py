"""Business rules on forecast numbers and the texts made from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from platterflow import constants as K


def whole(value: Column) -> Column:
    """Nearest integer, ties to even."""
    return F.bround(value).cast("bigint")


def at_least(value: Column, floor: float) -> Column:
    return F.greatest(value, F.lit(floor))


def risk_level(share: Column) -> Column:
    bands = None
    for threshold, label in K.RISK_BANDS:
        hit = share >= threshold
        bands = F.when(hit, label) if bands is None else bands.when(hit, label)
    return bands.otherwise(K.LOWEST_RISK)


def readiness(gap_share: Column) -> Column:
    kept = F.least(F.lit(100.0), F.lit(100.0) - gap_share * K.READINESS_SLOPE)
    return whole(at_least(kept, float(K.READINESS_FLOOR)))


def action(risk: Column, vendor_gap: Column) -> Column:
    return F.when(risk == K.LOWEST_RISK, K.CALM_ACTION).otherwise(
        F.format_string(K.BUSY_ACTION, vendor_gap))


def percent_change(value: Column, base: Column) -> Column:
    """Change of `value` over `base` in percent with one decimal."""
    return F.bround((value / at_least(base, 1.0) - 1) * 100, 1)


def grouped_digits(value: Column) -> Column:
    """Integer text with thousands separators."""
    return F.format_number(F.coalesce(value, F.lit(0)).cast("bigint"), 0)


def lakh(value: Column) -> Column:
    return F.format_string("INR %.2fL", value / 100000)
