"""Exact decimal arithmetic: two roundings, safe rates and means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Ties go away from zero (value must be a decimal)."""
    return F.round(value, digits)


def round_half_even(value: Column, digits: int) -> Column:
    """Ties go to the even neighbour (value must be a decimal)."""
    return F.bround(value, digits)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def percent_of(part: Column, total: Column, digits: int) -> Column:
    """``part`` as a percentage of ``total``; NULL when there is nothing to divide by."""
    hundredfold = part.cast("decimal(20,0)") * F.lit("100.00").cast("decimal(5,2)")
    return F.round(hundredfold / F.nullif(total.cast("decimal(20,0)"), F.lit(0)), digits)


def exact_mean(value: Column, digits: int) -> Column:
    """Rounded mean of a decimal column.

    ``F.avg`` keeps four extra digits and rounds there first, so a second rounding
    could tip a near-tie; dividing the exact sum keeps sixteen.
    """
    total = F.sum(value).cast("decimal(24,2)")
    return F.round(total / F.nullif(F.count(value).cast("decimal(14,0)"), F.lit(0)), digits)
