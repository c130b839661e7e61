"""Exact totals and safe ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(column: str | Column, digits: int | None = None) -> Column:
    """Decimal sum shown as a double; rounding, if any, happens before the cast."""
    exact = F.sum(column)
    return (exact if digits is None else F.round(exact, digits)).cast("double")


def ratio(numerator: str | Column, denominator: str | Column, digits: int = 6) -> Column:
    """numerator / denominator, 0 where the denominator is 0 or missing."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    den = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.round(F.coalesce(F.try_divide(num, den), F.lit(0.0)), digits)


def percent(numerator: str | Column, denominator: str | Column, digits: int = 4) -> Column:
    """100 * numerator / denominator, 0 where the denominator is 0 or missing."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    return ratio(num * 100, denominator, digits)
