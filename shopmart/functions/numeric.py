"""Exact money and ratio expressions.

Sums of DECIMAL do not depend on row order, so results are the same however
the data is partitioned.  Ratios are divided as DECIMAL and rounded half away
from zero once, never through DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
MONEY_TOTAL = "decimal(22,2)"
_WIDE = "decimal(22,2)"


def money(col: Column) -> Column:
    return col.cast(MONEY)


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """``round(numerator / denominator, digits)``; NULL when the denominator is 0."""
    quotient = F.try_divide(numerator.cast(_WIDE), denominator.cast(_WIDE))
    return F.round(quotient, digits)


def percent(numerator: Column, denominator: Column, digits: int) -> Column:
    """``round(100 * numerator / denominator, digits)``; NULL when dividing by 0."""
    quotient = F.try_divide(numerator.cast(_WIDE) * F.lit(100), denominator.cast(_WIDE))
    return F.round(quotient, digits)


def mean(col: Column, digits: int) -> Column:
    """Aggregate: exact mean of the non-null values."""
    return ratio(F.sum(col), F.count(col), digits)


def true_percent(flag: Column, digits: int) -> Column:
    """Aggregate: share of TRUE among the non-null values of ``flag``."""
    return percent(F.count_if(flag), F.count(flag), digits)


def coordinate_mean(col: Column) -> Column:
    """Aggregate: mean of a DOUBLE coordinate, independent of row order."""
    total = F.sum(col.cast("decimal(18,14)")).cast("decimal(32,14)")
    return F.try_divide(total, F.count(col).cast("decimal(12,0)"))
