"""Aggregates over groups that skip nulls on each side on their own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from countypanel.functions.scalars import safe_ratio


def ratio_of_sums(numerator: Column, denominator: Column) -> Column:
    """sum(n) / sum(d), null when the denominator sums to zero or to nothing."""
    return safe_ratio(F.sum(numerator), F.sum(denominator))


def sum_when(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))
