"""Guarded arithmetic shared by the layers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_if_positive(top: Column, bottom: Column, otherwise: Column | None = None) -> Column:
    """``top / bottom`` where ``bottom > 0``; ``otherwise`` (null by default) elsewhere."""
    guarded = F.when(bottom > 0, F.try_divide(top, bottom))
    return guarded if otherwise is None else guarded.otherwise(otherwise)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, 1).otherwise(0)


def row_sum(columns: Sequence[Column]) -> Column:
    return reduce(add, columns)


def positive_part(c: Column) -> Column:
    return F.when(c > 0, c).otherwise(F.lit(0.0))


def negative_part(c: Column) -> Column:
    return F.when(c < 0, c).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``; null where there is nothing to divide by."""
    return F.try_divide(part * F.lit(100.0), whole)


def equal_width_bucket(c: Column, low: Column, high: Column, bins: Column) -> Column:
    """1-based bucket of an equal-width histogram whose last bucket includes the top edge."""
    return F.least(F.floor(bins * (c - low) / (high - low)) + 1, bins).cast("int")
