"""Month calendars and the map from a requested month to the date that serves it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FALLBACK_POLICIES, LATEST_AS_OF, LATEST_OVERALL, SKIP


def _months_between(start: Column, end: Column) -> Column:
    first = F.trunc(start, "MM")
    month = F.expr("interval 1 month")
    # An end before the first month gives no month; a plain sequence would count down.
    return F.when(end >= first, F.sequence(first, end, month)).otherwise(
        F.array().cast("array<date>")
    )


def month_calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """First-of-month dates from the month of ``start`` up to ``end``, both inclusive."""
    months = _months_between(F.lit(start), F.lit(end))
    return spark.range(1).select(F.explode(months).alias("processing_date"))


def calendar_of(bounds: DataFrame, start: str = "first_date", end: str = "last_date") -> DataFrame:
    """The same calendar between two columns of a one-row frame, without an action."""
    months = _months_between(F.col(start), F.col(end))
    return bounds.select(F.explode(months).alias("processing_date"))


def available_dates(df: DataFrame, day: Column) -> DataFrame:
    """Distinct non-null dates of a dataset."""
    return df.select(day.alias("source_date")).where("source_date is not null").distinct()


def source_map(calendar: DataFrame, available: DataFrame, policy: str = SKIP) -> DataFrame:
    """Which source date serves each requested month.

    ``skip`` keeps only months with rows of their own.  ``latest_overall`` lets
    an empty month take the newest date of all, later ones included;
    ``latest_as_of`` takes the newest date up to the month.  The available dates
    travel as one array, which holds at most one entry per calendar day.
    """
    if policy not in FALLBACK_POLICIES:
        raise ValueError(f"unknown fallback policy {policy!r}")
    days = available.agg(F.collect_set("source_date")).scalar()
    dates, month = F.col("dates"), F.col("processing_date")
    own = F.when(F.array_contains(dates, month), month)
    source = {
        SKIP: own,
        LATEST_OVERALL: F.coalesce(own, F.array_max(dates)),
        LATEST_AS_OF: F.array_max(F.filter(dates, lambda day: day <= month)),
    }[policy]
    mapped = calendar.withColumn("dates", days).select(
        "processing_date", source.alias("source_date")
    )
    return mapped.where("source_date is not null")


def missing_months(calendar: DataFrame, loaded: DataFrame) -> DataFrame:
    """Requested months without a loaded one (``loaded`` has ``processing_date``)."""
    months = loaded.select("processing_date").distinct()
    return calendar.join(F.broadcast(months), "processing_date", "left_anti")
