"""Bronze layer: date normalisation, monthly slicing, fallback, lineage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SKIP
from ..functions.parsing import iso_text, normalize_date, snapshot_day
from .calendar import available_dates, source_map

DATE_COLUMN = "snapshot_date"


def with_normalized_date(df: DataFrame, date_column: str = DATE_COLUMN) -> DataFrame:
    """Add ``normalized_snapshot_date``, the ISO text of the date column."""
    return df.withColumn("normalized_snapshot_date", normalize_date(F.col(date_column)))


def sample_dates(df: DataFrame, date_column: str = DATE_COLUMN, n: int = 5) -> DataFrame:
    """Up to ``n`` distinct raw date values, in text order."""
    return df.select(date_column).distinct().orderBy(date_column).limit(n)


def latest_date(df: DataFrame, day: Column) -> DataFrame:
    """One row with the newest date of a dataset."""
    return df.agg(F.max(day).alias("latest_date"))


def slice_month(df: DataFrame, month: dt.date, date_column: str = DATE_COLUMN) -> DataFrame:
    """Rows of one month, matched on the normalised date text."""
    normalized = with_normalized_date(df, date_column)
    return normalized.where(F.col("normalized_snapshot_date") == month.isoformat())


def slice_month_typed(df: DataFrame, month: dt.date, date_column: str = DATE_COLUMN) -> DataFrame:
    """Rows of one month of an already typed date column; the filter reaches the scan."""
    return df.where(F.col(date_column) == F.lit(month))


def undated(df: DataFrame, month: dt.date) -> DataFrame:
    """A dataset without a date column belongs to the month as a whole."""
    return df.withColumn("processed_date", F.lit(month.isoformat()))


def dataset_source_map(
    df: DataFrame,
    calendar: DataFrame,
    policy: str = SKIP,
    date_column: str = DATE_COLUMN,
) -> DataFrame:
    """Source date of every calendar month for one raw dataset."""
    return source_map(calendar, available_dates(df, snapshot_day(F.col(date_column))), policy)


def slice_months(
    df: DataFrame,
    calendar: DataFrame,
    policy: str = SKIP,
    date_column: str = DATE_COLUMN,
) -> DataFrame:
    """Slices of all calendar months in one job, tagged with ``processing_date``.

    With ``skip`` a row serves its own month only and one pass over the data is
    enough.  With a fallback policy one source date may serve many months, and
    its rows come back once per month.  The broadcast side has one row per
    requested month.
    """
    dated = with_normalized_date(df, date_column).withColumn(
        "source_date", snapshot_day(F.col(date_column))
    )
    if policy == SKIP:
        months = calendar.withColumn("source_date", F.col("processing_date"))
    else:
        months = dataset_source_map(df, calendar, policy, date_column)
    return dated.join(F.broadcast(months), "source_date").drop("source_date")


def source_slices(
    df: DataFrame,
    served: DataFrame,
    date_column: str = DATE_COLUMN,
) -> DataFrame:
    """Rows of every source date that serves some month, each once.

    ``served`` is a source map.  The map, not the rows, carries the fan-out to
    months, so a fallback date is stored and cleaned a single time.
    """
    dates = served.select("source_date").distinct()
    dated = with_normalized_date(df, date_column).withColumn(
        "source_date", snapshot_day(F.col(date_column))
    )
    return dated.join(F.broadcast(dates), "source_date", "left_semi")


def with_bronze_lineage(
    df: DataFrame, source_file: str | Column, processing_date: Column
) -> DataFrame:
    """Ingestion time, source file and processing date of every row."""
    source = F.lit(source_file) if isinstance(source_file, str) else source_file
    return df.withColumns(
        {
            "bronze_ingestion_timestamp": F.current_timestamp(),
            "bronze_source_file": source,
            "bronze_processing_date": iso_text(processing_date),
        }
    )
