"""Run constants and the registry of source datasets."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Fixed values of the run: backfill range, feature and label definition.
BACKFILL_START = "2023-01-01"
BACKFILL_END = "2024-12-01"
FEATURE_MOB = 0
LABEL_MOB = 6
DPD_THRESHOLD = 30
FEATURE_STORE_VERSION = "1.0"
OVERLAP_GATE = 0.8

# What a month without rows of its own takes.
SKIP = "skip"                        # nothing: the month is left out
LATEST_OVERALL = "latest_overall"    # the newest date of all, even a later one
LATEST_AS_OF = "latest_as_of"        # the newest date up to the month
FALLBACK_POLICIES = (SKIP, LATEST_OVERALL, LATEST_AS_OF)


@dataclass(frozen=True)
class DatasetSpec:
    """One source dataset: where it lies and how its months are picked."""

    name: str
    source_file: str
    date_column: str | None = "snapshot_date"
    fallback: str = SKIP


DATASETS = {
    spec.name: spec
    for spec in (
        DatasetSpec("loans", "lms_loan_daily.csv"),
        DatasetSpec("financials", "features_financials.csv"),
        DatasetSpec("attributes", "features_attributes.csv"),
        DatasetSpec("clickstream", "feature_clickstream.csv", fallback=LATEST_OVERALL),
    )
}


def parse_snapshot_date(text: str) -> dt.date:
    """Read a date argument: ISO first, then month/day/year."""
    for pattern in ("%Y-%m-%d", "%m/%d/%Y"):
        try:
            return dt.datetime.strptime(text, pattern).date()
        except ValueError:
            continue
    raise ValueError(f"snapshot date {text!r} is neither YYYY-MM-DD nor M/D/YYYY")
