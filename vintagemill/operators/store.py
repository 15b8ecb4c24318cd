"""The feature spine and the joined feature store, all months at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import FEATURE_MOB, FEATURE_STORE_VERSION
from ..functions.parsing import iso_text
from ..schemas import empty_silver
from .features import (
    KEYS,
    LOAN_PARTIALS,
    attribute_features,
    clickstream_features,
    financial_features,
    loan_feature_columns,
    loan_partials,
    mob_filter,
)
from .joins import split_left_joins

SPINE = (*KEYS, "snapshot_date")


@dataclass(frozen=True)
class Snapshots:
    """A silver dataset and the months it serves.

    Without ``served`` the frame carries ``processing_date``.  With it the frame
    carries ``source_date`` and ``served`` maps each month to one of those, so a
    date that serves many months is held once.
    """

    frame: DataFrame
    served: DataFrame | None = None

    @property
    def month_key(self) -> str:
        return "processing_date" if self.served is None else "source_date"

    def months(self) -> DataFrame:
        months = self.frame if self.served is None else self.served
        return months.select("processing_date").distinct()

    def only(self, months: Sequence) -> Snapshots:
        """The rows that serve some of the given months, picked by partition; the months are few."""
        wanted = F.col("processing_date").isin(*months) if months else F.lit(False)
        if self.served is None:
            return Snapshots(self.frame.where(wanted))
        served = self.served.where(wanted)
        dates = F.broadcast(served.select("source_date"))
        return Snapshots(self.frame.join(dates, "source_date", "left_semi"), served)

    def in_months(self, months: DataFrame) -> DataFrame:
        """Rows for the given months (one row per month, so the broadcast is bounded)."""
        if self.served is None:
            return self.frame.join(F.broadcast(months), "processing_date", "left_semi")
        wanted = self.served.join(F.broadcast(months), "processing_date", "left_semi")
        return self.frame.join(F.broadcast(wanted), "source_date")


def as_snapshots(spark: SparkSession, dataset: str, given: DataFrame | Snapshots | None) -> Snapshots:
    if given is None:
        return Snapshots(empty_silver(spark, dataset))
    return given if isinstance(given, Snapshots) else Snapshots(given)


def _months_by_rank(loans: DataFrame, fallbacks: Sequence[Snapshots], mob: int) -> dict[int, list]:
    """The months of the spine by what serves them: 0 for loans at ``mob``, then the first dataset with any rows.

    They are settled up front, a row per month, so the plan of the spine reads
    only the datasets that serve some month, and none of them twice.
    """
    ranked = mob_filter(loans, mob).select("processing_date", F.lit(0).alias("rank")).distinct()
    for rank, dataset in enumerate(fallbacks, start=1):
        ranked = ranked.union(dataset.months().withColumn("rank", F.lit(rank)))
    first = ranked.where("processing_date is not null").groupBy("processing_date").agg(F.min("rank").alias("rank"))
    served: dict[int, list] = {}
    for month, rank in first.collect():
        served.setdefault(rank, []).append(month)
    return {rank: sorted(months) for rank, months in sorted(served.items())}


def _spine_rows(loans: DataFrame, dataset: Snapshots, months: Sequence) -> DataFrame:
    wanted = loans.sparkSession.createDataFrame([(month,) for month in months], "processing_date date")
    return dataset.in_months(wanted).select(*SPINE).distinct()


def _fallback_rows(
    loans: DataFrame, fallbacks: Sequence[Snapshots], mob: int
) -> list[DataFrame]:
    """Spine rows of months without loans at ``mob``, from the first dataset that has any."""
    served = _months_by_rank(loans, fallbacks, mob)
    return [_spine_rows(loans, fallbacks[rank - 1], months) for rank, months in served.items() if rank > 0]


def feature_spine(
    loans: DataFrame | None,
    attributes: DataFrame | Snapshots | None = None,
    financials: DataFrame | Snapshots | None = None,
    clickstream: DataFrame | Snapshots | None = None,
    mob: int = FEATURE_MOB,
) -> DataFrame:
    """Customers to build features for, per month.

    These are the customers of the loans at ``mob``.  A month without such loans
    takes the customers of attributes, else financials, else clickstream.
    """
    loans, *fallbacks = _inputs(loans, attributes, financials, clickstream)
    spine = mob_filter(loans.frame, mob).select(*SPINE).distinct()
    for rows in _fallback_rows(loans.frame, fallbacks, mob):
        spine = spine.unionByName(rows)
    return spine


def _inputs(loans, attributes, financials, clickstream) -> list[Snapshots]:
    given = {
        "loans": loans,
        "attributes": attributes,
        "financials": financials,
        "clickstream": clickstream,
    }
    first = next((g for g in given.values() if g is not None), None)
    if first is None:
        raise ValueError("no dataset to build features from")
    frame = first.frame if isinstance(first, Snapshots) else first
    return [as_snapshots(frame.sparkSession, name, g) for name, g in given.items()]


def spine_with_loan_features(
    loans: DataFrame, fallbacks: Sequence[Snapshots], mob: int
) -> DataFrame:
    """The spine with its loan features, from one pass over the loans.

    Loans are pre-aggregated to spine rows; a customer with several snapshot
    dates in one month merges the partials over a window that holds only those.
    A null customer gets no features, as a join would not match it.
    """
    rows = loan_partials(loans, SPINE, mob)
    for fallback in _fallback_rows(loans, fallbacks, mob):
        rows = rows.unionByName(fallback, allowMissingColumns=True)
    return _with_loan_features(rows)


def _with_loan_features(rows: DataFrame) -> DataFrame:
    month_of_customer = Window.partitionBy(*KEYS)
    merged = rows.withColumns(
        {
            name: merge(name).over(month_of_customer)
            for name, (_, _, merge) in LOAN_PARTIALS.items()
        }
    )
    known = F.col("Customer_ID").isNotNull()
    features = [F.when(known, c).alias(name) for name, c in loan_feature_columns().items()]
    return merged.select(*SPINE, *features)


def resolve_duplicates(df: DataFrame, keys: Sequence[str], on_duplicate: str) -> DataFrame:
    """What several rows of one key do: ``fanout`` keeps all, ``latest`` one, ``error`` fails."""
    if on_duplicate == "fanout":
        return df
    rest = [c for c in df.columns if c not in (*keys, "snapshot_date")]
    newest = F.max(F.struct("snapshot_date", *rest))
    if on_duplicate == "error":
        message = F.concat(F.lit("several rows for "), F.concat_ws("/", *keys))
        newest = F.when(F.count(F.lit(1)) > 1, F.raise_error(message)).otherwise(newest)
    elif on_duplicate != "latest":
        raise ValueError(f"unknown duplicate rule {on_duplicate!r}")
    kept = df.where(F.col("Customer_ID").isNotNull()).groupBy(*keys).agg(newest.alias("_row"))
    return kept.select(*keys, "_row.*")


def feature_store(
    loans: DataFrame | None,
    financials: DataFrame | Snapshots | None = None,
    attributes: DataFrame | Snapshots | None = None,
    clickstream: DataFrame | Snapshots | None = None,
    mob: int = FEATURE_MOB,
    on_duplicate: str = "fanout",
    ratio: str = "signed",
    rows_per_split: int | None = 1_000_000,
    co_located: bool = False,
) -> DataFrame:
    """Spine LEFT JOIN loan, financial, attribute and clickstream features.

    Joins match month and customer.  The columns are the same whichever dataset
    is absent; an absent one contributes nulls.  ``co_located`` is for inputs that are laid out by
    customer: a union forgets that layout, so months with loans and months of each fallback are
    joined apart, each with its own months of the other sides, and come together at the end.
    """
    loan_rows, attributes, financials, clickstream = _inputs(
        loans, attributes, financials, clickstream
    )
    builders = (
        (financials, financial_features),
        (attributes, attribute_features),
        (clickstream, lambda df, keys: clickstream_features(df, keys, ratio)),
    )
    fallbacks = (attributes, financials, clickstream)
    if on_duplicate != "fanout":
        rows_per_split = None
    if not co_located:
        spine = spine_with_loan_features(loan_rows.frame, fallbacks, mob)
        return _with_features(spine, builders, on_duplicate, rows_per_split)
    # Loans without a month have no right sides, but stay rows of the spine.
    own = _with_loan_features(loan_partials(loan_rows.frame, SPINE, mob))
    served = {0: []} | _months_by_rank(loan_rows.frame, fallbacks, mob)
    parts = []
    for rank, months in served.items():
        spine = own
        if rank > 0:
            absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in own.schema.fields if f.name not in SPINE]
            spine = _spine_rows(loan_rows.frame, fallbacks[rank - 1], months).select(*SPINE, *absent)
        sides = [(dataset.only(months), build) for dataset, build in builders]
        parts.append(_with_features(spine, sides, on_duplicate, rows_per_split))
    return reduce(DataFrame.unionByName, parts)


def _with_features(
    store: DataFrame, builders: Sequence[tuple], on_duplicate: str, rows_per_split: int | None
) -> DataFrame:
    """A spine joined with the features of each side."""
    waiting: list[DataFrame] = []
    for dataset, build in builders:
        keys = (dataset.month_key, "Customer_ID")
        features = build(resolve_duplicates(dataset.frame, keys, on_duplicate), keys)
        if dataset.served is None:
            # Sides that match the month itself share one shuffle of the spine.
            waiting.append(features)
            continue
        store, waiting = split_left_joins(store, waiting, KEYS, rows_per_split), []
        store = store.join(F.broadcast(dataset.served), "processing_date", "left")
        store = split_left_joins(store, [features], keys, rows_per_split).drop("source_date")
    return split_left_joins(store, waiting, KEYS, rows_per_split)


def with_gold_metadata(
    df: DataFrame,
    processing_date: Column,
    mob: int = FEATURE_MOB,
    version: str = FEATURE_STORE_VERSION,
) -> DataFrame:
    return df.withColumns(
        {
            "gold_processing_timestamp": F.current_timestamp(),
            "gold_processing_date": iso_text(processing_date),
            "feature_store_version": F.lit(version),
            "feature_mob": F.lit(mob),
        }
    )
