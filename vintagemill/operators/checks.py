"""Store validation: summaries, customer overlap, leakage and schema previews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FEATURE_MOB, OVERLAP_GATE
from ..functions.arithmetic import flag
from .store import Snapshots

# The columns shown of a store.
PREVIEW_COLUMNS = (
    "Customer_ID",
    "snapshot_date",
    "num_active_loans_at_application",
    "annual_income",
    "customer_age",
)


def store_summary(stores: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and distinct customers of each store.

    Rows are folded to one per customer first, which keeps a hot customer cheap.
    """

    def of(name: str, df: DataFrame) -> DataFrame:
        per_customer = df.groupBy("Customer_ID").agg(F.count(F.lit(1)).alias("rows"))
        return per_customer.agg(
            F.lit(name).alias("store"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.lit(len(df.columns)).alias("columns"),
            F.count(F.lit(1)).alias("customers"),
        )

    return reduce(DataFrame.unionByName, [of(name, df) for name, df in stores.items()])


def preview(df: DataFrame, n: int = 5, columns: Sequence[str] = PREVIEW_COLUMNS) -> DataFrame:
    """``n`` rows of the well-known columns that exist, the first in the order of these columns."""
    shown = df.select(*[c for c in columns if c in df.columns])
    return shown.orderBy(*[F.col(c).asc_nulls_last() for c in shown.columns]).limit(n)


def schema_preview(df: DataFrame, n: int | None = None) -> DataFrame:
    """Columns in name order with type and number of filled rows: all, or the first ``n``."""
    fields = sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields)[:n]
    filled = df.agg(*[F.count(F.col(name)).alias(name) for name, _ in fields])
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col(name).alias("filled"),
        )
        for i, (name, kind) in enumerate(fields, start=1)
    ]
    return filled.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def customer_overlap(
    features: DataFrame, labels: DataFrame, gate: float = OVERLAP_GATE
) -> DataFrame:
    """Customers of the feature store, of the label store, and of both.

    One aggregation over tagged customers takes the place of an intersection and
    two distinct counts.  ``ready`` holds when the overlap exceeds the gate.
    """
    tagged = features.select("Customer_ID", F.lit(1).alias("f"), F.lit(0).alias("l")).unionByName(
        labels.select("Customer_ID", F.lit(0).alias("f"), F.lit(1).alias("l"))
    )
    per_customer = tagged.groupBy("Customer_ID").agg(F.max("f").alias("f"), F.max("l").alias("l"))

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    share = F.col("overlap") / F.greatest("feature_customers", F.lit(1))
    return per_customer.agg(
        total(F.col("f")).alias("feature_customers"),
        total(F.col("l")).alias("label_customers"),
        total(F.col("f") * F.col("l")).alias("overlap"),
    ).withColumns({"overlap_share": share, "ready": share > gate})


def leakage_check(
    feature_loans: DataFrame,
    label_loans: DataFrame,
    sources: dict[str, DataFrame],
    mob: int = FEATURE_MOB,
) -> DataFrame:
    """Count rows that break the time separation of features and labels.

    ``feature_loans`` are the loan rows behind the features, all to be at
    ``mob``; ``label_loans`` those behind the labels, none before month-on-book
    1.  ``sources`` are frames of ``processing_date``, ``snapshot_date`` and
    ``rows`` per dataset; a snapshot later than its month looks ahead.
    """

    def of(name: str, df: DataFrame, broken: Column, weight: Column) -> DataFrame:
        return df.agg(
            F.lit(name).alias("check"),
            F.coalesce(F.sum(weight), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(flag(broken) * weight), F.lit(0)).alias("violations"),
        )

    one = F.lit(1)
    checks = [
        of("features at mob", feature_loans, ~(F.col("mob") == mob), one),
        of("labels after application", label_loans, F.col("mob") < 1, one),
    ]
    late = F.col("snapshot_date") > F.col("processing_date")
    checks += [of(f"{name} not ahead", df, late, F.col("rows")) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, checks).withColumn("passed", F.col("violations") == 0)


def source_usage(dataset: Snapshots) -> DataFrame:
    """Rows each month takes from a dataset, with the date they come from.

    Rows are counted per date before a month map fans them out.
    """
    counted = F.count(F.lit(1)).alias("rows")
    if dataset.served is None:
        return dataset.frame.groupBy("processing_date", "snapshot_date").agg(counted)
    per_date = dataset.frame.groupBy("source_date").agg(counted)
    return dataset.served.join(F.broadcast(per_date), "source_date").select(
        "processing_date", F.col("source_date").alias("snapshot_date"), "rows"
    )
