"""Profiling datasets: the numbers behind each data-quality chart and insight."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arithmetic import equal_width_bucket, flag, percent
from .quantiles import exact_medians

MONTH_LABEL = "MMM yyyy"

# Fixed thresholds and plausible ranges of the financial profile.
HIGH_DTI = 0.43
HEALTHY_UTILIZATION = 30
HIGH_UTILIZATION = 70
DTI_RANGE = (0.0, 2.0)
UTILIZATION_RANGE = (0.0, 100.0)
# Right-closed debt-to-income bins above zero, with the score each stands for.
DTI_BINS = (
    (0.3, "Excellent (5)"),
    (0.5, "Good (4)"),
    (0.7, "Fair (3)"),
    (1.0, "Poor (2)"),
    (float("inf"), "Critical (1)"),
)


def with_month_label(df: DataFrame, day: str = "snapshot_date") -> DataFrame:
    """Add ``data_month``, such as ``Jan 2023``."""
    return df.withColumn("data_month", F.date_format(day, MONTH_LABEL))


def missing_counts(
    datasets: dict[str, DataFrame], month: str = "snapshot_date"
) -> DataFrame:
    """Missing values (``nulls``) and values in all (``cells``) by dataset and month.

    Nulls are counted per row and summed, so each dataset takes one pass and one
    small aggregation.
    """

    def of(name: str, df: DataFrame) -> DataFrame:
        nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in df.columns])
        per_month = df.groupBy(month).agg(
            F.sum(nulls).alias("nulls"), F.count(F.lit(1)).alias("rows")
        )
        cells = F.col("rows") * len(df.columns)
        return per_month.select(F.lit(name).alias("dataset"), month, "nulls", cells.alias("cells"))

    return reduce(DataFrame.unionByName, [of(name, df) for name, df in datasets.items()])


def missing_pct(
    datasets: dict[str, DataFrame], month: str = "snapshot_date"
) -> DataFrame:
    """Average percentage of missing values over all columns, by dataset and month."""
    return missing_counts(datasets, month).select(
        "dataset", month, percent(F.col("nulls"), F.col("cells")).alias("missing_pct")
    )


def month_labels(start: dt.date, end: dt.date) -> list[str]:
    """Labels of the months from that of ``start`` to that of ``end``, in order."""
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [dt.date(m // 12, m % 12 + 1, 1).strftime("%b %Y") for m in range(first, last + 1)]


def missing_pct_pivot(
    counts: DataFrame, labels: Sequence[str], month: str = "snapshot_date"
) -> DataFrame:
    """One row per dataset, one column per month label, from ``missing_counts``.

    Days of one month are summed.  The labels are given, not looked up, so no job
    reads the data first; a day of another month, or of none, is an error, not a loss.
    """
    label = F.date_format(month, MONTH_LABEL)
    outside = F.raise_error(F.concat(F.lit("month outside the pivot: "), F.coalesce(label, F.lit("none"))))
    labelled = counts.withColumn("label", F.when(label.isin(*labels), label).otherwise(outside))
    shares = percent(F.sum("nulls"), F.sum("cells"))
    return labelled.groupBy("dataset").pivot("label", list(labels)).agg(shares)


def validity_share(
    df: DataFrame, flag_column: str = "SSN_is_valid", month: str = "snapshot_date"
) -> DataFrame:
    """Proportions of invalid and valid rows by month; null flags are left out."""
    valid, known = F.sum(flag(F.col(flag_column))), F.count(flag_column)
    invalid = F.sum(flag(~F.col(flag_column)))
    return (
        df.groupBy(month)
        .agg(
            F.try_divide(invalid, known).alias("invalid_share"),
            F.try_divide(valid, known).alias("valid_share"),
        )
        .where("valid_share is not null")
    )


def invalid_rate(df: DataFrame, flag_column: str = "SSN_is_valid") -> DataFrame:
    """Percentage of rows whose flag is false, among rows with a flag."""
    invalid = F.sum(flag(~F.col(flag_column)))
    return df.agg(percent(invalid, F.count(flag_column)).alias("invalid_pct"))


def applications_by_month(applications: DataFrame, month: str = "snapshot_date") -> DataFrame:
    return applications.groupBy(month).agg(F.count("loan_id").alias("applications"))


def application_rate(applications: DataFrame, month: str = "snapshot_date") -> DataFrame:
    """Applications per month that has any; months are counted after pre-aggregation."""
    per_month = applications.groupBy(month).agg(F.count(F.lit(1)).alias("rows"))
    total, months = F.sum("rows"), F.count(month)
    return per_month.agg(
        total.alias("applications"),
        months.alias("months"),
        F.try_divide(total, months).alias("applications_per_month"),
    )


def tenure_counts(applications: DataFrame) -> DataFrame:
    known = applications.where("tenure is not null")
    return known.groupBy("tenure").agg(F.count(F.lit(1)).alias("applications")).orderBy("tenure")


def tenure_mode(applications: DataFrame) -> DataFrame:
    """The most common tenure, the smallest on ties."""
    ranked = F.max(F.struct("applications", (-F.col("tenure")).alias("minus_tenure")))
    top = tenure_counts(applications).agg(ranked.alias("top"))
    return top.select((-F.col("top.minus_tenure")).alias("tenure_mode"))


def multi_application_share(applications: DataFrame) -> DataFrame:
    """Customers with one and with several applications, and the share of the latter."""
    per_customer = (
        applications.where("Customer_ID is not null")
        .groupBy("Customer_ID")
        .agg(F.count(F.lit(1)).alias("applications"))
    )
    single, multi = F.col("applications") == 1, F.col("applications") > 1
    return per_customer.agg(
        F.coalesce(F.sum(flag(single)), F.lit(0)).alias("single_customers"),
        F.coalesce(F.sum(flag(multi)), F.lit(0)).alias("multi_customers"),
        percent(F.sum(flag(multi)), F.count(F.lit(1))).alias("multi_pct"),
    )


def customers_across_sources(*sources: DataFrame) -> DataFrame:
    """Distinct non-null customers over several tables."""
    ids = [df.select("Customer_ID").where("Customer_ID is not null") for df in sources]
    distinct = reduce(DataFrame.union, ids).distinct()
    return distinct.agg(F.count(F.lit(1)).alias("customers"))


def balance_sample(applications: DataFrame, n: int = 1000) -> DataFrame:
    """Up to ``n`` pairs of loan amount and balance, picked by a hash of the loan id.

    The order is fixed, so a rerun gives the same sample, and only the first
    ``n`` rows of each task move.
    """
    pairs = applications.dropna(subset=["loan_amt", "balance"])
    return (
        pairs.orderBy(F.md5("loan_id"), "loan_id", "loan_amt", "balance")
        .limit(n)
        .select("loan_id", "loan_amt", "balance")
    )


def histogram(values: DataFrame, bins: dict[str, int]) -> DataFrame:
    """Equal-width histograms of a long frame (``metric``, ``value``), empty buckets included.

    The edges span each metric's range; a metric with a single value gets a
    range of one around it.  Ranges hold one row per metric.
    """
    sizes = F.create_map(*[F.lit(x) for pair in bins.items() for x in pair])
    spans = (
        values.groupBy("metric")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
        .withColumn("pad", F.when(F.col("low") == F.col("high"), 0.5).otherwise(0.0))
        .select(
            "metric",
            (F.col("low") - F.col("pad")).alias("low"),
            (F.col("high") + F.col("pad")).alias("high"),
            sizes[F.col("metric")].alias("bins"),
        )
    )
    spread = F.col("high") - F.col("low")
    bucket = equal_width_bucket(F.col("value"), F.col("low"), F.col("high"), F.col("bins"))
    counts = (
        values.join(F.broadcast(spans), "metric")
        .groupBy("metric", bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    buckets = spans.withColumn("bucket", F.explode(F.sequence(F.lit(1), F.col("bins"))))

    def edge(i: Column) -> Column:
        return F.col("low") + spread * i / F.col("bins")

    return buckets.join(counts, ["metric", "bucket"], "left").select(
        "metric",
        "bucket",
        edge(F.col("bucket") - 1).alias("low"),
        edge(F.col("bucket")).alias("high"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def in_ranges(values: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Keep the values of a long frame that lie in their metric's plausible range."""
    keep = F.lit(False)
    for metric, (low, high) in ranges.items():
        keep = keep | ((F.col("metric") == metric) & F.col("value").between(low, high))
    return values.where(keep)


def column_stats(values: DataFrame) -> DataFrame:
    """Count, minimum, maximum, mean and exact median per metric of a long frame."""
    moments = values.groupBy("metric").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("mean"),
    )
    return moments.join(F.broadcast(exact_medians(values)), "metric")


def threshold_share(df: DataFrame, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """Per rule ``name: (column, condition)``: rows that meet it, and their share of non-null ones.

    All rules share one pass.
    """
    aggregates, lines = [], []
    for name, (column, condition) in rules.items():
        known = F.col(column).isNotNull()
        aggregates.append(F.sum(flag(known & condition)).alias(f"{name}_rows"))
        aggregates.append(F.count(column).alias(f"{name}_n"))
        rows, n = F.col(f"{name}_rows"), F.col(f"{name}_n")
        lines.append(
            F.struct(
                F.lit(name).alias("metric"),
                F.coalesce(rows, F.lit(0)).alias("rows"),
                percent(rows, n).alias("pct"),
            )
        )
    totals = df.agg(*aggregates)
    return totals.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def dti_bucket_counts(financials: DataFrame) -> DataFrame:
    """Customers per debt-to-income bin; ratios of zero and below fall in none."""
    dti = F.col("debt_to_income_ratio")
    label = F.when(dti <= 0, None)
    for bound, name in DTI_BINS:
        label = label.when(dti <= bound, name)
    binned = financials.where("debt_to_income_ratio > 0").groupBy(label.alias("health_score"))
    counts = binned.agg(F.count(F.lit(1)).alias("rows"))
    names = F.explode(F.array(*[F.lit(name) for _, name in DTI_BINS])).alias("health_score")
    every = financials.sparkSession.range(1).select(names)
    return every.join(F.broadcast(counts), "health_score", "left").select(
        "health_score", F.coalesce("rows", F.lit(0)).alias("rows")
    )
