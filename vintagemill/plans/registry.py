"""The registered queries: every operator over whole tables of a star-schema folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (
    DATASETS,
    FALLBACK_POLICIES,
    FEATURE_MOB,
    LABEL_MOB,
    LATEST_AS_OF,
    LATEST_OVERALL,
)
from ..functions.parsing import snapshot_day
from ..operators import asof, bronze, calendar, changes, checks, features, labels, profiling, silver, store, vintage
from ..operators.quantiles import in_long_form
from ..operators.store import Snapshots
from ..schemas import LOANS_TYPED
from ..sources import files, quarantine, star
from . import arrival, backfill

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the single-month and cohort queries.
ONE_MONTH = dt.date(1997, 3, 1)
COHORT_CUTOFF = dt.date(1998, 1, 1)
LAST_RERUN = dt.date(2000, 1, 1)
LAST_INSTALLMENT = star.LAST_INSTALLMENT
CLICK_KEYS = ("snapshot_date", "Customer_ID")

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _months(spark, d):
    """Every month a loan may report in."""
    return calendar.calendar_of(star.loan_bounds(spark, d))


def _clean(name, spark, d):
    return silver.CLEANERS[name](star.RAW[name](spark, d))


def _monthly(name, spark, d):
    """A cleaned dataset whose rows serve the month they are dated."""
    dated = _clean(name, spark, d).where("snapshot_date is not null")
    return dated.withColumn("processing_date", F.col("snapshot_date"))


def _served_clickstream(spark, d, policy=LATEST_OVERALL):
    raw = star.clickstream(spark, d)
    frame = silver.silver_clickstream(raw).withColumn("source_date", F.col("snapshot_date"))
    return Snapshots(frame, bronze.dataset_source_map(raw, _months(spark, d), policy))


def _applications(spark, d):
    return features.mob_filter(_clean("loans", spark, d))


def _inputs(spark, d):
    return {
        "loans": _monthly("loans", spark, d),
        "financials": _monthly("financials", spark, d),
        "attributes": _monthly("attributes", spark, d),
        "clickstream": _served_clickstream(spark, d),
    }


# --- loans and labels


@query
def silver_loans(spark, d):
    return _clean("loans", spark, d)


@query
def silver_loans_small(spark, d):
    return silver.silver_loans_small(star.loans(spark, d))


@query
def dpd(spark, d):
    return _clean("loans", spark, d).select(
        "loan_id", "snapshot_date", "mob", "installments_missed", "first_missed_date", "dpd"
    )


@query
def mob_filter(spark, d):
    return features.mob_filter(_clean("loans", spark, d), FEATURE_MOB)


@query
def label_within_window(spark, d):
    return labels.label_within_window(_clean("loans", spark, d))


@query
def label_ever_in_window(spark, d):
    return labels.label_within_window(_clean("loans", spark, d), scope="loan")


@query
def label_at_mob(spark, d):
    return labels.label_at_mob(_clean("loans", spark, d))


@query
def label_at_mob_small(spark, d):
    return labels.label_at_mob_small(silver.silver_loans_small(star.loans(spark, d)))


@query
def label_distribution(spark, d):
    return labels.label_distribution(labels.label_within_window(_clean("loans", spark, d)))


# --- vintage


@query
def cohort_filter(spark, d):
    return vintage.cohort_filter(_clean("loans", spark, d), COHORT_CUTOFF)


@query
def matured_loans(spark, d):
    return vintage.matured_loans(_clean("loans", spark, d), LAST_INSTALLMENT)


@query
def bad_rate_rows(spark, d):
    return vintage.bad_rate_rows(vintage.cohort_filter(_clean("loans", spark, d), COHORT_CUTOFF))


@query
def bad_rate_loans(spark, d):
    return vintage.bad_rate_loans(_clean("loans", spark, d))


@query
def bad_rate_by_cohort(spark, d):
    cohorts = _clean("loans", spark, d).withColumn("cohort", F.trunc("loan_start_date", "MM"))
    return vintage.bad_rate_mom(vintage.bad_rate_loans(cohorts, by=["cohort"]), by=["cohort"])


@query
def bad_rate_mom(spark, d):
    return vintage.bad_rate_mom(bad_rate_loans(spark, d))


@query
def bad_rate_growth(spark, d):
    return vintage.bad_rate_growth(bad_rate_loans(spark, d))


@query
def bad_rate_stabilization(spark, d):
    return vintage.bad_rate_stabilization(bad_rate_loans(spark, d))


@query
def bad_rate_peak_change(spark, d):
    return vintage.bad_rate_peak_change(bad_rate_loans(spark, d))


# --- cleaned customer datasets


@query
def silver_attributes(spark, d):
    return _clean("attributes", spark, d)


@query
def silver_financials(spark, d):
    return _clean("financials", spark, d)


@query
def silver_clickstream(spark, d):
    return _clean("clickstream", spark, d)


@query
def optional_columns(spark, d):
    """The attribute cleaner on a source without ages and occupations."""
    return silver.silver_attributes(star.attributes(spark, d).drop("Age", "Occupation"))


# --- features


@query
def feat_loan_application(spark, d):
    return features.loan_application_features(_monthly("loans", spark, d))


@query
def feat_financial(spark, d):
    return features.financial_features(_monthly("financials", spark, d))


@query
def feat_attribute(spark, d):
    return features.attribute_features(_monthly("attributes", spark, d))


@query
def feat_clickstream(spark, d):
    return features.clickstream_features(_clean("clickstream", spark, d), CLICK_KEYS)


@query
def feat_clickstream_magnitude(spark, d):
    return features.clickstream_features(
        _clean("clickstream", spark, d), CLICK_KEYS, ratio="magnitude"
    )


@query
def feature_spine(spark, d):
    return store.feature_spine(**_inputs(spark, d))


@query
def feature_store(spark, d):
    return store.feature_store(**_inputs(spark, d))


@query
def feature_store_hot(spark, d):
    """The store where customers report attributes several times a month and every key above one row is split."""
    inputs = _inputs(spark, d)
    attributes = inputs["attributes"]
    twice = attributes.where(F.col("Customer_ID").endswith("1"))
    thrice = attributes.where(F.col("Customer_ID").endswith("11"))
    inputs["attributes"] = attributes.unionByName(twice).unionByName(thrice)
    return store.feature_store(**inputs, rows_per_split=1)


@query
def feature_spine_fallback(spark, d):
    """Months after the loans end take the customers of attributes, then those of financials."""
    inputs = _inputs(spark, d)
    until = {"loans": dt.date(1997, 1, 1), "attributes": COHORT_CUTOFF, "financials": LAST_RERUN}
    cut = {name: inputs[name].where(F.col("processing_date") < day) for name, day in until.items()}
    return store.feature_spine(**cut)


def _asof_store(spark, d):
    datasets = {name: _clean(name, spark, d) for name in ("financials", "attributes", "clickstream")}
    return asof.feature_store_asof(_monthly("loans", spark, d), **datasets)


@query
def feature_store_asof(spark, d):
    """Every customer's latest record up to the month; the clickstream's month comes long after the others."""
    return _asof_store(spark, d)


# --- profiling


@query
def applications_by_month(spark, d):
    return profiling.applications_by_month(_applications(spark, d))


@query
def application_rate(spark, d):
    return profiling.application_rate(_applications(spark, d))


@query
def tenure_counts(spark, d):
    return profiling.tenure_counts(_applications(spark, d))


@query
def tenure_mode(spark, d):
    return profiling.tenure_mode(_applications(spark, d))


@query
def multi_application_share(spark, d):
    return profiling.multi_application_share(_applications(spark, d))


@query
def balance_sample(spark, d):
    return profiling.balance_sample(_applications(spark, d))


@query
def validity_share(spark, d):
    return profiling.validity_share(_monthly("attributes", spark, d), month="processing_date")


@query
def invalid_rate(spark, d):
    return profiling.invalid_rate(_clean("attributes", spark, d))


@query
def customers_across_sources(spark, d):
    return profiling.customers_across_sources(
        _clean("attributes", spark, d), _clean("financials", spark, d), _applications(spark, d)
    )


def _missing(spark, d):
    return {
        "Attributes": _monthly("attributes", spark, d),
        "Financials": _monthly("financials", spark, d),
        "Loans MOB=0": features.mob_filter(_monthly("loans", spark, d)),
    }


@query
def missing_pct(spark, d):
    return profiling.missing_pct(_missing(spark, d), "processing_date")


@query
def missing_pct_pivot(spark, d):
    labels = profiling.month_labels(star.FIRST_MONTH, star.LAST_MONTH)
    counts = profiling.missing_counts(_missing(spark, d), "processing_date")
    return profiling.missing_pct_pivot(counts, labels, "processing_date")


def _profile_values(spark, d):
    """Long frame of the profiled numbers of all three datasets."""
    return (
        in_long_form(_clean("attributes", spark, d), ["Age"])
        .unionByName(
            in_long_form(
                _clean("financials", spark, d),
                ["Annual_Income", "debt_to_income_ratio", "Credit_Utilization_Ratio"],
            )
        )
        .unionByName(in_long_form(_applications(spark, d), ["loan_amt", "tenure"]))
    )


@query
def column_stats(spark, d):
    stats = profiling.column_stats(_profile_values(spark, d))
    return stats.withColumn("mean", F.round("mean", 6))


@query
def hist_equal_width(spark, d):
    bins = {"Age": 30, "loan_amt": 40, "Annual_Income": 40}
    values = (
        in_long_form(_clean("attributes", spark, d), ["Age"])
        .unionByName(in_long_form(_clean("financials", spark, d), ["Annual_Income"]))
        .unionByName(in_long_form(_applications(spark, d), ["loan_amt"]))
    )
    return profiling.histogram(values, bins)


@query
def range_filtered_hist(spark, d):
    bins = {"debt_to_income_ratio": 40, "Credit_Utilization_Ratio": 30}
    ranges = {
        "debt_to_income_ratio": profiling.DTI_RANGE,
        "Credit_Utilization_Ratio": profiling.UTILIZATION_RANGE,
    }
    values = in_long_form(_clean("financials", spark, d), list(bins))
    return profiling.histogram(profiling.in_ranges(values, ranges), bins)


@query
def threshold_share(spark, d):
    dti, used = F.col("debt_to_income_ratio"), F.col("Credit_Utilization_Ratio")
    of_financials = profiling.threshold_share(
        _clean("financials", spark, d),
        {
            "high_dti": ("debt_to_income_ratio", dti > profiling.HIGH_DTI),
            "healthy_utilization": (
                "Credit_Utilization_Ratio",
                used <= profiling.HEALTHY_UTILIZATION,
            ),
            "high_utilization": ("Credit_Utilization_Ratio", used > profiling.HIGH_UTILIZATION),
        },
    )
    high_value = F.col("loan_amt") >= features.HIGH_VALUE_AMOUNT
    of_loans = profiling.threshold_share(
        _applications(spark, d), {"high_value": ("loan_amt", high_value)}
    )
    return of_financials.unionByName(of_loans)


@query
def dti_bucket_counts(spark, d):
    return profiling.dti_bucket_counts(_clean("financials", spark, d))


# --- calendar and bronze


@query
def month_calendar(spark, d):
    return _months(spark, d)


@query
def missing_months(spark, d):
    """Calendar months that a dataset has no rows for, per dataset."""
    months, result = _months(spark, d), None
    for name in DATASETS:
        missing = calendar.missing_months(months, _monthly(name, spark, d))
        one = missing.select(F.lit(name).alias("dataset"), "processing_date")
        result = one if result is None else result.unionByName(one)
    return result


@query
def date_normalize(spark, d):
    return bronze.with_normalized_date(star.attributes(spark, d)).select(
        "Customer_ID", "snapshot_date", "normalized_snapshot_date"
    )


@query
def sample_dates(spark, d):
    return bronze.sample_dates(star.attributes(spark, d))


@query
def latest_date(spark, d):
    return bronze.latest_date(star.clickstream(spark, d), snapshot_day(F.col("snapshot_date")))


@query
def latest_fallback(spark, d):
    """Rows and source date of each month's clickstream slice under every policy."""
    result = None
    for policy in FALLBACK_POLICIES:
        used = checks.source_usage(_served_clickstream(spark, d, policy))
        one = used.select(
            F.lit(policy).alias("policy"),
            "processing_date",
            F.col("snapshot_date").alias("source_date"),
            "rows",
        )
        result = one if result is None else result.unionByName(one)
    return result


@query
def snapshot_slice(spark, d):
    return bronze.slice_month(star.attributes(spark, d), ONE_MONTH)


@query
def snapshot_slice_typed(spark, d):
    return bronze.slice_month_typed(silver.typed_loans(star.loans(spark, d)), ONE_MONTH)


@query
def undated_passthrough(spark, d):
    return bronze.undated(star.table(spark, d, "customer"), ONE_MONTH)


@query
def bronze_slice(spark, d):
    return bronze.slice_months(star.attributes(spark, d), _months(spark, d))


@query
def bronze_slice_fallback(spark, d):
    return bronze.slice_months(star.clickstream(spark, d), _months(spark, d), LATEST_OVERALL)


@query
def meta_bronze(spark, d):
    sliced = bronze.slice_months(star.loans(spark, d), _months(spark, d))
    source_file = DATASETS["loans"].source_file
    lined = bronze.with_bronze_lineage(sliced, source_file, F.col("processing_date"))
    return lined.select(
        "loan_id", "snapshot_date", "bronze_source_file", "bronze_processing_date"
    )


@query
def meta_silver(spark, d):
    stamped = silver.with_silver_metadata(_monthly("loans", spark, d), F.col("processing_date"))
    return stamped.select("loan_id", "snapshot_date", "silver_processing_date")


@query
def meta_gold(spark, d):
    spine = store.feature_spine(**_inputs(spark, d))
    return store.with_gold_metadata(spine, F.col("processing_date")).drop(
        "gold_processing_timestamp"
    )


# --- validation


@query
def store_summary(spark, d):
    return checks.store_summary(
        {"features": feature_store(spark, d), "labels": label_within_window(spark, d)}
    )


@query
def ml_overlap(spark, d):
    return checks.customer_overlap(feature_spine(spark, d), label_within_window(spark, d))


@query
def leakage_check(spark, d):
    inputs = _inputs(spark, d)
    loans = inputs["loans"]
    usage = {
        name: checks.source_usage(df if isinstance(df, Snapshots) else Snapshots(df))
        for name, df in inputs.items()
    }
    return checks.leakage_check(
        features.mob_filter(loans), loans.where(F.col("mob").between(1, LABEL_MOB)), usage
    )


@query
def leakage_asof(spark, d):
    """The leakage check over the rows that the point-in-time store emits."""
    loans, joined = _monthly("loans", spark, d), _asof_store(spark, d)
    used = {name: asof.records_used(joined, name) for name in ("financials", "attributes", "clickstream")}
    in_window = loans.where(F.col("mob").between(1, LABEL_MOB))
    return checks.leakage_check(features.mob_filter(loans), in_window, used)


@query
def leakage_planted(spark, d):
    """The same check over loans of every age, and over sources that serve the month before."""
    loans = _monthly("loans", spark, d)
    early = F.add_months("snapshot_date", -1)
    ahead = loans.withColumn("processing_date", F.when(F.col("mob") > 3, early).otherwise(F.col("snapshot_date")))
    return checks.leakage_check(loans, loans, {"loans": checks.source_usage(Snapshots(ahead))})


@query
def store_preview(spark, d):
    return checks.preview(_clean("attributes", spark, d), 7, ("Customer_ID", "snapshot_date", "Age"))


@query
def schema_preview(spark, d):
    return checks.schema_preview(_clean("attributes", spark, d))


# --- files: these write below a new scratch folder and read back


@query
def src_csv_string(spark, d):
    path = f"{files.scratch_folder(spark)}/loans_csv"
    files.write_csv(star.loans(spark, d), path)
    return files.read_csv_strings(spark, path)


@query
def src_csv_typed(spark, d):
    path = f"{files.scratch_folder(spark)}/loans_csv"
    columns = LOANS_TYPED.fieldNames()
    files.write_csv(star.loans(spark, d).select(*columns), path)
    return files.read_csv_typed(spark, path, LOANS_TYPED)


def _checked_loans(spark, d):
    """Loans as CSV lines, some of them broken by rule, read with the quarantine into a new table."""
    raw = star.loans(spark, d)
    key = F.substring("loan_id", 2, 20).cast("long") + F.col("installment_num").cast("long")

    def broken(column, rest, text):
        return F.when(F.pmod(key, F.lit(60)) == rest, text).otherwise(F.col(column)).alias(column)

    planted = {
        "tenure": broken("tenure", 1, F.lit("ten")),
        "paid_amt": broken("paid_amt", 2, F.lit("12,5")),
        "snapshot_date": broken("snapshot_date", 3, F.lit("1997-13-01")),
        "Customer_ID": broken("Customer_ID", 4, F.lit(None).cast("string")),
    }
    columns = LOANS_TYPED.fieldNames()
    line = F.to_csv(F.struct(*[planted.get(c, F.col(c)) for c in columns]))
    line = F.when(F.pmod(key, F.lit(60)) == 5, F.concat(line, F.lit(",x"))).otherwise(line)
    line = F.when(F.pmod(key, F.lit(60)) == 6, F.concat("loan_id", F.lit(",x"))).otherwise(line)
    landing, path = files.scratch_folder(spark), f"{files.scratch_folder(spark)}/loans"
    raw.select(line.alias("value")).write.text(landing)
    checked = quarantine.checked_csv(spark, landing, LOANS_TYPED, required=["Customer_ID"], header=False)
    quarantine.write_checked(checked, path)
    return path


@query
def quarantine_rows(spark, d):
    """Every problem of the rows that cannot be read, with the raw line."""
    path = _checked_loans(spark, d)
    return quarantine.problem_rows(quarantine.quarantined(spark, path, LOANS_TYPED))


@query
def quarantine_good(spark, d):
    """The rows beside the quarantine, typed."""
    return quarantine.good_rows(spark, _checked_loans(spark, d), LOANS_TYPED)


@query
def quarantine_counts(spark, d):
    """Problems by column and reason."""
    path = _checked_loans(spark, d)
    return quarantine.problem_counts(quarantine.quarantined(spark, path, LOANS_TYPED))


def _loans_table(spark, d):
    path = f"{files.scratch_folder(spark)}/silver_loans"
    files.write_table(_monthly("loans", spark, d), path, ["processing_date"])
    return files.read_table(spark, path)


@query
def src_snapshot_scan(spark, d):
    return _loans_table(spark, d).where(F.col("processing_date") == F.lit(ONE_MONTH))


@query
def src_all_snapshots(spark, d):
    return _loans_table(spark, d)


@query
def src_month_labelled(spark, d):
    labelled = profiling.with_month_label(_loans_table(spark, d))
    return labelled.select("loan_id", "snapshot_date", "data_month")


def _bronze_store(spark, d, datasets=tuple(DATASETS), **options):
    """A store whose bronze layer holds the given datasets for every month."""
    target = backfill.Store(spark, files.scratch_folder(spark), **options)
    sources = {name: star.RAW[name](spark, d) for name in datasets}
    backfill.run_bronze(target, sources, _months(spark, d))
    return target


def _checked(target):
    """Fail a query whose jobs failed instead of returning half a result."""
    if target.log.failures():
        raise RuntimeError(str(target.log.failures()))
    return target


@query
def backfill_bronze(spark, d):
    target = _checked(_bronze_store(spark, d, ["loans"]))
    return target.months("bronze", "loans").drop("bronze_ingestion_timestamp")


@query
def backfill_features(spark, d):
    """The feature store by way of stored bronze and silver layers."""
    target = _bronze_store(spark, d)
    backfill.run_silver(target)
    backfill.run_features(target)
    return _checked(target).read("gold", "feature_store").drop("gold_processing_timestamp")


@query
def backfill_features_bucketed(spark, d):
    """The feature store joined from a silver layer that is laid out by customer."""
    target = _bronze_store(spark, d, buckets=8)
    backfill.run_silver(target)
    backfill.run_features(target)
    return _checked(target).read("gold", "feature_store").drop("gold_processing_timestamp")


@query
def backfill_labels(spark, d):
    """The label store by way of stored bronze and silver layers."""
    target = _bronze_store(spark, d, ["loans"])
    backfill.run_silver(target)
    backfill.run_labels(target)
    return _checked(target).read("gold", "label_store")


@query
def backfill_labels_loan(spark, d):
    """Labels over all months of a loan, by way of stored bronze and silver layers."""
    target = _bronze_store(spark, d, ["loans"])
    backfill.run_silver(target)
    backfill.run_labels(target, label_type="ever_in_window")
    return _checked(target).read("gold", "loan_label_store")


@query
def backfill_rerun(spark, d):
    """All layers after a second run whose loans lack a month and whose attributes end early."""
    names, months = ["loans", "attributes"], _months(spark, d)
    target = backfill.Store(spark, files.scratch_folder(spark))
    specs = DATASETS | {"attributes": replace(DATASETS["attributes"], fallback=LATEST_AS_OF)}
    loans, attributes = (star.RAW[name](spark, d) for name in names)
    early = snapshot_day(F.col("snapshot_date")) < F.lit(LAST_RERUN)
    less = {
        "loans": loans.where(F.col("snapshot_date") != F.lit(ONE_MONTH.isoformat())),
        "attributes": attributes.where(early),
    }
    for sources in ({"loans": loans, "attributes": attributes}, less):
        backfill.run_bronze(target, sources, months, specs)
        backfill.run_silver(target, names)
        backfill.run_labels(target)
        backfill.run_labels(target, label_type="ever_in_window")
    _checked(target)

    def sizes(layer, name, day, source):
        rows = target.read(layer, name).groupBy(F.col(day).alias("day"), F.col(source).alias("source_date"))
        return rows.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "day", "source_date", "rows"
        )

    stored = [sizes(layer, name, "source_date", "source_date") for layer in ("bronze", "silver") for name in names]
    stored.append(sizes("served", "attributes", "processing_date", "source_date"))
    stored.append(sizes("gold", "label_store", "processing_date", "processing_date"))
    loan_labels = target.read("gold", "loan_label_store").agg(F.count(F.lit(1)).alias("rows"))
    undated = F.lit(None).cast("date")
    stored.append(
        loan_labels.select(
            F.lit("gold").alias("layer"),
            F.lit("loan_label_store").alias("table_name"),
            undated.alias("day"),
            undated.alias("source_date"),
            "rows",
        )
    )
    return reduce(DataFrame.unionByName, stored)


@query
def stream_backfill(spark, d):
    """The bronze loans by way of a stream of files, which runs twice."""
    target, landing = backfill.Store(spark, files.scratch_folder(spark)), files.scratch_folder(spark)
    raw = star.loans(spark, d)
    files.write_csv(raw, landing)
    for _ in range(2):
        arrival.stream_bronze(
            target, "loans", landing, raw.columns, _months(spark, d), f"{target.root}/checkpoint", files_per_batch=3
        )
    return target.months("bronze", "loans").drop("bronze_ingestion_timestamp", arrival.ARRIVAL)


@query
def changed_months(spark, d):
    """Gold months to rebuild after a loan was altered, one moved, and a month of attributes went."""
    months = _months(spark, d)
    target = backfill.Store(spark, files.scratch_folder(spark))
    specs = DATASETS | {"attributes": replace(DATASETS["attributes"], fallback=LATEST_AS_OF)}
    sources = {name: star.RAW[name](spark, d) for name in ("loans", "attributes")}
    backfill.run_bronze(target, sources, months, specs)
    _checked(target)
    backfill.store_fingerprints(target, sources, specs)
    first, last = sources["loans"].agg(F.min("loan_id"), F.max("loan_id")).first()
    month, start = F.col("snapshot_date"), F.col("installment_num") == "0"
    loans = sources["loans"].withColumns(
        {
            "balance": F.when((F.col("loan_id") == first) & start, "1").otherwise(F.col("balance")),
            "snapshot_date": F.when(
                (F.col("loan_id") == last) & start, F.date_format(F.add_months(month, 1), "yyyy-MM-dd")
            ).otherwise(month),
        }
    )
    gone = snapshot_day(F.col("snapshot_date")).eqNullSafe(F.lit(ONE_MONTH))
    changed = {"loans": loans, "attributes": sources["attributes"].where(~gone)}
    return changes.by_month(backfill.changed_months(target, changed, months, specs))


@query
def run_report_layers(spark, d):
    """Reports of all layers after bronze ran twice and the other layers once."""
    target, months = _bronze_store(spark, d, ["loans"]), _months(spark, d)
    backfill.run_bronze(target, {"loans": star.loans(spark, d)}, months)
    backfill.run_silver(target, ["loans"])
    backfill.run_labels(target)
    reports = [backfill.run_report(target, months, layer) for layer in ("bronze", "silver", "gold")]
    return reduce(DataFrame.unionByName, reports).drop("error")


@query
def source_report(spark, d):
    """What the bronze layer reads of loans and attributes for the year 1997."""
    sources = {"loans": star.loans(spark, d), "attributes": star.attributes(spark, d)}
    year = calendar.month_calendar(spark, dt.date(1997, 1, 1), dt.date(1997, 12, 1))
    return backfill.source_report(sources, year)


@query
def partition_inventory(spark, d):
    target = _checked(_bronze_store(spark, d))
    tables = [("bronze", name, "source_date") for name in DATASETS]
    return backfill.partition_inventory(target, tables)


@query
def run_report(spark, d):
    """Status of every month of every dataset; one source is missing, one is broken."""
    target = backfill.Store(spark, files.scratch_folder(spark))
    sources = {
        "loans": star.loans(spark, d),
        "attributes": star.attributes(spark, d).withColumn("snapshot_date", F.array("Name")),
        "financials": f"{target.root}/absent.csv",
        "clickstream": star.clickstream(spark, d),
    }
    months = _months(spark, d)
    backfill.run_bronze(target, sources, months)
    return backfill.run_report(target, months).drop("error")
