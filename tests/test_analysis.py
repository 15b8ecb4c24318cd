import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vintagemill.operators import checks, profiling, vintage
from vintagemill.operators.quantiles import exact_medians, in_long_form
from vintagemill.operators.store import Snapshots

D = dt.date
JAN, FEB = D(2023, 1, 1), D(2023, 2, 1)


def rates(spark, *values, start=0):
    rows = [(i, v) for i, v in enumerate(values, start)]
    return spark.createDataFrame(rows, "mob int, bad_rate double")


def test_bad_rate_by_loan_counts_each_loan_once(spark):
    rows = [
        (0, "a", 30),
        (0, "a", 0),
        (0, "b", None),
        (1, "a", 29),
        (1, None, 90),
        (2, None, 90),
        (None, "a", 90),
    ]
    loans = spark.createDataFrame(rows, "mob int, loan_id string, DPD int")
    got = [tuple(r) for r in vintage.bad_rate_loans(loans).collect()]
    assert got == [(0, 2, 1, 0.5), (1, 1, 0, 0.0), (2, 0, 0, 0.0)]
    weighted = [tuple(r) for r in vintage.bad_rate_rows(loans).collect()]
    assert weighted == [(0, 3, 1 / 3), (1, 2, 0.5), (2, 1, 1.0)]


def test_days_past_due_column(spark):
    assert vintage.dpd_column(spark.range(1).withColumn("DaysPastDue", F.lit(1))) == "DaysPastDue"
    with pytest.raises(ValueError):
        vintage.dpd_column(spark.range(1))


def test_filters(spark):
    rows = [(D(2023, 12, 31), 10), (D(2024, 1, 1), 10), (None, 9)]
    loans = spark.createDataFrame(rows, "loan_start_date date, installment_num int")
    assert vintage.cohort_filter(loans, D(2024, 1, 1)).count() == 1
    assert vintage.matured_loans(loans).count() == 2


def test_trend(spark):
    df = rates(spark, 0.1, 0.3, 0.305, 0.505)
    changes = [r.mom_change for r in vintage.bad_rate_mom(df).orderBy("mob").collect()]
    assert changes[0] is None
    assert changes[1:] == pytest.approx([0.2, 0.005, 0.2])
    growth = vintage.bad_rate_growth(df).collect()[0]
    assert (growth.initial_rate, growth.final_mob, growth.final_rate) == (0.1, 3, 0.505)
    assert growth.growth_pct == pytest.approx(405.0)
    assert vintage.bad_rate_stabilization(df).collect()[0][0] == 2


def test_trend_edges(spark):
    assert vintage.bad_rate_growth(rates(spark, 0.0, 0.2)).collect()[0].growth_pct == math.inf
    late = vintage.bad_rate_growth(rates(spark, 0.1, 0.2, start=1)).collect()[0]
    assert (late.initial_rate, late.growth_pct) == (None, None)
    assert vintage.bad_rate_stabilization(rates(spark, 0.1, 0.9)).collect()[0][0] is None
    tied = vintage.bad_rate_peak_change(rates(spark, 0.0, 0.5, 0.25, 0.75)).collect()[0]
    assert tuple(tied) == (1, 0.5)


def test_trend_per_cohort(spark):
    rows = [("x", 0, 0.1), ("x", 1, 0.2), ("y", 0, 0.5), ("y", 1, 0.4)]
    df = spark.createDataFrame(rows, "cohort string, mob int, bad_rate double")
    got = {r.cohort: r.max_change for r in vintage.bad_rate_peak_change(df, by=["cohort"]).collect()}
    assert got == pytest.approx({"x": 0.1, "y": -0.1})


def long(spark, values):
    return spark.createDataFrame([("m", float(v)) for v in values], "metric string, value double")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(st.integers(-5, 5), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=60
    )
)
def test_median_is_exact(spark, values):
    got = exact_medians(long(spark, values)).collect()[0].median
    assert got == pd.Series(values, dtype=float).median()


@pytest.mark.parametrize("accuracy", [100, 1000])
def test_median_with_a_coarse_sketch(spark, accuracy):
    """A third of the rows share one value; the sketch is far smaller than the data."""
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(10_000, 7.5), rng.normal(7, 3, 20_001)])
    rng.shuffle(values)
    frame = spark.createDataFrame(pd.DataFrame({"metric": "m", "value": values})).repartition(7)
    assert exact_medians(frame, accuracy).collect()[0].median == np.median(values)


def test_column_stats(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (5, 4.0)], "a int, b double")
    got = {r.metric: r for r in profiling.column_stats(in_long_form(df, ["a", "b"])).collect()}
    assert tuple(got["a"])[1:5] == (3, 1.0, 5.0, pytest.approx(8 / 3))
    assert (got["a"].median, got["b"].median, got["b"].n) == (2.0, 3.0, 2)


@pytest.mark.parametrize("values", [[0, 1, 2, 3, 10], [4, 4, 4], [-3.5, 0, 12, 12, 7.25]])
def test_histogram_matches_numpy(spark, values):
    got = profiling.histogram(long(spark, values), {"m": 6}).orderBy("bucket").collect()
    counts, edges = np.histogram(values, bins=6)
    assert [r.rows for r in got] == counts.tolist()
    assert [r.low for r in got] == pytest.approx(edges[:-1])
    assert got[-1].high == pytest.approx(edges[-1])


def test_ranges(spark):
    kept = profiling.in_ranges(long(spark, [-1, 0, 2, 2.1]), {"m": (0, 2), "other": (0, 9)})
    assert sorted(r.value for r in kept.collect()) == [0.0, 2.0]


def test_dti_buckets(spark):
    dti = [-1.0, 0.0, 0.3, 0.31, 1.0, 9.0, None]
    df = spark.createDataFrame([(v,) for v in dti], "debt_to_income_ratio double")
    got = {r.health_score: r.rows for r in profiling.dti_bucket_counts(df).collect()}
    assert got == {
        "Excellent (5)": 1,
        "Good (4)": 1,
        "Fair (3)": 0,
        "Poor (2)": 1,
        "Critical (1)": 1,
    }


def test_missing_percentage(spark):
    df = spark.createDataFrame(
        [(JAN, 1, None), (JAN, None, None), (FEB, 1, 2)], "snapshot_date date, a int, b int"
    )
    missing = profiling.missing_pct({"x": df, "y": df.drop("b")})
    got = {(r.dataset, r.snapshot_date): r.missing_pct for r in missing.collect()}
    assert got == {("x", JAN): 50.0, ("x", FEB): 0.0, ("y", JAN): 25.0, ("y", FEB): 0.0}
    counts = profiling.missing_counts({"x": df, "y": df.drop("b")})
    labels = profiling.month_labels(JAN, dt.date(2023, 3, 31))
    pivot = profiling.missing_pct_pivot(counts, labels)
    assert pivot.columns == ["dataset", "Jan 2023", "Feb 2023", "Mar 2023"]
    assert sorted(tuple(r) for r in pivot.collect()) == [("x", 50.0, 0.0, None), ("y", 25.0, 0.0, None)]


def test_pivot_sums_days_of_a_month_and_loses_none(spark):
    rows = [(JAN, 1), (dt.date(2023, 1, 15), None), (dt.date(2023, 1, 15), None)]
    df = spark.createDataFrame(rows, "snapshot_date date, a int")
    counts = profiling.missing_counts({"x": df})
    assert [tuple(r) for r in profiling.missing_pct_pivot(counts, ["Jan 2023"]).collect()] == [
        ("x", 100.0 * 2 / 6)
    ]
    with pytest.raises(Exception, match="outside the pivot"):
        profiling.missing_pct_pivot(counts, ["Feb 2023"]).collect()


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "m double")
    values = in_long_form(df, ["m"])
    assert [tuple(r) for r in profiling.column_stats(values).collect()] == [("m", 2, 1.0, 2.0, 1.5, 1.5)]
    assert [r.rows for r in profiling.histogram(values, {"m": 2}).orderBy("bucket").collect()] == [1, 1]


def test_validity(spark):
    rows = [(JAN, True), (JAN, False), (JAN, None), (FEB, None)]
    df = spark.createDataFrame(rows, "snapshot_date date, SSN_is_valid boolean")
    assert [tuple(r) for r in profiling.validity_share(df).collect()] == [(JAN, 0.5, 0.5)]
    assert profiling.invalid_rate(df).collect()[0][0] == 50.0


def test_application_profile(spark):
    rows = [("L1", "a", JAN, 10), ("L2", "a", FEB, 6), ("L3", "b", FEB, 6), (None, None, FEB, 10)]
    df = spark.createDataFrame(
        rows, "loan_id string, Customer_ID string, snapshot_date date, tenure int"
    )
    per_month = {tuple(r) for r in profiling.applications_by_month(df).collect()}
    assert per_month == {(JAN, 1), (FEB, 2)}
    assert tuple(profiling.application_rate(df).collect()[0]) == (4, 2, 2.0)
    assert [tuple(r) for r in profiling.tenure_counts(df).collect()] == [(6, 2), (10, 2)]
    assert profiling.tenure_mode(df).collect()[0][0] == 6
    assert tuple(profiling.multi_application_share(df).collect()[0]) == (1, 1, 50.0)
    assert profiling.customers_across_sources(df, df).collect()[0][0] == 2


def test_balance_sample_is_stable(spark):
    df = spark.range(3000).select(
        F.concat(F.lit("L"), "id").alias("loan_id"),
        F.when(F.col("id") % 10 > 0, F.col("id")).alias("loan_amt"),
        F.col("id").alias("balance"),
    )
    first = profiling.balance_sample(df).collect()
    second = profiling.balance_sample(df.repartition(5)).collect()
    assert len(first) == 1000
    assert first == second
    assert profiling.balance_sample(df.limit(5)).count() == 4


def test_threshold_share(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    rules = {"high": ("x", F.col("x") > 2), "none": ("x", F.col("x") > 9)}
    got = {r.metric: (r.rows, r.pct) for r in profiling.threshold_share(df, rules).collect()}
    assert got == {"high": (1, 50.0), "none": (0, 0.0)}


def test_overlap(spark):
    features = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "Customer_ID string")
    labels = spark.createDataFrame([("b",), ("c",), (None,)], "Customer_ID string")
    got = checks.customer_overlap(features, labels).collect()[0]
    assert (got.feature_customers, got.label_customers, got.overlap) == (3, 3, 2)
    assert (got.overlap_share, got.ready) == (2 / 3, False)
    both = features.distinct().intersect(labels.distinct()).count()
    assert both == got.overlap
    empty = checks.customer_overlap(features.limit(0), labels.limit(0)).collect()[0]
    assert (empty.overlap, empty.overlap_share, empty.ready) == (0, 0.0, False)


def test_store_summary_and_previews(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3)], "Customer_ID string, x int")
    assert tuple(checks.store_summary({"s": df}).collect()[0]) == ("s", 3, 2, 2)
    assert checks.preview(df, 2).columns == ["Customer_ID"]
    lines = [tuple(r) for r in checks.schema_preview(df).collect()]
    assert lines == [(1, "Customer_ID", "string", 2), (2, "x", "int", 2)]
    assert checks.schema_preview(df, 1).count() == 1


def test_leakage(spark):
    loans = spark.createDataFrame([(0,), (1,)], "mob int")
    rows = spark.createDataFrame([(FEB, "a"), (FEB, "b")], "source_date date, Customer_ID string")
    served = spark.createDataFrame([(JAN, FEB), (FEB, FEB)], "processing_date date, source_date date")
    usage = {"clicks": checks.source_usage(Snapshots(rows, served))}
    got = {r.check: tuple(r)[1:] for r in checks.leakage_check(loans, loans, usage).collect()}
    assert got == {
        "features at mob": (2, 1, False),
        "labels after application": (2, 1, False),
        "clicks not ahead": (4, 2, False),
    }
