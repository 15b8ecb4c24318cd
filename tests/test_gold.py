import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from vintagemill.operators import features, labels, store
from vintagemill.operators.joins import split_left_join
from vintagemill.operators.store import Snapshots
from vintagemill.schemas import SILVER

D = dt.date
JAN, FEB, MAR = D(2023, 1, 1), D(2023, 2, 1), D(2023, 3, 1)


def frame(spark, dataset, *records, month_key="processing_date"):
    """Silver rows; the processing date is the snapshot date unless given."""
    names = SILVER[dataset].fieldNames()
    full = [
        tuple(r.get(n) for n in names) + (r.get(month_key, r.get("snapshot_date")),)
        for r in records
    ]
    schema = StructType([*SILVER[dataset].fields, StructField(month_key, DateType())])
    return spark.createDataFrame(full, schema)


def loan(customer, month, mob=0, amount=100.0, **more):
    return {
        "loan_id": f"L{customer}{mob}",
        "Customer_ID": customer,
        "snapshot_date": month,
        "mob": mob,
        "loan_amt": amount,
        "balance": amount,
        "tenure": 10,
        "dpd": 0,
    } | more


def test_loan_application_features(spark):
    loans = frame(
        spark,
        "loans",
        loan("a", JAN, amount=10.0),
        loan("a", JAN, amount=60000.0, loan_id=None),
        loan("a", JAN, amount=None),
        loan("a", JAN, mob=1, amount=9e6),
        loan("b", JAN, amount=None),
    )
    got = {r.Customer_ID: r for r in features.loan_application_features(loans).collect()}
    a, b = got["a"], got["b"]
    assert a.num_active_loans_at_application == 2
    assert (a.max_requested_loan_amount, a.avg_requested_loan_amount) == (60000.0, 30005.0)
    assert a.total_loan_exposure_at_application == 60010.0
    assert (a.multiple_loans_flag, a.high_value_application) == (1, 1)
    assert (b.max_requested_loan_amount, b.avg_requested_loan_amount) == (None, None)
    assert (b.multiple_loans_flag, b.high_value_application) == (0, 0)


def test_health_score(spark):
    dti = [-1.0, 0.0, 0.3, 0.31, 0.7, 1.0, 1.01, None]
    rows = [{"Customer_ID": str(i), "debt_to_income_ratio": v} for i, v in enumerate(dti)]
    got = features.financial_features(frame(spark, "financials", *rows)).orderBy("Customer_ID")
    assert [r.financial_health_score for r in got.collect()] == [5, 5, 5, 4, 3, 2, 1, 1]
    assert [r.high_leverage_flag for r in got.collect()] == [0, 0, 0, 0, 0, 1, 1, 0]


def test_salary_guards_differ(spark, ansi):
    row = {
        "Customer_ID": "a",
        "Monthly_Inhand_Salary": 0.0,
        "Total_EMI_per_month": 5.0,
        "Amount_invested_monthly": 1.0,
        "Monthly_Balance": 2.0,
        "Num_Bank_Accounts": 1.0,
        "Num_Credit_Card": 2.0,
    }
    got = features.financial_features(frame(spark, "financials", row)).collect()[0]
    assert (got.liquidity_ratio, got.investment_ratio) == (None, 0.0)
    assert (got.discretionary_income, got.savings_capacity_ratio) == (-5.0, 0.0)
    assert got.credit_product_diversity is None


def test_age_bands(spark):
    ages = [24, 25, 26, 30, 35, 50, 55, 56, 65, 66, None]
    rows = [{"Customer_ID": f"{i:02d}", "Age": v} for i, v in enumerate(ages)]
    got = features.attribute_features(frame(spark, "attributes", *rows)).orderBy("Customer_ID")
    young, adult = ["young"] * 2, ["young_adult"] * 3
    assert [r.age_risk_category for r in got.collect()] == (
        young + adult + ["middle_age"] + ["mature"] * 3 + ["senior"] * 2
    )
    assert [r.financial_maturity_score for r in got.collect()] == [2, 4, 4, 5, 5, 5, 5, 4, 4, 3, 3]


def test_occupation_scores(spark):
    jobs = {"Lawyer": 5, "Scientist": 5, "Manager": 3, " Manager": 2, "Cook": 2, "": 2, None: 1}
    rows = [{"Customer_ID": str(i), "Occupation": v} for i, v in enumerate(jobs)]
    got = features.attribute_features(frame(spark, "attributes", *rows)).orderBy("Customer_ID")
    assert [r.occupation_stability_score for r in got.collect()] == list(jobs.values())


def clicks(customer, positive, ratio, month=JAN):
    return {
        "Customer_ID": customer,
        "snapshot_date": month,
        "total_positive_features": positive,
        "feature_balance_ratio": ratio,
        "fe_1": positive,
    }


def test_engagement(spark):
    rows = [clicks("a", 100.0, -0.9), clicks("b", 50.0, -0.1), clicks("c", None, None)]
    df = frame(spark, "clickstream", *rows)
    signed = features.clickstream_features(df).orderBy("Customer_ID").collect()
    assert [r.engagement_level for r in signed] == ["high", "medium", "low"]
    assert [r.engagement_quality_score for r in signed] == [1, 1, 1]
    assert [r.thorough_researcher for r in signed] == [0, 0, 0]
    sized = features.clickstream_features(df, ratio="magnitude").orderBy("Customer_ID").collect()
    assert [r.engagement_quality_score for r in sized] == [5, 1, 1]
    assert [r.thorough_researcher for r in sized] == [1, 0, 0]


def spine_of(df):
    return sorted((r.processing_date, r.Customer_ID, r.snapshot_date) for r in df.collect())


def test_spine_falls_back_in_order(spark):
    loans = frame(spark, "loans", loan("a", JAN), loan("a", JAN), loan("z", FEB, mob=2))
    attributes = frame(
        spark,
        "attributes",
        {"Customer_ID": "x", "snapshot_date": JAN},
        {"Customer_ID": "b", "snapshot_date": FEB},
    )
    financials = frame(
        spark,
        "financials",
        {"Customer_ID": "y", "snapshot_date": FEB},
        {"Customer_ID": "c", "snapshot_date": MAR},
    )
    got = store.feature_spine(loans, attributes, financials)
    assert spine_of(got) == [(JAN, "a", JAN), (FEB, "b", FEB), (MAR, "c", MAR)]


def test_spine_from_a_served_dataset(spark):
    source = D(2024, 1, 1)
    rows = frame(spark, "clickstream", clicks("a", 1.0, None, source), month_key="source_date")
    served = spark.createDataFrame(
        [(JAN, source), (FEB, source)], "processing_date date, source_date date"
    )
    loans = frame(spark, "loans", loan("b", JAN))
    got = store.feature_spine(loans, clickstream=Snapshots(rows, served))
    assert spine_of(got) == [(JAN, "b", JAN), (FEB, "a", source)]
    table = store.feature_store(loans, clickstream=Snapshots(rows, served)).collect()
    by_key = {(r.processing_date, r.Customer_ID): r for r in table}
    assert by_key[(JAN, "b")].clickstream_positive_activity is None
    assert by_key[(FEB, "a")].clickstream_positive_activity == 1.0
    assert by_key[(FEB, "a")].num_active_loans_at_application is None
    assert by_key[(FEB, "a")].multiple_loans_flag is None


def test_no_dataset_is_an_error(spark):
    with pytest.raises(ValueError):
        store.feature_store(None)


def test_empty_loans_alone_give_an_empty_store(spark):
    assert store.feature_store(frame(spark, "loans")).count() == 0


def test_schema_does_not_depend_on_the_datasets(spark):
    loans = frame(spark, "loans", loan("a", JAN))
    attributes = frame(spark, "attributes", {"Customer_ID": "a", "snapshot_date": JAN, "Age": 30})
    small = store.feature_store(loans)
    full = store.feature_store(loans, attributes=attributes)
    assert small.schema == full.schema
    assert small.collect()[0].customer_age is None
    assert full.collect()[0].customer_age == 30


def test_joins_match_months(spark):
    loans = frame(spark, "loans", loan("a", JAN), loan("a", FEB, amount=7.0))
    attributes = frame(
        spark,
        "attributes",
        {"Customer_ID": "a", "snapshot_date": JAN, "Age": 30},
        {"Customer_ID": "a", "snapshot_date": FEB, "Age": 31},
    )
    got = store.feature_store(loans, attributes=attributes).orderBy("processing_date").collect()
    assert [(r.max_requested_loan_amount, r.customer_age) for r in got] == [(100.0, 30), (7.0, 31)]


def test_several_snapshot_dates_in_a_month_share_loan_features(spark):
    loans = frame(
        spark,
        "loans",
        loan("a", JAN, processing_date=MAR),
        loan("a", FEB, amount=300.0, processing_date=MAR),
    )
    got = store.feature_store(loans).orderBy("snapshot_date").collect()
    assert [(r.snapshot_date, r.num_active_loans_at_application) for r in got] == [(JAN, 2), (FEB, 2)]
    assert {r.avg_requested_loan_amount for r in got} == {200.0}


def test_null_customer_keeps_its_spine_row_without_features(spark):
    got = store.feature_store(
        frame(spark, "loans", loan(None, JAN)),
        attributes=frame(spark, "attributes", {"snapshot_date": JAN, "Age": 30}),
    ).collect()
    assert len(got) == 1
    assert (got[0].num_active_loans_at_application, got[0].customer_age) == (None, None)


def test_duplicates(spark):
    loans = frame(spark, "loans", loan("a", JAN))
    attributes = frame(
        spark,
        "attributes",
        {"Customer_ID": "a", "snapshot_date": JAN, "Age": 30},
        {"Customer_ID": "a", "snapshot_date": FEB, "processing_date": JAN, "Age": 20},
    )

    def ages(**options):
        table = store.feature_store(loans, attributes=attributes, **options)
        return sorted(r.customer_age for r in table.collect())

    assert ages() == [20, 30]
    assert ages(rows_per_split=1) == [20, 30]
    assert ages(on_duplicate="latest") == [20]
    with pytest.raises(Exception, match="several rows for"):
        ages(on_duplicate="error")


@pytest.mark.parametrize("rows_per_split", [1, 7, 100, 10_000])
def test_split_join_equals_plain_join(spark, rows_per_split):
    """A third of the right rows share one key, and a third of those are copies."""
    rng = random.Random(5)
    right = [("hot", i % 100) for i in range(300)] + [("hot", 0)] * 100
    right += [(f"k{rng.randrange(300)}", i) for i in range(800)] + [(None, 1)] * 5
    left = [("hot", 1), ("hot", 2), (None, 3)] + [(f"k{i}", i) for i in range(400)]
    left_df = spark.createDataFrame(left, "k string, l int").repartition(3)
    right_df = spark.createDataFrame(right, "k string, r int").repartition(5)
    plain = left_df.join(right_df, "k", "left")
    split = split_left_join(left_df, right_df, ["k"], rows_per_split)
    assert split.columns == plain.columns
    assert sorted(split.collect(), key=repr) == sorted(plain.collect(), key=repr)


def test_hot_key_spreads_over_splits(spark):
    right = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("r"))
    left = spark.createDataFrame([("hot",)], "k string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = split_left_join(left, right, ["k"], 50)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in sizes) == 1000
    assert max(r["count"] for r in sizes) < 500


def labelled(df):
    return sorted((r.loan_id, r.snapshot_date if "snapshot_date" in df.columns else None, r.label)
                  for r in df.collect())


def test_labels(spark):
    loans = frame(
        spark,
        "loans",
        loan("a", JAN, mob=1, dpd=31, loan_id="L1"),
        loan("a", FEB, mob=2, dpd=0, loan_id="L1"),
        loan("a", FEB, mob=2, dpd=None, loan_id="L1"),
        loan("b", JAN, mob=6, dpd=30, loan_id="L2"),
        loan("c", JAN, mob=6, dpd=None, loan_id="L3"),
        loan("d", JAN, mob=0, dpd=90, loan_id="L4"),
        loan("e", JAN, mob=7, dpd=90, loan_id="L5"),
    )
    window = labels.label_within_window(loans)
    assert labelled(window) == [("L1", JAN, 1), ("L1", FEB, 0), ("L2", JAN, 1), ("L3", JAN, 0)]
    ever = labels.label_within_window(loans, scope="loan")
    assert labelled(ever) == [("L1", None, 1), ("L2", None, 1), ("L3", None, 0)]
    at = labels.label_at_mob(loans)
    assert labelled(at) == [("L2", JAN, 1), ("L3", JAN, 0)]
    assert at.columns == list(labels.LABEL_COLUMNS)
    definitions = [df.first().label_def for df in (window, at, labels.label_at_mob_small(loans))]
    assert definitions == ["30dpd_within_6mob", "30dpd_at_6mob", "30dpd_6mob"]
    assert window.columns == ["loan_id", "Customer_ID", "snapshot_date", "label", "label_def"]
    shares = {r.label: (r["count"], r.pct) for r in labels.label_distribution(window).collect()}
    assert shares == {0: (2, 50.0), 1: (2, 50.0)}
