"""Every registered query against DuckDB, and the shape of the plans."""

import datetime as dt
import re

import pytest
from compare import connect, duck_rows, spark_rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from vintagemill.operators.bronze import slice_months
from vintagemill.plans.oracle import ORACLE_SQL
from vintagemill.plans.registry import QUERIES
from vintagemill.sources import files, star

# Golden counts of the bad-rate query at scale factor 0.01.
BAD_RATES = {
    0: (6565, 2273),
    1: (6550, 2326),
    2: (6507, 2212),
    3: (6521, 2238),
    4: (6595, 2341),
    5: (6594, 2340),
    6: (6500, 2252),
}


def test_every_query_has_sql():
    """Those of the reference's operators; others may be beyond SQL."""
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf_small, name):
    expected = duck_rows(connect(sf_small), entry.oracle_sql()[name])
    assert spark_rows(QUERIES[name](spark, sf_small)) == expected


def test_golden_bad_rates(spark, sf_check):
    got = QUERIES["bad_rate_loans"](spark, sf_check).collect()
    assert {r.mob: (r.total_loans, r.bad_loans) for r in got} == BAD_RATES


def test_golden_customer_scores(spark, sf_check):
    """Scores per customer, whatever the number of months each one reports."""
    attributes = QUERIES["feat_attribute"](spark, sf_check)
    bands = attributes.groupBy("age_risk_category").agg(F.countDistinct("Customer_ID").alias("n"))
    assert {r.age_risk_category: r.n for r in bands.collect()} == {
        "young": 103,
        "young_adult": 127,
        "middle_age": 193,
        "mature": 194,
        "senior": 883,
    }
    financials = QUERIES["feat_financial"](spark, sf_check)
    scores = financials.groupBy("financial_health_score").agg(
        F.countDistinct("Customer_ID").alias("n")
    )
    got = {r.financial_health_score: r.n for r in scores.collect()}
    assert got == {5: 639, 4: 272, 3: 115, 2: 105, 1: 369}
    clicks = QUERIES["feat_clickstream"](spark, sf_check)
    levels = clicks.where("clickstream_positive_activity > 0").groupBy("engagement_level").count()
    assert sum(r["count"] for r in levels.collect()) == 141


def test_entry(spark):
    assert entry.entry(spark).columns == ["mob", "total_loans", "bad_loans", "bad_rate"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


FILE_QUERIES = {
    "backfill_bronze",
    "backfill_features",
    "backfill_features_bucketed",
    "backfill_labels",
    "backfill_labels_loan",
    "backfill_rerun",
    "partition_inventory",
    "run_report_layers",
    "stream_backfill",
    "changed_months",
    "quarantine_rows",
    "quarantine_good",
    "quarantine_counts",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FILE_QUERIES - {"run_report"}))
def test_plans_stay_on_the_engine(spark, sf_small, name):
    text = plan(QUERIES[name](spark, sf_small))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


def broadcast_columns(text):
    """The output columns of every broadcast side of a plan, by the node below its exchange."""
    sides = re.findall(r"BroadcastExchange [^\n]*\n([^\n]*)", text)
    return [set(re.findall(r"([A-Za-z_]+)#\d+", side)) for side in sides]


@pytest.fixture
def no_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(("name", "scans"), [("feature_store", 30), ("feature_spine", 20), ("ml_overlap", 20)])
def test_store_plans_are_small(spark, sf_small, no_broadcasts, name, scans):
    """Every input is planned a bounded number of times, and only months are broadcast."""
    text = plan(QUERIES[name](spark, sf_small))
    found = text.count("FileScan") + text.count("Scan ExistingRDD") + text.count("LocalTableScan")
    assert found <= scans, found
    assert text.count("Exchange hashpartitioning") <= 2 * scans
    months = {"processing_date", "source_date", "dates", "day", "o_orderdate", "first_date", "last_date"}
    for columns in broadcast_columns(text):
        assert "Customer_ID" not in columns and columns <= months, columns


def test_hot_keys_alone_are_broadcast_by_customer(spark, sf_small, no_broadcasts):
    """With hot keys their table is the only side by customer that is broadcast."""
    text = plan(QUERIES["feature_store_hot"](spark, sf_small))
    sides = [columns for columns in broadcast_columns(text) if "Customer_ID" in columns]
    assert sides and all(columns <= {"processing_date", "source_date", "Customer_ID", "_rows", "_side", "_splits"} for columns in sides)
    assert "_split" in text


def test_month_filter_prunes_partitions(spark, tmp_path):
    days = [dt.date(2023, m, 1) for m in (1, 2, 3)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "processing_date date, x int")
    files.write_table(df, str(tmp_path / "t"), ["processing_date"])
    one = files.read_table(spark, str(tmp_path / "t")).where(F.col("processing_date") == F.lit(days[1]))
    assert re.search(r"PartitionFilters: \[[^\]]*processing_date", plan(one))
    assert [r.x for r in one.collect()] == [1]


def test_slicing_without_fallback_is_one_scan(spark, sf_small):
    calendar = spark.range(1).select(F.lit(dt.date(1997, 3, 1)).alias("processing_date"))
    text = plan(slice_months(star.table(spark, sf_small, "customer").withColumn("snapshot_date", F.lit("1997-03-01")), calendar))
    assert text.count("FileScan") == 1
    assert "Exchange hashpartitioning" not in text


def test_scans_read_only_what_they_need(spark, sf_small):
    text = plan(QUERIES["application_rate"](spark, sf_small))
    assert "l_extendedprice" not in text
    assert "o_totalprice" not in text
