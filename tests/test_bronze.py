import datetime as dt

import pytest
from pyspark.sql import functions as F

from vintagemill.operators import bronze
from vintagemill.operators.calendar import calendar_of, missing_months, month_calendar, source_map

D = dt.date
JAN, FEB, MAR, APR = (D(2023, m, 1) for m in range(1, 5))


def days(df, column="processing_date"):
    return sorted(r[column] for r in df.collect())


def dates(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "source_date date")


def test_calendar_floors_the_start_and_includes_the_end(spark, ansi):
    assert days(month_calendar(spark, D(2023, 1, 17), D(2023, 3, 1))) == [JAN, FEB, MAR]
    assert days(month_calendar(spark, D(2023, 1, 17), D(2023, 1, 17))) == [JAN]
    assert days(month_calendar(spark, D(2023, 2, 1), D(2023, 1, 31))) == []
    assert len(days(month_calendar(spark, D(2023, 1, 1), D(2024, 12, 1)))) == 24


def test_calendar_of_columns(spark):
    bounds = spark.createDataFrame([(D(2023, 1, 9), D(2023, 2, 28))], "first_date date, last_date date")
    assert days(calendar_of(bounds)) == [JAN, FEB]
    empty = spark.createDataFrame([(None, None)], "first_date date, last_date date")
    assert days(calendar_of(empty)) == []


@pytest.mark.parametrize(
    "policy, expected",
    [
        ("skip", {FEB: FEB, APR: APR}),
        ("latest_overall", {JAN: D(2023, 9, 1), FEB: FEB, MAR: D(2023, 9, 1), APR: APR}),
        ("latest_as_of", {FEB: FEB, MAR: FEB, APR: APR}),
    ],
)
def test_source_map(spark, ansi, policy, expected):
    available = dates(spark, FEB, APR, D(2023, 9, 1))
    got = source_map(month_calendar(spark, JAN, APR), available, policy)
    assert {r.processing_date: r.source_date for r in got.collect()} == expected


@pytest.mark.parametrize("policy", ["skip", "latest_overall", "latest_as_of"])
def test_source_map_without_dates(spark, policy):
    assert source_map(month_calendar(spark, JAN, APR), dates(spark), policy).count() == 0


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        source_map(month_calendar(spark, JAN, JAN), dates(spark, JAN), "nearest")


def test_missing_months(spark):
    loaded = spark.createDataFrame([(FEB,), (FEB,)], "processing_date date")
    assert days(missing_months(month_calendar(spark, JAN, MAR), loaded)) == [JAN, MAR]


RAW = [
    ("a", "1/1/2023"),
    ("b", "2023-01-01"),
    ("c", "2023-02-01"),
    ("d", "2023-99-99"),
    ("e", None),
    ("f", "2023-02-01 10:00"),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW, "Customer_ID string, snapshot_date string")


def ids(df):
    return sorted(r.Customer_ID for r in df.collect())


def test_slice_month(raw, ansi):
    assert ids(bronze.slice_month(raw, JAN)) == ["a", "b"]
    assert ids(bronze.slice_month(raw, MAR)) == []


def test_slices_of_all_months_are_the_single_slices(spark, raw, ansi):
    months = month_calendar(spark, JAN, MAR)
    together = bronze.slice_months(raw, months)
    got = sorted((r.processing_date, r.Customer_ID) for r in together.collect())
    assert got == [(JAN, "a"), (JAN, "b"), (FEB, "c")]
    alone = [(m, i) for m in (JAN, FEB, MAR) for i in ids(bronze.slice_month(raw, m))]
    assert got == alone


def test_fallback_repeats_the_newest_date(spark, raw, ansi):
    months = month_calendar(spark, JAN, APR)
    together = bronze.slice_months(raw, months, "latest_overall")
    got = sorted((r.processing_date, r.Customer_ID) for r in together.collect())
    assert got == [(JAN, "a"), (JAN, "b"), (FEB, "c"), (MAR, "c"), (APR, "c")]


def test_source_slices_hold_each_date_once(spark, raw):
    served = bronze.dataset_source_map(raw, month_calendar(spark, FEB, APR), "latest_overall")
    assert ids(bronze.source_slices(raw, served)) == ["c"]


def test_dates_of_a_dataset(raw):
    assert [r[0] for r in bronze.sample_dates(raw, n=2).collect()] == [None, "1/1/2023"]
    day = bronze.snapshot_day(F.col("snapshot_date"))
    assert bronze.latest_date(raw, day).collect()[0][0] == FEB


def test_undated_and_lineage(raw):
    undated = bronze.undated(raw.drop("snapshot_date"), JAN)
    assert {r.processed_date for r in undated.collect()} == {"2023-01-01"}
    lined = bronze.with_bronze_lineage(undated, "x.csv", F.lit(JAN)).collect()[0]
    assert (lined.bronze_source_file, lined.bronze_processing_date) == ("x.csv", "2023-01-01")
    assert lined.bronze_ingestion_timestamp is not None
