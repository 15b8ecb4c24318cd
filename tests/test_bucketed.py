import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from vintagemill.operators.store import feature_store
from vintagemill.plans import backfill
from vintagemill.plans.registry import _bronze_store, _checked
from vintagemill.schemas import empty_silver
from vintagemill.sources import bucketed, files

JAN, FEB = dt.date(2023, 1, 1), dt.date(2023, 2, 1)
SCHEMA = "Customer_ID string, x int, source_date date"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def write(spark, path, data, table="bucketed_t", buckets=4):
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    bucketed.write_bucketed(df, table, path, "Customer_ID", "source_date", buckets)
    return read(spark, path, table, buckets)


def read(spark, path, table="bucketed_t", buckets=4):
    schema = files.read_table(spark, path).schema
    return bucketed.read_bucketed(spark, table, path, schema, "Customer_ID", "source_date", buckets)


@pytest.fixture
def clean(spark):
    yield
    for table in ("bucketed_t", "bucketed_u"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_months_are_replaced_and_deleted(spark, ansi, tmp_path, clean):
    path = str(tmp_path / "t")
    data = [("a", 1, JAN), ("b", 2, JAN), (None, 3, JAN), ("a", 4, FEB), ("a", 4, FEB)]
    assert rows(write(spark, path, data)) == sorted(data, key=repr)
    assert rows(write(spark, path, [("c", 5, FEB)])) == sorted([*data[:3], ("c", 5, FEB)], key=repr)
    files.drop_partitions(spark, path, "source_date", ["2023-01-01"])
    assert rows(read(spark, path)) == [("c", 5, FEB)]
    # A later session knows the files alone.
    spark.sql("DROP TABLE bucketed_t")
    assert rows(read(spark, path)) == [("c", 5, FEB)]


def test_at_most_a_file_per_bucket_and_month(spark, tmp_path, clean):
    path = str(tmp_path / "t")
    write(spark, path, [(f"c{i}", i, day) for i in range(200) for day in (JAN, FEB)])
    for day in ("2023-01-01", "2023-02-01"):
        names = [n for n in os.listdir(f"{path}/source_date={day}") if n.endswith(".parquet")]
        assert len(names) == 4


def test_another_layout_is_an_error(spark, tmp_path, clean):
    path = str(tmp_path / "t")
    write(spark, path, [("a", 1, JAN)])
    with pytest.raises(ValueError, match="differently"):
        write(spark, path, [("a", 1, JAN)], buckets=8)
    with pytest.raises(ValueError, match="differently"):
        write(spark, str(tmp_path / "u"), [("a", 1, JAN)])
    other = spark.createDataFrame([("a", 1, 2, JAN)], "Customer_ID string, x int, y int, source_date date")
    with pytest.raises(ValueError, match="other columns"):
        bucketed.write_bucketed(other, "bucketed_t", path, "Customer_ID", "source_date", 4)
    assert rows(read(spark, path)) == [("a", 1, JAN)]


def test_feature_store_joins_without_a_shuffle(spark, sf_small):
    """No exchange but broadcasts of months between the scans of the silver layer and the store."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    target = _bronze_store(spark, sf_small, buckets=8)
    backfill.run_silver(target)
    _checked(target)
    inputs = {name: target.snapshots("silver", name) for name in ("financials", "attributes", "clickstream")}
    loans = target.months("silver", "loans")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed.co_partitioned(spark):
            store = feature_store(loans, **inputs, rows_per_split=None, co_located=True)
            text, found = plan(store), rows(store)
        # Without the setting the same joins shuffle.
        assert "Exchange hashpartitioning" in plan(feature_store(loans, **inputs, rows_per_split=None, co_located=True))
        plain = feature_store(loans, **inputs, rows_per_split=None)
        assert rows(plain.select(*store.columns)) == found and found
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    assert not re.findall(r"Exchange (?:hash|range|single|Single|round|Round)\w*[^\n]*", text)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_parts_of_the_spine(spark):
    """Loans, attributes and financials serve a month each; hot keys, undated loans and null customers stay."""
    mar = dt.date(2023, 3, 1)

    def silver(name, data):
        frame = empty_silver(spark, name)
        given = spark.createDataFrame(data, "Customer_ID string, snapshot_date date")
        given = given.withColumn("processing_date", F.col("snapshot_date"))
        return frame.unionByName(given, allowMissingColumns=True)

    loans = silver("loans", [("a", JAN), ("a", JAN), ("b", JAN), (None, JAN), ("z", None)])
    loans = loans.withColumns({"mob": F.lit(0), "loan_id": F.lit("L"), "loan_amt": F.lit(5.0).cast("float")})
    sides = {
        "attributes": silver("attributes", [("a", JAN), ("c", FEB), ("c", FEB), (None, FEB)]),
        "financials": silver("financials", [("a", JAN), ("a", JAN), ("d", FEB), ("d", mar)]),
    }
    for split in (None, 1):
        plain = feature_store(loans, **sides, rows_per_split=split)
        parts = feature_store(loans, **sides, rows_per_split=split, co_located=True)
        assert parts.columns == plain.columns
        assert rows(parts) == rows(plain)
    assert {(r.processing_date, r.Customer_ID) for r in parts.collect()} == {
        (JAN, "a"), (JAN, "b"), (JAN, None), (None, "z"), (FEB, "c"), (FEB, None), (mar, "d")
    }
    none = feature_store(loans.limit(0), co_located=True)
    assert none.count() == 0 and none.columns == plain.columns
