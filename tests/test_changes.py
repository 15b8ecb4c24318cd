import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from vintagemill.config import DATASETS, LATEST_AS_OF
from vintagemill.operators.calendar import month_calendar
from vintagemill.operators.changes import by_month, changed_days, day_fingerprints
from vintagemill.plans import backfill

JAN, FEB, MAR, APR = (dt.date(2023, m, 1) for m in (1, 2, 3, 4))
BASE = [("a", "1", JAN), ("a", "1", JAN), ("b", None, JAN), ("c", "2", FEB), ("d", "3", MAR)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "Customer_ID string, Age string, snapshot_date date").repartition(3)


def marks(spark, rows):
    return day_fingerprints(frame(spark, rows), F.col("snapshot_date"))


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        (BASE[::-1], {}),
        (BASE[1:], {JAN: "altered"}),  # one of two equal rows
        ([*BASE, BASE[0]], {JAN: "altered"}),
        ([*BASE[:4], ("d", "4", MAR)], {MAR: "altered"}),
        ([*BASE[:4], ("d", "3", FEB)], {FEB: "altered", MAR: "removed"}),  # moved
        ([*BASE[:2], (None, "b", JAN), *BASE[3:]], {JAN: "altered"}),  # a value beside a null
        ([*BASE, ("x", "y", None)], {}),
        ([*BASE, ("e", "5", APR)], {APR: "added"}),
        ([], {JAN: "removed", FEB: "removed", MAR: "removed"}),
        # Two rows swap a value: the same values in the column, other rows.
        ([*BASE[:3], ("c", "3", FEB), ("d", "2", MAR)], {FEB: "altered", MAR: "altered"}),
    ],
)
def test_changed_days(spark, ansi, rows, expected):
    found = changed_days(marks(spark, BASE), marks(spark, rows)).collect()
    assert {r.source_date: r.change for r in found} == expected


def test_columns_count_by_name(spark):
    other = frame(spark, BASE).select("snapshot_date", "Age", "Customer_ID")
    assert changed_days(marks(spark, BASE), day_fingerprints(other, F.col("snapshot_date"))).count() == 0


def test_walk_through_the_month_map_and_refresh(spark, tmp_path):
    """A day that serves several months names all of them; a refresh equals a store filled anew."""
    specs = DATASETS | {"attributes": replace(DATASETS["attributes"], fallback=LATEST_AS_OF)}
    months = month_calendar(spark, JAN, APR)
    text = "Customer_ID string, Name string, Age string, SSN string, Occupation string, snapshot_date string"

    def attributes(*rows):
        return spark.createDataFrame([(c, "N", age, None, None, day) for c, age, day in rows], text)

    store = backfill.Store(spark, str(tmp_path / "store"))
    old = attributes(("a", "30", "2023-01-01"), ("b", "40", "3/1/2023"))
    assert backfill.refresh(store, {"attributes": old}, months, specs) == [JAN, FEB, MAR, APR]
    assert backfill.refresh(store, {"attributes": old}, months, specs) == []
    new = attributes(("a", "30", "2023-01-01"), ("b", "41", "2023-03-01"))
    named = by_month(backfill.changed_months(store, {"attributes": new}, months, specs)).collect()
    assert sorted((r.processing_date, r.datasets) for r in named) == [(MAR, "attributes"), (APR, "attributes")]
    # The day moves to February: February and March are served by another date, April too.
    moved = attributes(("a", "30", "2023-01-01"), ("b", "41", "2023-02-01"))
    assert backfill.refresh(store, {"attributes": moved}, months, specs) == [FEB, MAR, APR]
    fresh = backfill.Store(spark, str(tmp_path / "fresh"))
    backfill.refresh(fresh, {"attributes": moved}, months, specs)
    for layer in ("bronze", "silver"):
        one, other = (
            sorted((r.processing_date, r.Customer_ID, r.Age) for r in s.months(layer, "attributes").collect())
            for s in (store, fresh)
        )
        assert one == other and len(one) == 4
        assert store.days(layer, "attributes") == fresh.days(layer, "attributes")


def test_a_source_is_read_once_for_its_changes(spark, tmp_path):
    """What comes of the fingerprints does not read the source again."""
    path, months = str(tmp_path / "source"), month_calendar(spark, JAN, APR)
    frame(spark, BASE).withColumn("snapshot_date", F.col("snapshot_date").cast("string")).write.parquet(path)
    store = backfill.Store(spark, str(tmp_path / "store"))
    found = backfill.changed_months(store, {"attributes": spark.read.parquet(path)}, months)["attributes"]
    assert {r.processing_date for r in found.collect()} == {JAN, FEB, MAR}
    assert path not in found._jdf.queryExecution().optimizedPlan().toString()
    assert not any(path in file for file in found.inputFiles())
