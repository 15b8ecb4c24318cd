import datetime as dt

import pytest
from pyspark.sql import functions as F

from vintagemill.config import DATASETS
from vintagemill.operators.calendar import month_calendar
from vintagemill.plans import backfill
from vintagemill.sources import files, metrics

JAN, FEB, MAR, APR = (dt.date(2023, m, 1) for m in (1, 2, 3, 4))


def table(spark, rows):
    return spark.createDataFrame(rows, "day date, x int").repartition(3)


def write(spark, folder, rows, days, rebalance=True):
    path, counts = f"{folder}/t", f"{folder}/counts"
    written = metrics.WrittenRows("day", days)
    files.write_table(table(spark, rows), path, ["day"], rebalance, written.attach)
    metrics.store_counts(spark, counts, written.rows(), files.partition_files(spark, path, "day"))
    return path, counts


def counted(spark, path, counts):
    df = metrics.partition_rows(spark, path, counts, "day")
    return {r.day: r.rows for r in df.collect()}, "FileScan" in df._jdf.queryExecution().executedPlan().toString()


ROWS = [(JAN, 1), (JAN, 1), (JAN, None), (MAR, 5)]
DAYS = {"2023-01-01", "2023-02-01", "2023-03-01"}


@pytest.mark.parametrize("rebalance", [True, False])
def test_counts_come_from_the_write(spark, ansi, tmp_path, rebalance):
    path, counts = write(spark, tmp_path, ROWS, DAYS, rebalance)
    assert counted(spark, path, counts) == ({JAN: 3, MAR: 1}, False)
    # Another month beside them, and one replaced.
    write(spark, tmp_path, [(FEB, 1), (MAR, 1), (MAR, 2)], DAYS, rebalance)
    assert counted(spark, path, counts) == ({JAN: 3, FEB: 1, MAR: 2}, False)
    # A deleted partition has no count any more.
    files.drop_partitions(spark, path, "day", ["2023-01-01"])
    assert counted(spark, path, counts) == ({FEB: 1, MAR: 2}, False)


def test_files_of_another_hand_are_read(spark, tmp_path):
    """Counts hold for the files they were taken for; others are counted, and only those are read."""
    path, counts = write(spark, tmp_path, ROWS, DAYS)
    table(spark, [(MAR, 7), (APR, 8)]).write.mode("append").partitionBy("day").parquet(path)
    found = metrics.partition_rows(spark, path, counts, "day")
    assert {r.day: r.rows for r in found.collect()} == {JAN: 3, MAR: 2, APR: 1}
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "2023-03-01" in text and "2023-04-01" in text and "PartitionFilters" in text


def test_rows_of_unknown_partitions_void_the_counts(spark, tmp_path):
    path, counts = write(spark, tmp_path, [*ROWS, (APR, 1), (None, 2)], DAYS)
    found, scanned = counted(spark, path, counts)
    assert scanned and {day: n for day, n in found.items() if day} == {JAN: 3, MAR: 1, APR: 1}


def test_no_rows_and_no_partitions(spark, tmp_path):
    path, counts = write(spark, tmp_path, [], DAYS)
    assert counted(spark, path, counts) == ({}, False)
    path, counts = write(spark, tmp_path, [], set())
    assert counted(spark, path, counts) == ({}, False)


def test_failed_write_keeps_the_old_counts(spark, tmp_path):
    path, counts = write(spark, tmp_path, ROWS, DAYS)
    before = files.partition_files(spark, path, "day")
    bad = table(spark, [(JAN, 1), (FEB, 2)]).withColumn(
        "x", F.when(F.col("x") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("x"))
    )
    written = metrics.WrittenRows("day", DAYS)
    with pytest.raises(Exception, match="broken"):
        files.write_table(bad, path, ["day"], True, written.attach)
    assert files.partition_files(spark, path, "day") == before
    assert counted(spark, path, counts) == ({JAN: 3, MAR: 1}, False)


def loans_text(spark, rows):
    names = "loan_id, Customer_ID, loan_start_date, tenure, installment_num, loan_amt, due_amt, paid_amt, overdue_amt, balance, snapshot_date"
    rows = [(loan, "c", "2023-01-01", "10", n, "100", "10", "10", "0", "90", day) for loan, n, day in rows]
    return spark.createDataFrame(rows, ", ".join(f"{name} string" for name in names.split(", ")))


def reports(store, months):
    """Figures of all layers, and whether any stored row had to be read for them."""
    found, read = {}, []
    for layer in ("bronze", "silver", "gold"):
        df = backfill.run_report(store, months, layer)
        read += df.inputFiles()
        found |= {(r.layer, r.dataset, r.processing_date): (r.status, r.rows) for r in df.collect() if r.rows}
    stored = [f"{store.root}/{layer}/" for layer in ("bronze", "silver", "gold")]
    return found, any(path in file for path in stored for file in read)


def test_report_reads_no_layer_again(spark, tmp_path):
    store, months = backfill.Store(spark, str(tmp_path / "store")), month_calendar(spark, JAN, APR)
    loans = loans_text(spark, [("L", "0", "2023-01-01"), ("L", "1", "2023-02-01"), ("M", "0", "2023-01-01"), ("M", "2", "2023-03-01")])
    clicks = spark.createDataFrame([("c", "1", "2023-02-01"), ("d", "2", "2023-02-01")], "Customer_ID string, fe_1 string, snapshot_date string")
    backfill.run_bronze(store, {"loans": loans, "clickstream": clicks}, months)
    backfill.run_silver(store)
    backfill.run_features(store)
    for mob in (1, 2):
        backfill.run_labels(store, mob=mob)
    assert not store.log.failures()
    found, scanned = reports(store, months)
    assert not scanned
    layer = {("loans", JAN): 2, ("loans", FEB): 1, ("loans", MAR): 1} | {("clickstream", m): 2 for m in (JAN, FEB, MAR, APR)}
    expected = {(name, *key): ("done", n) for name in ("bronze", "silver") for key, n in layer.items()}
    # One spine customer in January; the other months take both customers of the clicks.
    expected |= {("gold", "feature_store", m): ("done", 1 if m == JAN else 2) for m in (JAN, FEB, MAR, APR)}
    expected |= {("gold", "label_store", FEB): ("done", 2), ("gold", "label_store", MAR): ("done", 1)}
    assert found == expected
    # Without the counts the data are read, for the same report.
    other = backfill.Store(spark, str(tmp_path / "store"), store.log)
    (tmp_path / "store" / "counts").rename(tmp_path / "kept")
    again, scanned = reports(other, months)
    assert scanned and again == expected


def test_report_after_a_run_of_one_month(spark, tmp_path):
    """Months that a run did not touch keep their counts; a failed job is reported as such."""
    store, months = backfill.Store(spark, str(tmp_path / "store")), month_calendar(spark, JAN, MAR)
    rows = [("L", "0", "2023-01-01"), ("L", "1", "2023-02-01"), ("M", "1", "2023-02-01")]
    backfill.run_bronze(store, {"loans": loans_text(spark, rows)}, months)
    backfill.run_bronze(store, {"loans": loans_text(spark, rows[:2])}, month_calendar(spark, FEB, FEB))
    found, scanned = reports(store, months)
    assert not scanned and found == {("bronze", "loans", JAN): ("done", 1), ("bronze", "loans", FEB): ("done", 1)}
    broken = loans_text(spark, rows).withColumn("loan_id", F.raise_error(F.lit("unreadable")).cast("string"))
    backfill.run_bronze(store, {"loans": broken}, months, DATASETS)
    report = backfill.run_report(store, months).collect()
    assert {(r.status, r.rows) for r in report} == {("failed", 0)} and "unreadable" in report[0].error
    assert {r.processing_date: r.rows for r in backfill.month_counts(store, "bronze", "loans").collect()} == {JAN: 1, FEB: 1}


def test_many_partitions_cost_a_row_no_more(spark, tmp_path):
    """One look-up per row, however many partitions are known; the counts of all of them are exact."""
    days = [JAN + dt.timedelta(days=i) for i in range(1500)]
    rows = [(day, x) for i, day in enumerate(days) for x in range(i % 3 + 1)]
    written = metrics.WrittenRows("day", {str(day) for day in days})
    observed = written.attach(table(spark, rows))
    assert observed._jdf.queryExecution().analyzed().toString().count("2023-") == 0
    observed.write.format("noop").mode("overwrite").save()
    assert written.rows() == {str(day): i % 3 + 1 for i, day in enumerate(days)}
