import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from vintagemill.config import DATASETS
from vintagemill.operators.calendar import month_calendar
from vintagemill.operators.store import feature_store
from vintagemill.plans import backfill, cli
from vintagemill.schemas import LOANS_TYPED
from vintagemill.sources import files

D = dt.date
JAN, FEB, MAR = D(2023, 1, 1), D(2023, 2, 1), D(2023, 3, 1)

CSV = {
    "loans": """loan_id,Customer_ID,loan_start_date,tenure,installment_num,loan_amt,due_amt,paid_amt,overdue_amt,balance,snapshot_date
L1,a,2023-01-01,10,0,1000,0,0,0,1000,2023-01-01
L1,a,2023-01-01,10,1,1000,100,0,100,1000,2/1/2023
L1,a,2023-01-01,10,2,1000,100,0,200,1000,2023-03-01
L2,b,2023-02-01,10,0,60000,0,0,0,60000,2023-02-01
""",
    "attributes": """Customer_ID,Name,Age,SSN,Occupation,snapshot_date
a,"Al ""x"", Jr",30_,123-45-6789,_Manager,1/1/2023
b,Bo,40,,Lawyer,2023-02-01
c,Cy,50,999,Cook,2023-03-01
""",
    "clickstream": """Customer_ID,fe_1,fe_2,snapshot_date
a,120,-1,2023-02-01
b,x,-5,2023-02-01
""",
}


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in CSV.items():
        (folder / DATASETS[name].source_file).write_text(text)
    return str(folder)


def run(spark, source, root, *args):
    base = ["--source", source, "--root", root, "--start", "2023-01-01", "--end", "2023-03-31"]
    return cli.main([*base, *args], spark)


def rows(df):
    stamps = [c for c in df.columns if c.endswith("_timestamp")]
    return sorted((r.asDict() for r in df.drop(*stamps).collect()), key=repr)


def test_all_layers(spark, source, tmp_path, capsys):
    root = str(tmp_path / "store")
    assert run(spark, source, root) == 0
    assert "bronze/financials: missing" in capsys.readouterr().out
    store = backfill.Store(spark, root)
    table = {(r.processing_date, r.Customer_ID): r for r in store.read("gold", "feature_store").collect()}
    # March has loans, but none at application: its customers come from the attributes.
    assert set(table) == {(JAN, "a"), (FEB, "b"), (MAR, "c")}
    jan, feb, mar = table[(JAN, "a")], table[(FEB, "b")], table[(MAR, "c")]
    assert (jan.max_requested_loan_amount, jan.occupation, jan.customer_age) == (1000.0, " Manager", None)
    assert (jan.clickstream_positive_activity, jan.engagement_level) == (120.0, "high")
    assert (feb.high_value_application, feb.ssn_valid_flag) == (1, None)
    assert feb.clickstream_negative_activity == -5.0
    assert (mar.num_active_loans_at_application, mar.engagement_level) == (None, None)
    assert mar.annual_income is None
    assert (jan.gold_processing_date, jan.feature_store_version, jan.feature_mob) == ("2023-01-01", "1.0", 0)
    labels = {(r.loan_id, r.snapshot_date): r.label for r in store.read("gold", "label_store").collect()}
    assert labels == {("L1", FEB): 1, ("L1", MAR): 1}
    name = store.month("silver", "attributes", JAN).collect()[0].Name
    assert name == 'Al "x", Jr'


def test_months_one_by_one_give_the_same_store(spark, source, tmp_path):
    whole, steps = str(tmp_path / "whole"), str(tmp_path / "steps")
    run(spark, source, whole)
    for month in ("2023-01-01", "2/1/2023", "2023-03-01"):
        assert cli.main(["--source", source, "--root", steps, "--snapshotdate", month], spark) == 0
    for table in ("feature_store", "label_store"):
        one, many = (rows(backfill.Store(spark, r).read("gold", table)) for r in (whole, steps))
        assert one == many
    one, many = (rows(backfill.Store(spark, r).months("silver", "clickstream")) for r in (whole, steps))
    assert one == many


def test_rerun_is_idempotent_and_leaves_other_months(spark, source, tmp_path):
    root = str(tmp_path / "store")
    run(spark, source, root)
    store = backfill.Store(spark, root)
    before = rows(store.read("gold", "feature_store"))
    january = sorted(glob.glob(f"{root}/bronze/loans/source_date=2023-01-01/*.parquet"))
    assert cli.main(["--source", source, "--root", root, "--snapshotdate", "2023-02-01"], spark) == 0
    assert rows(store.read("gold", "feature_store")) == before
    assert sorted(glob.glob(f"{root}/bronze/loans/source_date=2023-01-01/*.parquet")) == january


def test_fallback_date_is_stored_once(spark, source, tmp_path):
    root = str(tmp_path / "store")
    run(spark, source, root, "--layer", "bronze")
    stored = glob.glob(f"{root}/bronze/clickstream/source_date=*")
    assert [os.path.basename(p) for p in stored] == ["source_date=2023-02-01"]
    months = backfill.Store(spark, root).months("bronze", "clickstream")
    got = sorted((r.processing_date, r.Customer_ID, r.bronze_processing_date) for r in months.collect())
    assert got == [(m, c, m.isoformat()) for m in (JAN, FEB, MAR) for c in ("a", "b")]


def test_stored_store_equals_the_one_in_memory(spark, source, tmp_path):
    root = str(tmp_path / "store")
    run(spark, source, root)
    store = backfill.Store(spark, root)
    direct = feature_store(
        store.months("silver", "loans"),
        attributes=store.months("silver", "attributes"),
        clickstream=store.months("silver", "clickstream"),
    )
    stored = store.read("gold", "feature_store").select(*direct.columns)
    assert rows(stored) == rows(direct)


def test_buckets_change_no_result(spark, source, tmp_path):
    """A store laid out by customer, run twice, of which the second run lacks a month."""
    found = []
    for name, options in (("plain", []), ("bucketed", ["--buckets", "2"])):
        root = str(tmp_path / name)
        assert run(spark, source, root, *options) == 0
        store = backfill.Store(spark, root, buckets=2 if options else None)
        first = [rows(store.read("gold", table)) for table in ("feature_store", "label_store")]
        months = month_calendar(spark, FEB, FEB)
        loans = files.read_csv_strings(spark, f"{source}/{DATASETS['loans'].source_file}")
        backfill.run_bronze(store, {"loans": loans.where("Customer_ID = 'none'")}, months)
        backfill.run_silver(store, calendar=months)
        backfill.run_features(store)
        assert not store.log.failures()
        assert store.days("silver", "loans") == {"2023-01-01", "2023-03-01"}
        report = backfill.run_report(store, months, "gold")
        second = rows(store.read("gold", "feature_store"))
        found.append((first, second, rows(report)))
    assert found[0] == found[1] and all(found[0][0])


def test_undated_dataset_serves_every_month(spark, tmp_path):
    store = backfill.Store(spark, str(tmp_path / "store"))
    undated = spark.createDataFrame([("a", "30"), ("b", "40")], "Customer_ID string, Age string")
    backfill.run_bronze(store, {"attributes": undated}, month_calendar(spark, JAN, FEB))
    assert store.log.failures() == []
    got = sorted((r.processing_date, r.Customer_ID) for r in store.months("bronze", "attributes").collect())
    assert got == [(JAN, "a"), (JAN, "b"), (FEB, "a"), (FEB, "b")]


def test_report_of_a_broken_and_a_missing_dataset(spark, source, tmp_path):
    store = backfill.Store(spark, str(tmp_path / "store"))
    months = month_calendar(spark, JAN, D(2023, 4, 1))
    broken = spark.createDataFrame([(1,)], "snapshot_date int").withColumn("snapshot_date", F.array("snapshot_date"))
    sources = {
        "loans": f"{source}/{DATASETS['loans'].source_file}",
        "financials": f"{source}/absent.csv",
        "attributes": broken,
    }
    backfill.run_bronze(store, sources, months)
    assert [entry[1] for entry in store.log.failures()] == ["attributes"]
    report = {(r.dataset, r.processing_date): r for r in backfill.run_report(store, months).collect()}
    assert len(report) == 12
    assert (report[("loans", FEB)].status, report[("loans", FEB)].rows) == ("done", 2)
    assert report[("loans", D(2023, 4, 1))].status == "missing"
    assert report[("financials", JAN)].status == "missing"
    assert report[("attributes", JAN)].status == "failed"
    assert report[("attributes", JAN)].error
    inventory = backfill.partition_inventory(
        store, [("bronze", "loans", "source_date"), ("bronze", "financials", "source_date")]
    )
    assert [tuple(r) for r in inventory.collect()] == [("bronze", "loans", 3, 4, JAN, MAR)]


def test_run_without_any_input(spark, tmp_path):
    """Nothing to clean is a missing dataset; nothing to build gold from is an error."""
    store = backfill.Store(spark, str(tmp_path / "store"))
    backfill.run_silver(store)
    backfill.run_features(store)
    backfill.run_labels(store)
    backfill.run_labels(store, label_type="ever_in_window")
    statuses = {(layer, status) for layer, _, status, _ in store.log.entries}
    assert statuses == {("silver", "missing"), ("gold", "failed")}


@pytest.mark.parametrize("asked", [None, FEB])
def test_gold_without_input_deletes_nothing(spark, source, tmp_path, asked):
    root = str(tmp_path / "store")
    run(spark, source, root)
    store = backfill.Store(spark, root)
    backfill.run_labels(store, label_type="ever_in_window")
    tables = ("feature_store", "label_store", "loan_label_store")
    before = [rows(store.read("gold", name)) for name in tables]
    for name in DATASETS:
        if store.has("silver", name):
            days = {f.rsplit("=", 1)[1] for f in glob.glob(f"{root}/silver/{name}/source_date=*")}
            files.drop_partitions(spark, store.path("silver", name), "source_date", sorted(days))
    calendar = asked and month_calendar(spark, asked, asked)
    backfill.run_features(store, calendar=calendar)
    backfill.run_labels(store, calendar=calendar)
    backfill.run_labels(store, label_type="ever_in_window", calendar=calendar)
    assert len(store.log.failures()) == 3
    assert [rows(store.read("gold", name)) for name in tables] == before


def clicks_of(spark, *days):
    data = [(c, "5", "-1", day) for c, day in days]
    return spark.createDataFrame(data, "Customer_ID string, fe_1 string, fe_2 string, snapshot_date string")


def served(store, name="clickstream"):
    if not store.has("served", name):
        return {}
    return {r.processing_date: r.source_date for r in store.read("served", name).collect()}


def test_fallback_dataset_that_shrinks_or_empties(spark, tmp_path):
    store, months = backfill.Store(spark, str(tmp_path / "store")), month_calendar(spark, JAN, MAR)

    def again(clicks, calendar=months):
        backfill.run_bronze(store, {"clickstream": clicks}, calendar)
        backfill.run_silver(store, ["clickstream"], calendar)
        assert not store.log.failures()
        return served(store), store.days("bronze", "clickstream"), store.days("silver", "clickstream")

    both = {"2023-01-01", "2023-02-01"}
    full = clicks_of(spark, ("a", "2023-01-01"), ("b", "2023-02-01"))
    assert again(full) == ({JAN: JAN, FEB: FEB, MAR: FEB}, both, both)
    # January's rows go: its month takes February, and nothing takes January.
    assert again(clicks_of(spark, ("b", "2023-02-01")))[1:] == ({"2023-02-01"}, {"2023-02-01"})
    # One month alone is asked for; the others keep what they take.
    found = again(full, month_calendar(spark, JAN, JAN))
    assert found == ({JAN: JAN, FEB: FEB, MAR: FEB}, both, both)
    # An empty source serves no month any more.
    assert again(clicks_of(spark).limit(0), month_calendar(spark, FEB, MAR)) == ({JAN: JAN}, {"2023-01-01"}, {"2023-01-01"})
    assert again(clicks_of(spark).limit(0)) == ({}, set(), set())


def test_undated_dataset_moves_with_its_calendar(spark, tmp_path):
    store = backfill.Store(spark, str(tmp_path / "store"))
    undated = spark.createDataFrame([("a", "30")], "Customer_ID string, Age string")
    for start in (FEB, JAN):
        backfill.run_bronze(store, {"attributes": undated}, month_calendar(spark, start, MAR))
    assert served(store, "attributes") == {JAN: JAN, FEB: JAN, MAR: JAN}
    assert store.days("bronze", "attributes") == {"2023-01-01"}


def test_loan_labels_follow_their_loans(spark, source, tmp_path):
    store, months = backfill.Store(spark, str(tmp_path / "store")), month_calendar(spark, JAN, MAR)
    loans = files.read_csv_strings(spark, f"{source}/{DATASETS['loans'].source_file}")
    for part, labels in ((loans, 1), (loans.where("installment_num = '0'"), 0)):
        backfill.run_bronze(store, {"loans": part}, months)
        backfill.run_silver(store, ["loans"])
        for mob in (2, 3) if labels else (2,):
            backfill.run_labels(store, mob=mob, label_type="ever_in_window")
        assert not store.log.failures()
    # The definition that was run again is empty; the other one was not asked for.
    assert {r.label_def for r in store.read("gold", "loan_label_store").collect()} == {"30dpd_within_3mob"}


def test_bronze_reads_each_source_once(spark, tmp_path):
    """Emptied months are found from listings, not from a second scan."""
    store = backfill.Store(spark, str(tmp_path / "store"))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    loans = spark.createDataFrame([("L", "2023-01-01"), ("M", "2023-02-01")], "loan_id string, snapshot_date string")
    backfill.run_bronze(store, {"loans": loans.mapInArrow(counted, loans.schema)}, month_calendar(spark, JAN, MAR))
    assert not store.log.failures() and reads.value == 2


def test_csv_round_trip(spark, tmp_path):
    data = [('say "hi", ok', "1"), ("two\nlines", None), (None, "x")]
    df = spark.createDataFrame(data, "a string, b string")
    files.write_csv(df, str(tmp_path / "csv"))
    back = files.read_csv_strings(spark, str(tmp_path / "csv"), multiline=True)
    assert sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)


def test_typed_csv(spark, source):
    path = f"{source}/{DATASETS['loans'].source_file}"
    typed = files.read_csv_typed(spark, path, LOANS_TYPED)
    assert typed.schema == LOANS_TYPED
    assert typed.where("snapshot_date = date '2023-03-01'").collect()[0].overdue_amt == 200.0
    inferred = dict(files.read_csv_typed(spark, path).dtypes)
    assert inferred["tenure"] == "int"
    text = dict(files.read_csv_strings(spark, path).dtypes)
    assert set(text.values()) == {"string"}


def test_months_with_other_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    for month, column in ((JAN, "x"), (FEB, "y")):
        df = spark.range(1).select(F.lit(month).alias("processing_date"), F.lit(1).alias(column))
        files.write_table(df, path, ["processing_date"])
    merged = files.read_table(spark, path, merge_schema=True)
    assert sorted(merged.columns) == ["processing_date", "x", "y"]
    assert merged.count() == 2


def test_scratch_folder_follows_the_session():
    """The shared folder that the session names, else its warehouse, whatever the master."""

    class Session:
        def __init__(self, **conf):
            self.conf = type("Conf", (), {"get": staticmethod(lambda name, *default: conf.get(name, *default))})

    named = {"spark.checkpoint.dir": "hdfs://shared/tmp/", "spark.sql.warehouse.dir": "hdfs://wh"}
    assert files.scratch_folder(Session(**named)).startswith("hdfs://shared/tmp/vintagemill-")
    del named["spark.checkpoint.dir"]
    assert files.scratch_folder(Session(**named)).startswith("hdfs://wh/scratch/vintagemill-")


@pytest.mark.parametrize("month", [None, FEB])
def test_emptied_month_leaves_every_layer(spark, source, tmp_path, month):
    store = backfill.Store(spark, str(tmp_path / "store"))
    months = month_calendar(spark, JAN, MAR)
    loans = files.read_csv_strings(spark, f"{source}/{DATASETS['loans'].source_file}")
    backfill.run_bronze(store, {"loans": loans}, months)
    backfill.run_silver(store, ["loans"])
    for mob in (1, 2):
        backfill.run_labels(store, mob=mob)
    backfill.run_features(store, mob=0)
    days = {name: {r.processing_date for r in store.read("gold", name).collect()} for name in ("label_store", "feature_store")}
    assert FEB in days["label_store"] and FEB in days["feature_store"]
    asked = month_calendar(spark, month or JAN, month or MAR)
    less = loans.where("snapshot_date not in ('2/1/2023', '2023-02-01')")
    backfill.run_bronze(store, {"loans": less}, asked)
    backfill.run_silver(store, ["loans"], asked)
    backfill.run_labels(store, mob=2, calendar=month and asked)
    backfill.run_features(store, mob=0, calendar=month and asked)
    assert not store.log.failures()
    assert FEB not in {r.source_date for r in store.read("silver", "loans").collect()}
    left = {(r.label_def, r.processing_date) for r in store.read("gold", "label_store").collect()}
    # The other definition was not run again and keeps its month.
    assert {d for name, d in left if name.endswith("2mob")} == days["label_store"] - {FEB}
    assert FEB in {d for name, d in left if name.endswith("1mob")}
    assert {r.processing_date for r in store.read("gold", "feature_store").collect()} == days["feature_store"] - {FEB}
