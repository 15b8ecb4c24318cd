import datetime as dt

import pytest

from vintagemill.operators.calendar import month_calendar
from vintagemill.plans import arrival, backfill

JAN, MAR = dt.date(2023, 1, 1), dt.date(2023, 3, 1)
COLUMNS = ["loan_id", "snapshot_date"]
FILES = [
    "L1,2023-01-01\nL2,2/1/2023\n",
    "L1,2023-02-01\nL1,2023-02-01\n",  # equal rows stay two
    "L3,2023-03-01\n",
    "L4,2023-01-01\nL9,2024-01-01\n",  # outside the calendar
]
ROWS = [("L1", 1), ("L1", 2), ("L1", 2), ("L2", 2), ("L3", 3), ("L4", 1)]


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "in").mkdir()
    store = backfill.Store(spark, str(tmp_path / "store"))

    def land(*numbers):
        for i in numbers:
            (tmp_path / "in" / f"f{i}.csv").write_text("loan_id,snapshot_date\n" + FILES[i])

    def run(checkpoint="one", **options):
        months = month_calendar(spark, JAN, MAR)
        arrival.stream_bronze(
            store, "loans", str(tmp_path / "in"), COLUMNS, months, str(tmp_path / checkpoint), files_per_batch=2, **options
        )
        return rows(store)

    return store, land, run


def rows(store):
    return sorted((r.loan_id, r.processing_date.month) for r in store.months("bronze", "loans").collect())


def test_files_in_several_runs(place):
    store, land, run = place
    land(0, 1)
    assert run() == [r for r in ROWS if r[0] in ("L1", "L2")]
    assert run() == [r for r in ROWS if r[0] in ("L1", "L2")]
    land(2, 3)
    assert run() == ROWS
    assert arrival.ledger(store, "loans").count() == 4


@pytest.mark.parametrize("checkpoint", ["one", "another"])
def test_restart_in_the_middle(place, checkpoint):
    """A batch whose rows are stored but not its files; with the same checkpoint and with a lost one."""
    store, land, run = place
    land(0, 1, 2, 3)
    calls = []

    def fail(name):
        calls.append(name)
        if len(calls) == 2:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run(before_ledger=fail)
    # A new file makes a stream without its checkpoint deal the files in another way.
    assert run(checkpoint) == ROWS
    assert run("third") == ROWS
    assert arrival.ledger(store, "loans").count() == 4


def test_unfit_dataset(place):
    store, _, _ = place
    with pytest.raises(ValueError, match="own rows"):
        arrival.stream_bronze(store, "clickstream", "x", ["Customer_ID", "snapshot_date"], None, "y")
