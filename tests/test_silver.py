import datetime as dt

import pytest

from vintagemill.operators import silver

D = dt.date
LOAN = {
    "loan_id": "L1",
    "Customer_ID": "C1",
    "loan_start_date": "2022-12-01",
    "tenure": "10",
    "installment_num": "3",
    "loan_amt": "1000",
    "due_amt": "100",
    "paid_amt": "0",
    "overdue_amt": "100",
    "balance": "700",
    "snapshot_date": "2023-03-01",
}


def rows(spark, *records):
    names = list(records[0])
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([tuple(r[n] for n in names) for r in records], schema)


def loan(spark, clean=silver.silver_loans, **changes):
    options = {k: changes.pop(k) for k in ("amount_type",) if k in changes}
    row = clean(rows(spark, LOAN | changes), **options).collect()[0]
    return row.installments_missed, row.first_missed_date, row.dpd


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({}, (1, D(2023, 2, 1), 28)),
        ({"snapshot_date": "2/1/2023"}, (1, D(2023, 1, 1), 31)),
        ({"due_amt": "0", "overdue_amt": "50"}, (0, None, None)),
        ({"due_amt": None, "overdue_amt": "50"}, (0, None, None)),
        ({"due_amt": "-5", "overdue_amt": "50"}, (0, None, None)),
        ({"overdue_amt": "0"}, (0, None, 0)),
        ({"overdue_amt": None}, (None, None, 0)),
        ({"overdue_amt": "101"}, (2, D(2023, 1, 1), 59)),
        ({"due_amt": "0.03", "overdue_amt": "0.09"}, (4, D(2022, 11, 1), 120)),
        ({"due_amt": "0.03", "overdue_amt": "0.09", "amount_type": "decimal"}, (3, D(2022, 12, 1), 90)),
        ({"snapshot_date": "3/31/2023"}, (1, D(2023, 2, 28), 31)),
    ],
)
def test_days_past_due(spark, ansi, changes, expected):
    assert loan(spark, **changes) == expected


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({}, (1, D(2023, 2, 1), 28)),
        ({"due_amt": "0", "overdue_amt": "50"}, (0, None, None)),
        ({"due_amt": None, "overdue_amt": "50"}, (0, None, None)),
        ({"overdue_amt": None}, (0, None, 0)),
    ],
)
def test_small_variant(spark, ansi, changes, expected):
    assert loan(spark, silver.silver_loans_small, **changes) == expected


def test_small_variant_turns_null_month_on_book_into_zero(spark):
    df = rows(spark, LOAN | {"installment_num": None, "loan_amt": None})
    assert silver.silver_loans(df).select("mob", "loan_amt").collect()[0] == (None, None)
    small = silver.silver_loans_small(df).select("mob", "installment_num", "loan_amt")
    assert small.collect()[0] == (0, 0, 0.0)


def test_loan_types(spark):
    types = dict(silver.silver_loans(rows(spark, LOAN)).dtypes)
    assert types["tenure"] == types["mob"] == types["dpd"] == "int"
    assert types["installments_missed"] == "int"
    assert {types[c] for c in silver.LOAN_AMOUNTS} == {"float"}
    assert types["loan_start_date"] == types["first_missed_date"] == "date"


def test_financials(spark, ansi):
    raw = rows(
        spark,
        {
            "Customer_ID": "C1",
            "Type_of_Loan": "!@9#%8",
            "Annual_Income": "1000_",
            "Monthly_Inhand_Salary": "0",
            "Outstanding_Debt": "_-250_",
            "Total_EMI_per_month": "12",
            "snapshot_date": "1/5/2023",
        },
    )
    row = silver.silver_financials(raw).collect()[0]
    assert row.Type_of_Loan == "!98"
    assert row.Annual_Income == 1000.0
    assert row.debt_to_income_ratio == -0.25
    assert row.monthly_debt_service_ratio is None
    assert row.snapshot_date == D(2023, 1, 5)


def test_attributes(spark, ansi):
    raw = rows(
        spark,
        {"Name": " Al E. Ho9 ", "Age": "23_", "SSN": None, "Occupation": None, "snapshot_date": None},
        {
            "Name": None,
            "Age": "40",
            "SSN": "123-45-6789",
            "Occupation": "_Manager",
            "snapshot_date": "2023-01-01",
        },
    )
    first, second = silver.silver_attributes(raw).collect()
    assert (first.Name, first.Name_cleaned, first.Age) == ("Al E. Ho9", "Al E Ho", None)
    assert (first.SSN_is_valid, first.SSN_cleaned, first.Occupation) == (None, "CORRUPTED", None)
    assert (second.SSN_is_valid, second.SSN_cleaned) == (True, "123-45-6789")
    assert (second.Age, second.Occupation) == (40, " Manager")


def test_attributes_without_optional_columns(spark):
    df = silver.silver_attributes(rows(spark, {"Customer_ID": "C1", "Age": "30"}))
    assert df.columns == ["Customer_ID", "Age"]


def test_clickstream(spark, ansi):
    raw = rows(
        spark,
        {"Customer_ID": "C1", "fe_1": "2", "fe_2": "-1", "fe_3": None},
        {"Customer_ID": "C2", "fe_1": "0", "fe_2": "-1", "fe_3": "x"},
    )
    first, second = silver.silver_clickstream(raw).collect()
    assert (first.total_positive_features, first.total_negative_features) == (2.0, -1.0)
    assert first.feature_balance_ratio == -0.5
    assert (second.total_positive_features, second.feature_balance_ratio) == (0.0, None)


def test_clickstream_without_features(spark):
    df = silver.silver_clickstream(rows(spark, {"Customer_ID": "C1"}))
    assert df.columns == ["Customer_ID"]


def test_no_cleaner_is_too_long_to_be_compiled(spark, tmp_path, capsys):
    """The JVM only interprets methods beyond 8,000 bytes, so a stage of all numbers must stay below."""
    names = ("Customer_ID", *silver.FINANCIAL_TEXT, *silver.FINANCIAL_NUMBERS, "snapshot_date")
    path = str(tmp_path / "raw")
    rows(spark, dict.fromkeys(names, "1")).write.parquet(path)
    silver.silver_financials(spark.read.parquet(path)).explain("codegen")
    sizes = [int(part.split(";")[0]) for part in capsys.readouterr().out.split("maxMethodCodeSize:")[1:]]
    assert all(size <= 8000 for size in sizes)
