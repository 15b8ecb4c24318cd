"""Silver layer: typed and cleaned tables with their derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.arithmetic import negative_part, positive_part, ratio_if_positive, row_sum
from ..functions.parsing import (
    age_in_range,
    clean_number,
    clean_occupation,
    clean_text,
    is_valid_ssn,
    iso_text,
    letters_only,
    parse_date,
    parse_int,
)

# Fixed column lists of the source datasets.
LOAN_TEXT = ("loan_id", "Customer_ID")
LOAN_INTS = ("tenure", "installment_num")
LOAN_AMOUNTS = ("loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance")
LOAN_DATES = ("loan_start_date", "snapshot_date")
FINANCIAL_TEXT = ("Type_of_Loan", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour")
FINANCIAL_NUMBERS = (
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
)
FEATURE_PREFIX = "fe_"

# Storage type of loan amounts: 32-bit float, or exact cents.
AMOUNT_TYPES = {"float": "float", "decimal": "decimal(18,2)"}


def _present(df: DataFrame, rules: dict[str, Column]) -> dict[str, Column]:
    """The rules whose column exists; source columns are optional."""
    return {name: rule for name, rule in rules.items() if name in df.columns}


def typed_loans(df: DataFrame, amount_type: str = "float") -> DataFrame:
    amount = AMOUNT_TYPES[amount_type]
    rules = {c: F.col(c).cast("string") for c in LOAN_TEXT}
    rules |= {c: parse_int(F.col(c).cast("string")) for c in LOAN_INTS}
    rules |= {c: F.col(c).try_cast(amount) for c in LOAN_AMOUNTS}
    rules |= {c: parse_date(F.col(c).cast("string")) for c in LOAN_DATES}
    return df.withColumns(_present(df, rules)).withColumn("mob", F.col("installment_num"))


def _missed_installments(guarded: bool) -> Column:
    due, overdue = F.col("due_amt"), F.col("overdue_amt")
    missed = F.ceil(F.try_divide(overdue, due))
    if guarded:
        missed = F.when(due > 0, missed).otherwise(0)
    return missed.try_cast("int")


def with_days_past_due(df: DataFrame) -> DataFrame:
    """``first_missed_date`` and ``dpd`` from ``installments_missed``.

    Days are calendar days back from the snapshot month, so one missed
    installment is 28 to 31 days.  An overdue row without a missed installment
    has a null ``dpd``.
    """
    missed, snapshot = F.col("installments_missed"), F.col("snapshot_date")
    return df.withColumn(
        "first_missed_date", F.when(missed > 0, F.add_months(snapshot, -missed))
    ).withColumn(
        "dpd",
        F.when(F.col("overdue_amt") > 0, F.datediff(snapshot, "first_missed_date")).otherwise(0),
    )


def silver_loans(df: DataFrame, amount_type: str = "float") -> DataFrame:
    """Typed loans with month-on-book, missed installments and days past due."""
    typed = typed_loans(df, amount_type)
    missed = typed.withColumn("installments_missed", _missed_installments(guarded=True))
    return with_days_past_due(missed)


def silver_loans_small(df: DataFrame, amount_type: str = "float") -> DataFrame:
    """The loans-only variant: no guard on the due amount, null numbers become zero.

    The zero fill covers every numeric column and comes after ``mob`` is set, so
    a row without an installment number lands at month-on-book 0.
    """
    typed = typed_loans(df, amount_type)
    missed = typed.withColumn("installments_missed", _missed_installments(guarded=False))
    numeric = [f.name for f in missed.schema.fields if isinstance(f.dataType, NumericType)]
    return with_days_past_due(missed.fillna(0, subset=numeric))


def silver_financials(df: DataFrame) -> DataFrame:
    """Cleaned texts and numbers with debt-to-income and debt-service ratios."""
    rules = {c: clean_text(F.col(c)) for c in FINANCIAL_TEXT}
    rules |= {c: clean_number(F.col(c)) for c in FINANCIAL_NUMBERS}
    rules["snapshot_date"] = parse_date(F.col("snapshot_date"))
    cleaned = df.withColumns(_present(df, rules))
    salary = F.col("Monthly_Inhand_Salary")
    return cleaned.withColumns(
        {
            "debt_to_income_ratio": ratio_if_positive(
                F.col("Outstanding_Debt"), F.col("Annual_Income")
            ),
            "monthly_debt_service_ratio": ratio_if_positive(F.col("Total_EMI_per_month"), salary),
        }
    )


def silver_attributes(df: DataFrame) -> DataFrame:
    """Cleaned names, plausible ages, checked SSNs and letter-only occupations."""
    rules = {
        "Name": F.trim("Name"),
        "Age": age_in_range(F.col("Age")),
        "Occupation": clean_occupation(F.col("Occupation")),
        "snapshot_date": parse_date(F.col("snapshot_date")),
    }
    derived = {}
    if "Name" in df.columns:
        derived["Name_cleaned"] = letters_only(F.trim("Name"))
    if "SSN" in df.columns:
        ssn = F.col("SSN")
        derived["SSN_is_valid"] = is_valid_ssn(ssn)
        derived["SSN_cleaned"] = F.when(is_valid_ssn(ssn), ssn).otherwise("CORRUPTED")
    return df.withColumns(_present(df, rules) | derived)


def silver_clickstream(df: DataFrame) -> DataFrame:
    """Numeric ``fe_*`` columns with the sums of their positive and negative parts."""
    features = [c for c in df.columns if c.startswith(FEATURE_PREFIX)]
    rules = {c: F.col(c).try_cast("double") for c in features}
    rules |= _present(df, {"snapshot_date": parse_date(F.col("snapshot_date"))})
    typed = df.withColumns(rules) if rules else df
    if not features:
        return typed
    positive = F.col("total_positive_features")
    return typed.withColumns(
        {
            "total_positive_features": row_sum([positive_part(F.col(c)) for c in features]),
            "total_negative_features": row_sum([negative_part(F.col(c)) for c in features]),
        }
    ).withColumn(
        "feature_balance_ratio",
        F.when(positive != 0, F.try_divide("total_negative_features", positive)),
    )


def with_silver_metadata(df: DataFrame, processing_date: Column) -> DataFrame:
    return df.withColumns(
        {
            "silver_processing_timestamp": F.current_timestamp(),
            "silver_processing_date": iso_text(processing_date),
        }
    )


CLEANERS = {
    "loans": silver_loans,
    "financials": silver_financials,
    "attributes": silver_attributes,
    "clickstream": silver_clickstream,
}
