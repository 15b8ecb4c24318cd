"""Gold feature builders: one wide set of columns per customer and source."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FEATURE_MOB
from ..functions.arithmetic import flag, ratio_if_positive
from .silver import FEATURE_PREFIX

KEYS = ("processing_date", "Customer_ID")

# Fixed values of the scores.
HIGH_VALUE_AMOUNT = 50_000
HIGH_STABILITY = ("Lawyer", "Engineer", "Doctor", "Teacher", "Accountant", "Scientist")
MEDIUM_STABILITY = ("Manager", "Architect", "Developer", "Analyst")
HIGH_LEVERAGE = 0.7

# Fixed column names: silver name and feature store name.
FINANCIAL_NAMES = {
    "Annual_Income": "annual_income",
    "Monthly_Inhand_Salary": "monthly_salary",
    "Num_Bank_Accounts": "num_bank_accounts",
    "Num_Credit_Card": "num_credit_cards",
    "Interest_Rate": "existing_avg_interest_rate",
    "Num_of_Loan": "external_loans_count",
    "Outstanding_Debt": "total_outstanding_debt",
    "Credit_Utilization_Ratio": "credit_utilization",
    "Total_EMI_per_month": "monthly_emi",
    "Amount_invested_monthly": "monthly_investment",
    "Monthly_Balance": "monthly_balance",
    "debt_to_income_ratio": "debt_to_income_ratio",
    "monthly_debt_service_ratio": "monthly_debt_service_ratio",
}
ATTRIBUTE_NAMES = {
    "Age": "customer_age",
    "SSN_is_valid": "ssn_valid_flag",
    "Occupation": "occupation",
}
CLICKSTREAM_NAMES = {
    "total_positive_features": "clickstream_positive_activity",
    "total_negative_features": "clickstream_negative_activity",
    "feature_balance_ratio": "clickstream_balance_ratio",
}


def mob_filter(loans: DataFrame, mob: int = FEATURE_MOB) -> DataFrame:
    return loans.where(F.col("mob") == mob)


# Partial aggregates of a group of loans: the aggregate, its column, and how the
# partials of one customer merge.
LOAN_PARTIALS: dict[str, tuple[Callable, str, Callable]] = {
    "_loans": (F.count, "loan_id", F.sum),
    "_amount_max": (F.max, "loan_amt", F.max),
    "_amount_sum": (F.sum, "loan_amt", F.sum),
    "_amount_n": (F.count, "loan_amt", F.sum),
    "_tenure_max": (F.max, "tenure", F.max),
    "_tenure_sum": (F.sum, "tenure", F.sum),
    "_tenure_n": (F.count, "tenure", F.sum),
    "_balance_max": (F.max, "balance", F.max),
    "_balance_sum": (F.sum, "balance", F.sum),
    "_balance_n": (F.count, "balance", F.sum),
}


def loan_partials(loans: DataFrame, keys: Sequence[str], mob: int = FEATURE_MOB) -> DataFrame:
    """Loans at ``mob`` pre-aggregated by ``keys``."""
    aggregates = [agg(c).alias(name) for name, (agg, c, _) in LOAN_PARTIALS.items()]
    return mob_filter(loans, mob).groupBy(*keys).agg(*aggregates)


def loan_feature_columns() -> dict[str, Column]:
    """Application features from the partials, null where a group has no loans."""
    count, amount = F.col("_loans"), F.col("_amount_max")
    average = F.try_divide("_amount_sum", "_amount_n")
    return {
        "num_active_loans_at_application": count,
        "max_requested_loan_amount": amount,
        "avg_requested_loan_amount": average,
        "max_requested_tenure": F.col("_tenure_max"),
        "avg_requested_tenure": F.try_divide("_tenure_sum", "_tenure_n"),
        # The largest balance, not a total: the name is part of the contract.
        "initial_total_balance": F.col("_balance_max"),
        "avg_initial_balance": F.try_divide("_balance_sum", "_balance_n"),
        "total_loan_exposure_at_application": count * average,
        "multiple_loans_flag": F.when(count.isNotNull(), flag(count > 1)),
        "high_value_application": F.when(count.isNotNull(), flag(amount >= HIGH_VALUE_AMOUNT)),
    }


def loan_application_features(
    loans: DataFrame, mob: int = FEATURE_MOB, keys: Sequence[str] = KEYS
) -> DataFrame:
    """One row per customer and month: count, amounts, tenures and balances applied for."""
    columns = [c.alias(name) for name, c in loan_feature_columns().items()]
    return loan_partials(loans, keys, mob).select(*keys, *columns)


def _banded(c: Column, bands: Sequence[tuple[float, object]], otherwise: object) -> Column:
    """Value of the first band whose upper bound is at least ``c``."""
    (bound, value), *rest = bands
    chain = F.when(c <= bound, value)
    for bound, value in rest:
        chain = chain.when(c <= bound, value)
    return chain.otherwise(otherwise)


def financial_features(financials: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    named = financials.select(*keys, *[F.col(c).alias(n) for c, n in FINANCIAL_NAMES.items()])
    dti = F.col("debt_to_income_ratio")
    salary = F.col("monthly_salary")
    discretionary = salary - F.col("monthly_emi")
    return named.withColumns(
        {
            "financial_health_score": _banded(
                dti, [(0.3, 5), (0.5, 4), (0.7, 3), (1.0, 2)], otherwise=1
            ),
            "liquidity_ratio": ratio_if_positive(F.col("monthly_balance"), salary),
            "investment_ratio": ratio_if_positive(
                F.col("monthly_investment"), salary, otherwise=F.lit(0.0)
            ),
            "discretionary_income": discretionary,
            "savings_capacity_ratio": ratio_if_positive(
                discretionary, salary, otherwise=F.lit(0.0)
            ),
            "credit_product_diversity": F.col("num_bank_accounts")
            + F.col("num_credit_cards")
            + F.col("external_loans_count"),
            "high_leverage_flag": flag(dti > HIGH_LEVERAGE),
        }
    )


def attribute_features(attributes: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    named = attributes.select(*keys, *[F.col(c).alias(n) for c, n in ATTRIBUTE_NAMES.items()])
    age, occupation = F.col("customer_age"), F.col("occupation")
    return named.withColumns(
        {
            # An unknown age counts as senior.
            "age_risk_category": _banded(
                age,
                [(25, "young"), (35, "young_adult"), (50, "middle_age"), (65, "mature")],
                otherwise="senior",
            ),
            "occupation_stability_score": F.when(occupation.isin(*HIGH_STABILITY), 5)
            .when(occupation.isin(*MEDIUM_STABILITY), 3)
            .when(occupation.isNotNull(), 2)
            .otherwise(1),
            "financial_maturity_score": _banded(
                age, [(24, 2), (29, 4), (55, 5), (65, 4)], otherwise=3
            ),
        }
    )


def clickstream_features(
    clickstream: DataFrame, keys: Sequence[str] = KEYS, ratio: str = "signed"
) -> DataFrame:
    """Engagement features; ``ratio="magnitude"`` scores on the size of the balance ratio.

    The balance ratio is never positive, so the signed scores are constant.
    """
    raw = [c for c in clickstream.columns if c.startswith(FEATURE_PREFIX)]
    named = clickstream.select(
        *keys,
        *[F.col(c).alias(n) for c, n in CLICKSTREAM_NAMES.items()],
        *[F.col(c).alias(f"clickstream_{c}") for c in raw],
    )
    activity = F.col("clickstream_positive_activity")
    signed = F.col("clickstream_balance_ratio")
    balance = {"signed": signed, "magnitude": F.abs(signed)}[ratio]
    return named.withColumns(
        {
            "engagement_level": F.when(activity >= 100, "high")
            .when(activity >= 50, "medium")
            .otherwise("low"),
            "engagement_quality_score": F.when(balance >= 0.8, 5)
            .when(balance >= 0.6, 4)
            .when(balance >= 0.4, 3)
            .when(balance >= 0.2, 2)
            .otherwise(1),
            "thorough_researcher": flag((activity >= 50) & (balance >= 0.6)),
        }
    )
