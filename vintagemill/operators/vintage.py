"""Vintage analysis: bad rate by month-on-book and how it moves."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DPD_THRESHOLD
from ..functions.arithmetic import flag, percent

# Names under which sources carry days past due, in order of preference.
# The names under which days past due are looked for.
DPD_COLUMNS = ("dpd", "DPD", "Dpd", "days_past_due", "DaysPastDue")
STABLE_CHANGE = 0.01


def dpd_column(df: DataFrame) -> str:
    """The first known days-past-due column of a frame."""
    for name in DPD_COLUMNS:
        if name in df.columns:
            return name
    raise ValueError(f"no days-past-due column among {df.columns}")


def cohort_filter(loans: DataFrame, started_before: dt.date) -> DataFrame:
    """Loans that started before a cutoff."""
    return loans.where(F.col("loan_start_date") < F.lit(started_before))


def matured_loans(loans: DataFrame, installment: int = 10) -> DataFrame:
    """Rows at the last installment."""
    return loans.where(F.col("installment_num") == installment)


def bad_rate_rows(
    loans: DataFrame, dpd: int = DPD_THRESHOLD, by: Sequence[str] = ()
) -> DataFrame:
    """Share of rows at or over the threshold by month-on-book."""
    bad = flag(F.col(dpd_column(loans)) >= dpd)
    return (
        loans.where(F.col("mob").isNotNull())
        .groupBy(*by, "mob")
        .agg(F.count(F.lit(1)).alias("rows"), F.avg(bad).alias("bad_rate"))
        .orderBy(*by, "mob")
    )


def bad_rate_loans(
    loans: DataFrame, dpd: int = DPD_THRESHOLD, by: Sequence[str] = ()
) -> DataFrame:
    """Share of distinct loans that reach the threshold at each month-on-book.

    Loans are folded to one row per month-on-book first, so the distinct counts
    become plain sums.  Rows without a loan id count for nothing.
    """
    bad = flag(F.col(dpd_column(loans)) >= dpd)
    per_loan = (
        loans.where(F.col("mob").isNotNull())
        .groupBy(*by, "mob", "loan_id")
        .agg(F.max(bad).alias("bad"))
    )
    known_bad = flag(F.col("loan_id").isNotNull() & (F.col("bad") == 1))
    counted = per_loan.groupBy(*by, "mob").agg(
        F.count("loan_id").alias("total_loans"), F.sum(known_bad).alias("bad_loans")
    )
    rate = F.coalesce(F.try_divide("bad_loans", "total_loans"), F.lit(0.0))
    return counted.withColumn("bad_rate", rate).orderBy(*by, "mob")


def bad_rate_mom(rates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Change of the bad rate from one month-on-book to the next.

    ``rates`` has one row per month-on-book and group, a few dozen per group.
    """
    in_order = Window.partitionBy(*(by or [F.lit(1)])).orderBy("mob")
    change = F.col("bad_rate") - F.lag("bad_rate").over(in_order)
    return rates.withColumn("mom_change", change)


def bad_rate_growth(rates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First and last bad rate with absolute and relative growth.

    The initial rate is that of month-on-book 0, null where there is none; growth
    from an initial rate of zero is infinite.
    """
    initial, final = F.col("initial_rate"), F.col("final_rate")
    growth = final - initial
    return (
        rates.groupBy(*by)
        .agg(
            F.max(F.when(F.col("mob") == 0, F.col("bad_rate"))).alias("initial_rate"),
            F.max("mob").alias("final_mob"),
            F.max_by("bad_rate", "mob").alias("final_rate"),
        )
        .withColumns(
            {
                "growth": growth,
                "growth_pct": F.when(initial > 0, percent(growth, initial)).when(
                    initial.isNotNull(), F.lit(float("inf"))
                ),
            }
        )
    )


def bad_rate_stabilization(
    rates: DataFrame, by: Sequence[str] = (), change: float = STABLE_CHANGE
) -> DataFrame:
    """The first month-on-book whose rate moved by less than ``change``."""
    settled = F.when(F.abs("mom_change") < change, F.col("mob"))
    return bad_rate_mom(rates, by).groupBy(*by).agg(F.min(settled).alias("stabilization_mob"))


def bad_rate_peak_change(rates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The largest month-on-month increase, the earliest one on ties."""
    moved = bad_rate_mom(rates, by).where("mom_change is not null")
    peak = F.max(F.struct("mom_change", (-F.col("mob")).alias("minus_mob")))
    return (
        moved.groupBy(*by)
        .agg(peak.alias("peak"))
        .select(
            *by,
            (-F.col("peak.minus_mob")).alias("max_change_mob"),
            F.col("peak.mom_change").alias("max_change"),
        )
    )
