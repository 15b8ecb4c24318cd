"""Adapters: the star-schema tables as raw, all-text source datasets.

The tables are clean, so the adapters add the dirt the cleaners are made for, by
fixed rules on the keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.parsing import iso_text

# Event types in alphabetical order; the i-th feeds ``fe_i``.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
# Occupations by customer key modulo eight; the last one is null.
OCCUPATIONS = (
    "Lawyer",
    "Engineer",
    "Manager",
    "Media_Manager",
    "Developer",
    "_______",
    "_Manager",
    None,
)
CENTS = "decimal(18,2)"
# Smaller doubles may have a fraction.
_EXACT = 2.0**52
LAST_INSTALLMENT = 6
# The first month with orders and the last one in which a loan can report.
FIRST_MONTH = dt.date(1995, 1, 1)
LAST_MONTH = dt.date(2002, 2, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rounded(c: Column) -> Column:
    """``round`` of a double, half away from zero.

    Twice a value below 2^52 and its floor are exact, so that nothing goes through decimal numbers, which
    cost most of a row; the rest is left to ``round``.
    """
    size = F.shiftright(F.floor(F.abs(c) * 2) + 1, 1)
    return F.when(F.abs(c) < _EXACT, F.signum(c) * size + 0.0).otherwise(F.round(c))


def _text(c: Column) -> Column:
    """Text of a double without a fraction."""
    return c.cast("bigint").cast("string")


def _whole(c: Column) -> Column:
    return _text(F.round(c))


def _divides(key: Column, n: int) -> Column:
    return key % n == 0


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw loan row per order and line number; the line number is the month."""
    items = (
        # Partitioned by order, the lines serve the aggregation and the join with one shuffle.
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_discount", "l_returnflag", "l_extendedprice")
        .repartition("l_orderkey")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.min("l_discount").alias("min_discount"),
            F.max(
                F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).otherwise(0.0)
            ).alias("returned"),
        )
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_totalprice", "o_orderdate"
    )
    # Each number is rounded once per row.
    numbers = items.join(orders, "l_orderkey").select(
        "l_orderkey",
        "o_custkey",
        "o_orderdate",
        "min_discount",
        (F.col("l_linenumber") - 1).alias("month"),
        _rounded(F.col("o_totalprice")).alias("price"),
        _rounded(F.col("o_totalprice") / 10).alias("installment"),
        _rounded(F.col("returned") / 4).alias("overdue"),
    )
    month, overdue = F.col("month"), F.col("overdue")
    due = F.when(F.col("min_discount") == 0, 0.0).otherwise(F.col("installment"))
    return numbers.select(
        F.concat(F.lit("L"), "l_orderkey").alias("loan_id"),
        F.concat(F.lit("C"), "o_custkey").alias("Customer_ID"),
        iso_text(F.col("o_orderdate")).alias("loan_start_date"),
        F.lit("10").alias("tenure"),
        month.cast("string").alias("installment_num"),
        _text(F.col("price")).alias("loan_amt"),
        _text(due).alias("due_amt"),
        _text(F.when(overdue > 0, 0.0).otherwise(due)).alias("paid_amt"),
        _text(overdue).alias("overdue_amt"),
        _text(F.col("price") - month * F.col("installment")).alias("balance"),
        iso_text(F.add_months(F.trunc("o_orderdate", "MM"), month)).alias("snapshot_date"),
    )


def _customer_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in each month they order, with their open debt over all orders.

    Orders fold to one row per customer and month before anything moves by
    customer, so a customer holds at most one row per calendar month.  A
    customer without orders keeps one row without a month.
    """
    open_price = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice").cast(CENTS))
    monthly = (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_custkey").alias("c_custkey"), F.trunc("o_orderdate", "MM").alias("month")
        )
        .agg(F.coalesce(F.sum(open_price), F.lit(0).cast(CENTS)).alias("open_price"))
    )
    total = F.sum("open_price").over(Window.partitionBy("c_custkey"))
    months = monthly.select("c_custkey", "month", total.alias("open_debt"))
    # Partitioned by the join key, so that the wide text rules run in many tasks.
    customers = table(spark, sf_dir, "customer").repartition("c_custkey")
    return customers.join(months, "c_custkey", "left")


def _snapshot_text() -> Column:
    """ISO text for even customer keys, month/day/year text for odd ones."""
    month = F.col("month")
    slashed = F.date_format(month, "M/d/yyyy")
    return F.when(_divides(F.col("c_custkey"), 2), iso_text(month)).otherwise(slashed)


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    age = (key * 7 % 100 + 10).cast("string")
    aged = F.when(_divides(key, 11), F.concat(age, F.lit("_"))).otherwise(age)
    digits = F.lpad((key % 1_000_000_000).cast("string"), 9, "0")
    parts = [F.substring(digits, *span) for span in ((1, 3), (4, 2), (6, 4))]
    occupation = F.lit(None).cast("string")
    for i, name in enumerate(OCCUPATIONS):
        if name is not None:
            occupation = F.when(key % 8 == i, name).otherwise(occupation)
    return _customer_months(spark, sf_dir).select(
        F.concat(F.lit("C"), key).alias("Customer_ID"),
        F.col("c_name").alias("Name"),
        F.when(~_divides(key, 17), aged).alias("Age"),
        F.when(_divides(key, 13), "#F%$D@*&8")
        .when(~_divides(key, 19), F.concat_ws("-", *parts))
        .alias("SSN"),
        occupation.alias("Occupation"),
        _snapshot_text().alias("snapshot_date"),
    )


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    debt = F.col("open_debt").cast("double") / 50

    def dirty(value: Column, every: int) -> Column:
        return F.when(_divides(key, every), F.concat(value, F.lit("_"))).otherwise(value)

    def small(multiplier: int, modulus: int, start: int = 0) -> Column:
        return (key * multiplier % modulus + start).cast("string")

    def dashed(value: Column) -> Column:
        return F.when(_divides(key, 29), "-").otherwise(value)

    def marked(value: Column) -> Column:
        return F.when(_divides(key, 7), "!@9#%8").otherwise(value)

    salary = F.when(_divides(key, 23), "_").otherwise(_whole(balance / 2))
    return _customer_months(spark, sf_dir).select(
        F.concat(F.lit("C"), key).alias("Customer_ID"),
        marked(F.concat(F.lit(" loan_"), small(1, 4), F.lit(" "))).alias("Type_of_Loan"),
        F.when(_divides(key, 5), "_").otherwise(F.concat(F.lit("Mix"), small(1, 3))).alias(
            "Credit_Mix"
        ),
        F.when(_divides(key, 3), "#").otherwise("Yes").alias("Payment_of_Min_Amount"),
        marked(F.lit("Low_spent*Small&value")).alias("Payment_Behaviour"),
        dirty(_whole(balance * 10), 9).alias("Annual_Income"),
        salary.alias("Monthly_Inhand_Salary"),
        small(1, 11).alias("Num_Bank_Accounts"),
        small(3, 9).alias("Num_Credit_Card"),
        small(5, 34, 1).alias("Interest_Rate"),
        dirty(small(1, 6), 31).alias("Num_of_Loan"),
        F.concat(F.lit("__-"), small(7, 60), F.lit(".5")).alias("Delay_from_due_date"),
        dirty(small(11, 28), 10).alias("Num_of_Delayed_Payment"),
        F.when(_divides(key, 6), "_").otherwise(small(13, 30)).alias("Changed_Credit_Limit"),
        small(2, 17).alias("Num_Credit_Inquiries"),
        _whole(F.coalesce(debt, F.lit(0.0))).alias("Outstanding_Debt"),
        small(37, 120).alias("Credit_Utilization_Ratio"),
        dashed(small(41, 500)).alias("Total_EMI_per_month"),
        dashed(small(43, 300)).alias("Amount_invested_monthly"),
        dashed(small(47, 900)).alias("Monthly_Balance"),
        _snapshot_text().alias("snapshot_date"),
    )


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw row per user and month: the summed excess over 50 of each event type."""
    excess = F.col("value").cast(CENTS) - 50
    sums = [
        F.sum(F.when(F.col("event_type") == kind, excess)).cast("string").alias(f"fe_{i}")
        for i, kind in enumerate(EVENT_TYPES, start=1)
    ]
    events = table(spark, sf_dir, "events")
    per_user = events.groupBy("user_id", F.trunc("ts", "MM").alias("month")).agg(*sums)
    return per_user.select(
        F.concat(F.lit("C"), "user_id").alias("Customer_ID"),
        *[f"fe_{i}" for i in range(1, len(EVENT_TYPES) + 1)],
        iso_text(F.col("month")).alias("snapshot_date"),
    )


def loan_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row with the first and last month that a loan may report in."""
    return table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first_date"),
        F.add_months(F.trunc(F.max("o_orderdate"), "MM"), LAST_INSTALLMENT).alias("last_date"),
    )


RAW = {
    "loans": loans,
    "financials": financials,
    "attributes": attributes,
    "clickstream": clickstream,
}
