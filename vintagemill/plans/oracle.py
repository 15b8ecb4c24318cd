"""The registered queries as SQL over the same tables, written apart from the Spark plans."""

from __future__ import annotations

import datetime as dt

# --- common table expressions ------------------------------------------------

LOANS_RAW = """
items AS (
  SELECT l_orderkey, l_linenumber, min(l_discount) AS min_discount,
         max(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END) AS returned
  FROM lineitem GROUP BY l_orderkey, l_linenumber
),
amounts AS (
  SELECT 'L' || l_orderkey AS loan_id, 'C' || o_custkey AS "Customer_ID",
         CAST(o_orderdate AS DATE) AS loan_start_date, 10 AS tenure,
         CAST(l_linenumber - 1 AS INTEGER) AS installment_num,
         CAST(round(o_totalprice) AS BIGINT) AS loan_amt,
         CAST(CASE WHEN min_discount = 0 THEN 0 ELSE round(o_totalprice / 10) END AS BIGINT) AS due_amt,
         CAST(round(returned / 4) AS BIGINT) AS overdue_amt,
         CAST(round(o_totalprice) - (l_linenumber - 1) * round(o_totalprice / 10) AS BIGINT) AS balance,
         CAST(date_trunc('month', o_orderdate) + to_months(CAST(l_linenumber - 1 AS INTEGER)) AS DATE)
           AS snapshot_date
  FROM items JOIN orders ON l_orderkey = o_orderkey
),
loans_raw AS (
  SELECT loan_id, "Customer_ID", loan_start_date, tenure, installment_num, loan_amt, due_amt,
         CASE WHEN overdue_amt > 0 THEN 0 ELSE due_amt END AS paid_amt, overdue_amt, balance,
         snapshot_date
  FROM amounts
)"""

LOANS = LOANS_RAW + """,
missed AS (
  SELECT loan_id, "Customer_ID", loan_start_date, tenure, installment_num,
         CAST(loan_amt AS FLOAT) AS loan_amt, CAST(due_amt AS FLOAT) AS due_amt,
         CAST(paid_amt AS FLOAT) AS paid_amt, CAST(overdue_amt AS FLOAT) AS overdue_amt,
         CAST(balance AS FLOAT) AS balance, snapshot_date, installment_num AS mob,
         CAST(CASE WHEN due_amt > 0 THEN ceil(CAST(overdue_amt AS DOUBLE) / due_amt) ELSE 0 END
           AS INTEGER) AS installments_missed
  FROM loans_raw
),
dated AS (
  SELECT *, CASE WHEN installments_missed > 0
                 THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END
            AS first_missed_date
  FROM missed
),
loans AS (
  SELECT *, CASE WHEN overdue_amt > 0
                 THEN CAST(date_diff('day', first_missed_date, snapshot_date) AS INTEGER)
                 ELSE 0 END AS dpd
  FROM dated
)"""

CUSTOMER_MONTHS = """
customer_months AS (
  SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month
  FROM orders GROUP BY ALL
),
open_debt AS (
  SELECT o_custkey,
         coalesce(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0)
           AS open_debt
  FROM orders GROUP BY o_custkey
),
snapshots AS (
  SELECT c.*, m.month AS snapshot_date, d.open_debt,
         CASE WHEN c_custkey % 2 = 0 THEN strftime(m.month, '%Y-%m-%d')
              ELSE strftime(m.month, '%-m/%-d/%Y') END AS raw_date,
         'C' || c_custkey AS "Customer_ID"
  FROM customer c
  LEFT JOIN customer_months m ON c.c_custkey = m.o_custkey
  LEFT JOIN open_debt d ON c.c_custkey = d.o_custkey
)"""

ATTRIBUTES_RAW = CUSTOMER_MONTHS + """,
attributes_raw AS (
  SELECT "Customer_ID", c_custkey, c_name AS "Name",
         CASE WHEN c_custkey % 17 = 0 THEN NULL
              WHEN c_custkey % 11 = 0 THEN (10 + c_custkey * 7 % 100) || '_'
              ELSE CAST(10 + c_custkey * 7 % 100 AS VARCHAR) END AS "Age",
         lpad(CAST(c_custkey % 1000000000 AS VARCHAR), 9, '0') AS digits,
         CASE c_custkey % 8 WHEN 0 THEN 'Lawyer' WHEN 1 THEN 'Engineer' WHEN 2 THEN 'Manager'
              WHEN 3 THEN 'Media_Manager' WHEN 4 THEN 'Developer' WHEN 5 THEN '_______'
              WHEN 6 THEN '_Manager' END AS "Occupation",
         raw_date, snapshot_date
  FROM snapshots
),
attributes_text AS (
  SELECT "Customer_ID", "Name", "Age",
         CASE WHEN c_custkey % 13 = 0 THEN '#F%$D@*&8'
              WHEN c_custkey % 19 = 0 THEN NULL
              ELSE digits[1:3] || '-' || digits[4:5] || '-' || digits[6:9] END AS "SSN",
         "Occupation", raw_date, snapshot_date
  FROM attributes_raw
)"""

ATTRIBUTES = ATTRIBUTES_RAW + """,
attributes AS (
  SELECT "Customer_ID", trim("Name") AS "Name",
         CASE WHEN try_cast("Age" AS INTEGER) BETWEEN 18 AND 100
              THEN CAST(try_cast("Age" AS INTEGER) AS INTEGER) END AS "Age",
         "SSN",
         regexp_replace(replace(trim("Occupation"), '_', ' '), '[^a-zA-Z\\s]', '', 'g') AS "Occupation",
         snapshot_date,
         regexp_replace(trim("Name"), '[^a-zA-Z\\s]', '', 'g') AS "Name_cleaned",
         regexp_full_match("SSN", '\\d{3}-\\d{2}-\\d{4}') AS "SSN_is_valid",
         CASE WHEN regexp_full_match("SSN", '\\d{3}-\\d{2}-\\d{4}') THEN "SSN" ELSE 'CORRUPTED' END
           AS "SSN_cleaned"
  FROM attributes_text
)"""

# The raw texts are stated with their cleaned value in mind: a dash or a lone
# underscore leaves nothing to parse, a trailing underscore is dropped.
FINANCIALS = CUSTOMER_MONTHS + """,
parsed AS (
  SELECT "Customer_ID",
         CASE WHEN c_custkey % 7 = 0 THEN '!98' ELSE 'loan_' || (c_custkey % 4) END AS "Type_of_Loan",
         CASE WHEN c_custkey % 5 = 0 THEN '_' ELSE 'Mix' || (c_custkey % 3) END AS "Credit_Mix",
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Yes' END AS "Payment_of_Min_Amount",
         CASE WHEN c_custkey % 7 = 0 THEN '!98' ELSE 'Low_spentSmallvalue' END AS "Payment_Behaviour",
         CAST(round(c_acctbal * 10) AS DOUBLE) AS "Annual_Income",
         CASE WHEN c_custkey % 23 <> 0 THEN CAST(round(c_acctbal / 2) AS DOUBLE) END
           AS "Monthly_Inhand_Salary",
         CAST(c_custkey % 11 AS DOUBLE) AS "Num_Bank_Accounts",
         CAST(c_custkey * 3 % 9 AS DOUBLE) AS "Num_Credit_Card",
         CAST(c_custkey * 5 % 34 + 1 AS DOUBLE) AS "Interest_Rate",
         CAST(c_custkey % 6 AS DOUBLE) AS "Num_of_Loan",
         -(c_custkey * 7 % 60 + 0.5::DOUBLE) AS "Delay_from_due_date",
         CAST(c_custkey * 11 % 28 AS DOUBLE) AS "Num_of_Delayed_Payment",
         CASE WHEN c_custkey % 6 <> 0 THEN CAST(c_custkey * 13 % 30 AS DOUBLE) END
           AS "Changed_Credit_Limit",
         CAST(c_custkey * 2 % 17 AS DOUBLE) AS "Num_Credit_Inquiries",
         round(coalesce(CAST(open_debt AS DOUBLE) / 50, 0)) AS "Outstanding_Debt",
         CAST(c_custkey * 37 % 120 AS DOUBLE) AS "Credit_Utilization_Ratio",
         CASE WHEN c_custkey % 29 <> 0 THEN CAST(c_custkey * 41 % 500 AS DOUBLE) END
           AS "Total_EMI_per_month",
         CASE WHEN c_custkey % 29 <> 0 THEN CAST(c_custkey * 43 % 300 AS DOUBLE) END
           AS "Amount_invested_monthly",
         CASE WHEN c_custkey % 29 <> 0 THEN CAST(c_custkey * 47 % 900 AS DOUBLE) END
           AS "Monthly_Balance",
         snapshot_date
  FROM snapshots
),
financials AS (
  SELECT *, CASE WHEN "Annual_Income" > 0 THEN "Outstanding_Debt" / "Annual_Income" END
              AS debt_to_income_ratio,
         CASE WHEN "Monthly_Inhand_Salary" > 0 THEN "Total_EMI_per_month" / "Monthly_Inhand_Salary" END
              AS monthly_debt_service_ratio
  FROM parsed
)"""

CLICKSTREAM = """
events_excess AS (
  SELECT user_id, event_type, CAST(date_trunc('month', ts) AS DATE) AS month,
         CAST(value AS DECIMAL(18,2)) - 50 AS excess
  FROM events
),
users AS (
  SELECT 'C' || user_id AS "Customer_ID",
         CAST(sum(excess) FILTER (WHERE event_type = 'click') AS DOUBLE) AS fe_1,
         CAST(sum(excess) FILTER (WHERE event_type = 'error') AS DOUBLE) AS fe_2,
         CAST(sum(excess) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS fe_3,
         CAST(sum(excess) FILTER (WHERE event_type = 'signup') AS DOUBLE) AS fe_4,
         CAST(sum(excess) FILTER (WHERE event_type = 'view') AS DOUBLE) AS fe_5,
         month AS snapshot_date
  FROM events_excess GROUP BY user_id, month
),
totals AS (
  SELECT *,
         greatest(coalesce(fe_1, 0), 0) + greatest(coalesce(fe_2, 0), 0)
           + greatest(coalesce(fe_3, 0), 0) + greatest(coalesce(fe_4, 0), 0)
           + greatest(coalesce(fe_5, 0), 0) AS total_positive_features,
         least(coalesce(fe_1, 0), 0) + least(coalesce(fe_2, 0), 0) + least(coalesce(fe_3, 0), 0)
           + least(coalesce(fe_4, 0), 0) + least(coalesce(fe_5, 0), 0) AS total_negative_features
  FROM users
),
clickstream AS (
  SELECT *, CASE WHEN total_positive_features <> 0
                 THEN total_negative_features / total_positive_features END AS feature_balance_ratio
  FROM totals
)"""

CALENDAR = """
calendar AS (
  SELECT CAST(unnest(generate_series(
           date_trunc('month', (SELECT min(o_orderdate) FROM orders)),
           date_trunc('month', (SELECT max(o_orderdate) FROM orders)) + INTERVAL 6 MONTH,
           INTERVAL 1 MONTH)) AS DATE) AS processing_date
)"""

# Which clickstream month serves each calendar month: its own, else the newest.
SERVED = CALENDAR + """,
served AS (
  SELECT processing_date,
         CASE WHEN processing_date IN (SELECT snapshot_date FROM clickstream) THEN processing_date
              ELSE (SELECT max(snapshot_date) FROM clickstream) END AS source_date
  FROM calendar
)"""

RATES = LOANS + """,
rates AS (
  SELECT mob, count(DISTINCT loan_id) AS total_loans,
         count(DISTINCT CASE WHEN dpd >= 30 THEN loan_id END) AS bad_loans,
         CAST(count(DISTINCT CASE WHEN dpd >= 30 THEN loan_id END) AS DOUBLE)
           / count(DISTINCT loan_id) AS bad_rate
  FROM loans GROUP BY mob
),
changes AS (
  SELECT *, bad_rate - lag(bad_rate) OVER (ORDER BY mob) AS mom_change FROM rates
)"""

LOAN_FEATURES = """
loan_features AS (
  SELECT snapshot_date AS processing_date, "Customer_ID",
         count(loan_id) AS num_active_loans_at_application,
         max(loan_amt) AS max_requested_loan_amount,
         avg(loan_amt) AS avg_requested_loan_amount,
         max(tenure) AS max_requested_tenure, avg(tenure) AS avg_requested_tenure,
         max(balance) AS initial_total_balance, avg(balance) AS avg_initial_balance,
         count(loan_id) * avg(loan_amt) AS total_loan_exposure_at_application,
         CAST(count(loan_id) > 1 AS INTEGER) AS multiple_loans_flag,
         CAST(max(loan_amt) >= 50000 AS INTEGER) AS high_value_application
  FROM loans WHERE mob = 0 GROUP BY snapshot_date, "Customer_ID"
)"""

FINANCIAL_FEATURES = """
financial_features AS (
  SELECT snapshot_date AS processing_date, "Customer_ID",
         "Annual_Income" AS annual_income, "Monthly_Inhand_Salary" AS monthly_salary,
         "Num_Bank_Accounts" AS num_bank_accounts, "Num_Credit_Card" AS num_credit_cards,
         "Interest_Rate" AS existing_avg_interest_rate, "Num_of_Loan" AS external_loans_count,
         "Outstanding_Debt" AS total_outstanding_debt,
         "Credit_Utilization_Ratio" AS credit_utilization,
         "Total_EMI_per_month" AS monthly_emi, "Amount_invested_monthly" AS monthly_investment,
         "Monthly_Balance" AS monthly_balance, debt_to_income_ratio, monthly_debt_service_ratio,
         CASE WHEN debt_to_income_ratio <= 0.3::DOUBLE THEN 5
              WHEN debt_to_income_ratio <= 0.5::DOUBLE THEN 4
              WHEN debt_to_income_ratio <= 0.7::DOUBLE THEN 3
              WHEN debt_to_income_ratio <= 1.0::DOUBLE THEN 2 ELSE 1 END AS financial_health_score,
         CASE WHEN "Monthly_Inhand_Salary" > 0 THEN "Monthly_Balance" / "Monthly_Inhand_Salary" END
           AS liquidity_ratio,
         CASE WHEN "Monthly_Inhand_Salary" > 0
              THEN "Amount_invested_monthly" / "Monthly_Inhand_Salary" ELSE 0 END AS investment_ratio,
         "Monthly_Inhand_Salary" - "Total_EMI_per_month" AS discretionary_income,
         CASE WHEN "Monthly_Inhand_Salary" > 0
              THEN ("Monthly_Inhand_Salary" - "Total_EMI_per_month") / "Monthly_Inhand_Salary"
              ELSE 0 END AS savings_capacity_ratio,
         "Num_Bank_Accounts" + "Num_Credit_Card" + "Num_of_Loan" AS credit_product_diversity,
         CASE WHEN debt_to_income_ratio > 0.7::DOUBLE THEN 1 ELSE 0 END AS high_leverage_flag
  FROM financials
)"""

ATTRIBUTE_FEATURES = """
attribute_features AS (
  SELECT snapshot_date AS processing_date, "Customer_ID", "Age" AS customer_age,
         "SSN_is_valid" AS ssn_valid_flag, "Occupation" AS occupation,
         CASE WHEN "Age" <= 25 THEN 'young' WHEN "Age" <= 35 THEN 'young_adult'
              WHEN "Age" <= 50 THEN 'middle_age' WHEN "Age" <= 65 THEN 'mature'
              ELSE 'senior' END AS age_risk_category,
         CASE WHEN "Occupation" IN ('Lawyer', 'Engineer', 'Doctor', 'Teacher', 'Accountant', 'Scientist')
              THEN 5
              WHEN "Occupation" IN ('Manager', 'Architect', 'Developer', 'Analyst') THEN 3
              WHEN "Occupation" IS NOT NULL THEN 2 ELSE 1 END AS occupation_stability_score,
         CASE WHEN "Age" BETWEEN 30 AND 55 THEN 5 WHEN "Age" >= 25 AND "Age" < 30 THEN 4
              WHEN "Age" BETWEEN 56 AND 65 THEN 4 WHEN "Age" < 25 THEN 2 ELSE 3 END
           AS financial_maturity_score
  FROM attributes
)"""


def _clickstream_features(ratio: str) -> str:
    return f"""
clickstream_features AS (
  SELECT snapshot_date, "Customer_ID",
         total_positive_features AS clickstream_positive_activity,
         total_negative_features AS clickstream_negative_activity,
         feature_balance_ratio AS clickstream_balance_ratio,
         fe_1 AS clickstream_fe_1, fe_2 AS clickstream_fe_2, fe_3 AS clickstream_fe_3,
         fe_4 AS clickstream_fe_4, fe_5 AS clickstream_fe_5,
         CASE WHEN total_positive_features >= 100 THEN 'high'
              WHEN total_positive_features >= 50 THEN 'medium' ELSE 'low' END AS engagement_level,
         CASE WHEN {ratio} >= 0.8::DOUBLE THEN 5 WHEN {ratio} >= 0.6::DOUBLE THEN 4
              WHEN {ratio} >= 0.4::DOUBLE THEN 3 WHEN {ratio} >= 0.2::DOUBLE THEN 2 ELSE 1 END
           AS engagement_quality_score,
         CASE WHEN total_positive_features >= 50 AND {ratio} >= 0.6::DOUBLE THEN 1 ELSE 0 END
           AS thorough_researcher
  FROM clickstream
)"""


CLICKSTREAM_FEATURES = _clickstream_features("feature_balance_ratio")

# Months without applications take the customers of the clickstream: attributes
# and financials exist only in months with orders, and every order is a loan.
SPINE = """
spine AS (
  SELECT DISTINCT snapshot_date AS processing_date, "Customer_ID", snapshot_date
  FROM loans WHERE mob = 0
  UNION ALL
  SELECT DISTINCT snapshot_date, "Customer_ID", snapshot_date FROM attributes
  WHERE snapshot_date NOT IN (SELECT snapshot_date FROM loans WHERE mob = 0)
  UNION ALL
  SELECT DISTINCT processing_date, "Customer_ID", snapshot_date
  FROM clickstream JOIN served ON snapshot_date = source_date
  WHERE processing_date NOT IN (SELECT snapshot_date FROM loans WHERE mob = 0)
    AND processing_date NOT IN
        (SELECT snapshot_date FROM attributes WHERE snapshot_date IS NOT NULL)
)"""

LONG_VALUES = """
profile AS (
  SELECT 'Age' AS metric, CAST("Age" AS DOUBLE) AS value FROM attributes
  UNION ALL SELECT 'Annual_Income', "Annual_Income" FROM financials
  UNION ALL SELECT 'debt_to_income_ratio', debt_to_income_ratio FROM financials
  UNION ALL SELECT 'Credit_Utilization_Ratio', "Credit_Utilization_Ratio" FROM financials
  UNION ALL SELECT 'loan_amt', CAST(loan_amt AS DOUBLE) FROM loans WHERE mob = 0
  UNION ALL SELECT 'tenure', CAST(tenure AS DOUBLE) FROM loans WHERE mob = 0
)"""

MISSING = """
missing AS (
  SELECT 'Attributes' AS dataset, snapshot_date AS processing_date,
         sum(CAST("Age" IS NULL AS INTEGER) + CAST("SSN" IS NULL AS INTEGER)
             + CAST("Occupation" IS NULL AS INTEGER) + CAST("SSN_is_valid" IS NULL AS INTEGER))
           * 100.0::DOUBLE / (count(*) * 10) AS missing_pct
  FROM attributes WHERE snapshot_date IS NOT NULL GROUP BY snapshot_date
  UNION ALL
  SELECT 'Financials', snapshot_date,
         sum(CAST("Payment_of_Min_Amount" IS NULL AS INTEGER)
             + CAST("Monthly_Inhand_Salary" IS NULL AS INTEGER)
             + CAST("Changed_Credit_Limit" IS NULL AS INTEGER)
             + CAST("Total_EMI_per_month" IS NULL AS INTEGER)
             + CAST("Amount_invested_monthly" IS NULL AS INTEGER)
             + CAST("Monthly_Balance" IS NULL AS INTEGER)
             + CAST(debt_to_income_ratio IS NULL AS INTEGER)
             + CAST(monthly_debt_service_ratio IS NULL AS INTEGER))
           * 100.0::DOUBLE / (count(*) * 24)
  FROM financials WHERE snapshot_date IS NOT NULL GROUP BY snapshot_date
  UNION ALL
  SELECT 'Loans MOB=0', snapshot_date,
         sum(CAST(first_missed_date IS NULL AS INTEGER) + CAST(dpd IS NULL AS INTEGER))
           * 100.0::DOUBLE / (count(*) * 16)
  FROM loans WHERE mob = 0 GROUP BY snapshot_date
)"""


def _with(*parts: str, select: str) -> str:
    """One statement from common table expressions, each named once."""
    return "WITH " + ",".join(dict.fromkeys(parts)) + "\n" + select


def _customers(*parts: str) -> str:
    """Attributes and financials share the customer months; state those once."""
    attributes, financials = parts
    return attributes + financials.removeprefix(CUSTOMER_MONTHS)


BOTH = _customers(ATTRIBUTES, FINANCIALS)
LOANS_ATTRIBUTES_CLICKS = (LOANS, ATTRIBUTES, CLICKSTREAM, SERVED)
STORE = (
    LOANS,
    BOTH,
    CLICKSTREAM,
    SERVED,
    SPINE,
    LOAN_FEATURES,
    FINANCIAL_FEATURES,
    ATTRIBUTE_FEATURES,
    CLICKSTREAM_FEATURES,
)
STORE_SELECT = """
SELECT s.*, l.* EXCLUDE (processing_date, "Customer_ID"), f.* EXCLUDE (processing_date, "Customer_ID"),
       a.* EXCLUDE (processing_date, "Customer_ID"), c.* EXCLUDE (snapshot_date, "Customer_ID")
FROM spine s
LEFT JOIN loan_features l USING (processing_date, "Customer_ID")
LEFT JOIN financial_features f USING (processing_date, "Customer_ID")
LEFT JOIN attribute_features a USING (processing_date, "Customer_ID")
LEFT JOIN served v USING (processing_date)
LEFT JOIN clickstream_features c
  ON c."Customer_ID" = s."Customer_ID" AND c.snapshot_date = v.source_date
"""
STORE_COLUMNS = 50

# Each customer's latest records up to the month; every month with rows has a spine.
ASOF_SPINE = """
spine AS (
  SELECT DISTINCT snapshot_date AS processing_date, "Customer_ID", snapshot_date
  FROM loans WHERE mob = 0
  UNION ALL
  SELECT DISTINCT snapshot_date, "Customer_ID", snapshot_date FROM attributes
  WHERE snapshot_date NOT IN (SELECT snapshot_date FROM loans WHERE mob = 0)
  UNION ALL
  SELECT DISTINCT snapshot_date, "Customer_ID", snapshot_date FROM clickstream
  WHERE snapshot_date NOT IN (SELECT snapshot_date FROM loans WHERE mob = 0)
    AND snapshot_date NOT IN (SELECT snapshot_date FROM attributes WHERE snapshot_date IS NOT NULL)
)"""
ASOF_STORE = (LOANS, BOTH, CLICKSTREAM, ASOF_SPINE, LOAN_FEATURES, FINANCIAL_FEATURES, ATTRIBUTE_FEATURES, CLICKSTREAM_FEATURES)
ASOF_SELECT = """
SELECT s.*, l.* EXCLUDE (processing_date, "Customer_ID"), f.* EXCLUDE (processing_date, "Customer_ID"),
       f.processing_date AS financials_as_of, a.* EXCLUDE (processing_date, "Customer_ID"),
       a.processing_date AS attributes_as_of, c.* EXCLUDE (snapshot_date, "Customer_ID"),
       c.snapshot_date AS clickstream_as_of
FROM spine s
LEFT JOIN loan_features l USING (processing_date, "Customer_ID")
ASOF LEFT JOIN (SELECT * FROM financial_features WHERE processing_date IS NOT NULL) f
  ON f."Customer_ID" = s."Customer_ID" AND f.processing_date <= s.processing_date
ASOF LEFT JOIN (SELECT * FROM attribute_features WHERE processing_date IS NOT NULL) a
  ON a."Customer_ID" = s."Customer_ID" AND a.processing_date <= s.processing_date
ASOF LEFT JOIN clickstream_features c
  ON c."Customer_ID" = s."Customer_ID" AND c.snapshot_date <= s.processing_date
"""

LABELS_WITHIN = """
SELECT loan_id, "Customer_ID", snapshot_date,
       CAST(max(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS INTEGER) AS label,
       '30dpd_within_6mob' AS label_def
FROM loans WHERE mob BETWEEN 1 AND 6
GROUP BY loan_id, "Customer_ID", snapshot_date"""

LOANS_TEXT = LOANS_RAW + """,
loans_text AS (
  SELECT loan_id, "Customer_ID", strftime(loan_start_date, '%Y-%m-%d') AS loan_start_date,
         CAST(tenure AS VARCHAR) AS tenure, CAST(installment_num AS VARCHAR) AS installment_num,
         CAST(loan_amt AS VARCHAR) AS loan_amt, CAST(due_amt AS VARCHAR) AS due_amt,
         CAST(paid_amt AS VARCHAR) AS paid_amt, CAST(overdue_amt AS VARCHAR) AS overdue_amt,
         CAST(balance AS VARCHAR) AS balance, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date
  FROM loans_raw
)"""

TYPED_LOANS = """
SELECT loan_id, "Customer_ID", loan_start_date, tenure, installment_num, loan_amt, due_amt,
       paid_amt, overdue_amt, balance, snapshot_date"""

HISTOGRAM = """
spans AS (
  SELECT metric, min(value) AS lo, max(value) AS hi,
         CASE metric {sizes} END AS bins
  FROM {values} GROUP BY metric
),
buckets AS (
  SELECT metric, lo, hi, bins, CAST(unnest(generate_series(1, bins)) AS INTEGER) AS bucket FROM spans
),
hits AS (
  SELECT metric, CAST(least(floor(bins * (value - lo) / (hi - lo)) + 1, bins) AS INTEGER) AS bucket,
         count(*) AS rows
  FROM {values} JOIN spans USING (metric) GROUP BY ALL
)"""
HISTOGRAM_SELECT = """
SELECT metric, bucket, lo + (hi - lo) * (bucket - 1) / bins AS low,
       lo + (hi - lo) * bucket / bins AS high, coalesce(rows, 0) AS rows
FROM buckets LEFT JOIN hits USING (metric, bucket)"""

# Loans as text with a planted fault by the sum of loan number and installment, modulo 60.
FAULTS = LOANS_TEXT + """,
keyed AS (
  SELECT *, (CAST(loan_id[2:] AS BIGINT) + CAST(installment_num AS BIGINT)) % 60 AS fault FROM loans_text
),
faults AS (
  SELECT * REPLACE (
    CASE fault WHEN 1 THEN 'ten' ELSE tenure END AS tenure,
    CASE fault WHEN 2 THEN '"12,5"' ELSE paid_amt END AS paid_amt,
    CASE fault WHEN 3 THEN '1997-13-01' ELSE snapshot_date END AS snapshot_date)
  FROM keyed WHERE fault BETWEEN 1 AND 6
),
lines AS (
  SELECT fault, loan_id,
         concat_ws(',', loan_id, "Customer_ID", loan_start_date, tenure, installment_num, loan_amt,
                   due_amt, paid_amt, overdue_amt, balance, snapshot_date) AS line
  FROM faults
),
problems AS (
  SELECT CASE fault WHEN 4 THEN NULL WHEN 5 THEN line || ',x' WHEN 6 THEN loan_id || ',x' ELSE line END AS raw,
         CASE fault WHEN 1 THEN 'tenure' WHEN 2 THEN 'paid_amt' WHEN 3 THEN 'snapshot_date'
                    WHEN 4 THEN 'Customer_ID' END AS column_name,
         CASE fault WHEN 1 THEN 'ten' WHEN 2 THEN '12,5' WHEN 3 THEN '1997-13-01' END AS value,
         CASE fault WHEN 1 THEN 'not a int' WHEN 2 THEN 'not a float' WHEN 3 THEN 'not a date'
                    WHEN 4 THEN 'required and empty' ELSE 'number of values' END AS reason
  FROM lines
)"""

ORACLE_SQL: dict[str, str] = {
    # --- loans and labels
    "silver_loans": _with(LOANS, select="SELECT * FROM loans"),
    "silver_loans_small": _with(
        LOANS,
        select="""
        SELECT * EXCLUDE (dpd),
               CASE WHEN overdue_amt > 0 AND due_amt = 0 THEN NULL ELSE dpd END AS dpd
        FROM loans""",
    ),
    "dpd": _with(
        LOANS,
        select="""
        SELECT loan_id, snapshot_date, mob, installments_missed, first_missed_date, dpd FROM loans""",
    ),
    "mob_filter": _with(LOANS, select="SELECT * FROM loans WHERE mob = 0"),
    "label_within_window": _with(LOANS, select=LABELS_WITHIN),
    "label_ever_in_window": _with(
        LOANS,
        select="""
        SELECT loan_id, "Customer_ID",
               CAST(max(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS INTEGER) AS label,
               '30dpd_within_6mob' AS label_def
        FROM loans WHERE mob BETWEEN 1 AND 6 GROUP BY loan_id, "Customer_ID" """,
    ),
    "label_at_mob": _with(
        LOANS,
        select="""
        SELECT loan_id, "Customer_ID", CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
               '30dpd_at_6mob' AS label_def, snapshot_date
        FROM loans WHERE mob = 6""",
    ),
    "label_at_mob_small": _with(
        LOANS,
        select="""
        SELECT loan_id, "Customer_ID", CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
               '30dpd_6mob' AS label_def, snapshot_date
        FROM loans WHERE mob = 6""",
    ),
    "label_distribution": _with(
        LOANS,
        select=f"""
        SELECT label, count(*) AS count, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS pct
        FROM ({LABELS_WITHIN}) GROUP BY label""",
    ),
    # --- vintage
    "cohort_filter": _with(
        LOANS, select="SELECT * FROM loans WHERE loan_start_date < DATE '1998-01-01'"
    ),
    "matured_loans": _with(LOANS, select="SELECT * FROM loans WHERE installment_num = 6"),
    "bad_rate_rows": _with(
        LOANS,
        select="""
        SELECT mob, count(*) AS rows, avg(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS bad_rate
        FROM loans WHERE loan_start_date < DATE '1998-01-01' GROUP BY mob ORDER BY mob""",
    ),
    "bad_rate_loans": _with(
        RATES, select="SELECT mob, total_loans, bad_loans, bad_rate FROM rates ORDER BY mob"
    ),
    "bad_rate_by_cohort": _with(
        LOANS,
        select="""
        , per_cohort AS (
          SELECT CAST(date_trunc('month', loan_start_date) AS DATE) AS cohort, mob,
                 count(DISTINCT loan_id) AS total_loans,
                 count(DISTINCT CASE WHEN dpd >= 30 THEN loan_id END) AS bad_loans
          FROM loans GROUP BY ALL)
        SELECT *, CAST(bad_loans AS DOUBLE) / total_loans AS bad_rate,
               CAST(bad_loans AS DOUBLE) / total_loans
                 - lag(CAST(bad_loans AS DOUBLE) / total_loans) OVER (PARTITION BY cohort ORDER BY mob)
                 AS mom_change
        FROM per_cohort""",
    ),
    "bad_rate_mom": _with(RATES, select="SELECT * FROM changes ORDER BY mob"),
    "bad_rate_growth": _with(
        RATES,
        select="""
        , ends AS (
          SELECT max(bad_rate) FILTER (WHERE mob = 0) AS initial_rate, max(mob) AS final_mob,
                 arg_max(bad_rate, mob) AS final_rate
          FROM rates)
        SELECT *, final_rate - initial_rate AS growth,
               CASE WHEN initial_rate > 0 THEN (final_rate - initial_rate) * 100.0::DOUBLE / initial_rate
                    WHEN initial_rate IS NOT NULL THEN 'inf'::DOUBLE END AS growth_pct
        FROM ends""",
    ),
    "bad_rate_stabilization": _with(
        RATES,
        select="SELECT min(mob) AS stabilization_mob FROM changes WHERE abs(mom_change) < 0.01::DOUBLE",
    ),
    "bad_rate_peak_change": _with(
        RATES,
        select="""
        SELECT mob AS max_change_mob, mom_change AS max_change FROM changes
        WHERE mom_change IS NOT NULL ORDER BY mom_change DESC, mob LIMIT 1""",
    ),
    # --- cleaned customer datasets
    "silver_attributes": _with(ATTRIBUTES, select="SELECT * FROM attributes"),
    "silver_financials": _with(FINANCIALS, select="SELECT * FROM financials"),
    "silver_clickstream": _with(CLICKSTREAM, select="SELECT * FROM clickstream"),
    "optional_columns": _with(
        ATTRIBUTES, select='SELECT * EXCLUDE ("Age", "Occupation") FROM attributes'
    ),
    # --- features
    "feat_loan_application": _with(LOANS, LOAN_FEATURES, select="SELECT * FROM loan_features"),
    "feat_financial": _with(
        FINANCIALS,
        FINANCIAL_FEATURES,
        select="SELECT * FROM financial_features WHERE processing_date IS NOT NULL",
    ),
    "feat_attribute": _with(
        ATTRIBUTES,
        ATTRIBUTE_FEATURES,
        select="SELECT * FROM attribute_features WHERE processing_date IS NOT NULL",
    ),
    "feat_clickstream": _with(
        CLICKSTREAM, CLICKSTREAM_FEATURES, select="SELECT * FROM clickstream_features"
    ),
    "feat_clickstream_magnitude": _with(
        CLICKSTREAM,
        _clickstream_features("abs(feature_balance_ratio)"),
        select="SELECT * FROM clickstream_features",
    ),
    "feature_spine": _with(*LOANS_ATTRIBUTES_CLICKS, SPINE, select="SELECT * FROM spine"),
    "feature_store": _with(*STORE, select=STORE_SELECT),
    "feature_store_hot": _with(
        *STORE[:-2],
        ATTRIBUTE_FEATURES.replace("attribute_features AS", "once AS") + """,
attribute_features AS (
  SELECT * FROM once
  UNION ALL SELECT * FROM once WHERE "Customer_ID" LIKE '%1'
  UNION ALL SELECT * FROM once WHERE "Customer_ID" LIKE '%11'
)""",
        CLICKSTREAM_FEATURES,
        select=STORE_SELECT,
    ),
    "feature_spine_fallback": _with(
        LOANS,
        BOTH,
        CLICKSTREAM,
        SERVED,
        select="""
        , early AS (SELECT DISTINCT snapshot_date AS day, "Customer_ID" FROM loans
                    WHERE mob = 0 AND snapshot_date < DATE '1997-01-01'),
        middle AS (SELECT DISTINCT snapshot_date AS day, "Customer_ID" FROM attributes
                   WHERE snapshot_date < DATE '1998-01-01' AND snapshot_date NOT IN (SELECT day FROM early)),
        late AS (SELECT DISTINCT snapshot_date AS day, "Customer_ID" FROM financials
                 WHERE snapshot_date < DATE '2000-01-01' AND snapshot_date NOT IN (SELECT day FROM early)
                   AND snapshot_date NOT IN (SELECT day FROM middle))
        SELECT day AS processing_date, "Customer_ID", day AS snapshot_date
        FROM (SELECT * FROM early UNION ALL SELECT * FROM middle UNION ALL SELECT * FROM late)""",
    ),
    "feature_store_asof": _with(*ASOF_STORE, select=ASOF_SELECT),
    "leakage_asof": _with(
        *ASOF_STORE,
        select=f"""
        , store AS ({ASOF_SELECT}),
        used AS (
          SELECT 'financials not ahead' AS check, processing_date, financials_as_of AS day FROM store
          UNION ALL SELECT 'attributes not ahead', processing_date, attributes_as_of FROM store
          UNION ALL SELECT 'clickstream not ahead', processing_date, clickstream_as_of FROM store
          UNION ALL SELECT 'features at mob', snapshot_date, snapshot_date FROM loans WHERE mob = 0
          UNION ALL SELECT 'labels after application', snapshot_date, snapshot_date
          FROM loans WHERE mob BETWEEN 1 AND 6)
        SELECT "check", count(*) AS rows, CAST(count(*) FILTER (day > processing_date) AS BIGINT) AS violations,
               count(*) FILTER (day > processing_date) = 0 AS passed
        FROM used WHERE day IS NOT NULL GROUP BY "check" """,
    ),
    "backfill_features": _with(
        *STORE,
        select=f"""
        SELECT *, strftime(processing_date, '%Y-%m-%d') AS gold_processing_date,
               '1.0' AS feature_store_version, 0 AS feature_mob
        FROM ({STORE_SELECT})""",
    ),
    # --- profiling
    "applications_by_month": _with(
        LOANS,
        select="""
        SELECT snapshot_date, count(loan_id) AS applications
        FROM loans WHERE mob = 0 GROUP BY snapshot_date""",
    ),
    "application_rate": _with(
        LOANS,
        select="""
        SELECT count(*) AS applications, count(DISTINCT snapshot_date) AS months,
               CAST(count(*) AS DOUBLE) / count(DISTINCT snapshot_date) AS applications_per_month
        FROM loans WHERE mob = 0""",
    ),
    "tenure_counts": _with(
        LOANS,
        select="""
        SELECT tenure, count(*) AS applications FROM loans WHERE mob = 0
        GROUP BY tenure ORDER BY tenure""",
    ),
    "tenure_mode": _with(
        LOANS,
        select="""
        SELECT tenure AS tenure_mode FROM loans WHERE mob = 0
        GROUP BY tenure ORDER BY count(*) DESC, tenure LIMIT 1""",
    ),
    "multi_application_share": _with(
        LOANS,
        select="""
        , sizes AS (
          SELECT "Customer_ID", count(*) AS n FROM loans WHERE mob = 0 GROUP BY "Customer_ID")
        SELECT count(*) FILTER (WHERE n = 1) AS single_customers,
               count(*) FILTER (WHERE n > 1) AS multi_customers,
               count(*) FILTER (WHERE n > 1) * 100.0::DOUBLE / count(*) AS multi_pct
        FROM sizes""",
    ),
    "balance_sample": _with(
        LOANS,
        select="""
        SELECT loan_id, loan_amt, balance FROM loans WHERE mob = 0
        ORDER BY md5(loan_id), loan_id, loan_amt, balance LIMIT 1000""",
    ),
    "validity_share": _with(
        ATTRIBUTES,
        select="""
        SELECT snapshot_date AS processing_date,
               CAST(count(*) FILTER (WHERE NOT "SSN_is_valid") AS DOUBLE) / count("SSN_is_valid")
                 AS invalid_share,
               CAST(count(*) FILTER (WHERE "SSN_is_valid") AS DOUBLE) / count("SSN_is_valid")
                 AS valid_share
        FROM attributes WHERE snapshot_date IS NOT NULL AND "SSN_is_valid" IS NOT NULL
        GROUP BY snapshot_date""",
    ),
    "invalid_rate": _with(
        ATTRIBUTES,
        select="""
        SELECT count(*) FILTER (WHERE NOT "SSN_is_valid") * 100.0::DOUBLE / count("SSN_is_valid")
                 AS invalid_pct
        FROM attributes""",
    ),
    "customers_across_sources": _with(
        LOANS,
        BOTH,
        select="""
        SELECT count(*) AS customers FROM (
          SELECT "Customer_ID" FROM attributes UNION SELECT "Customer_ID" FROM financials
          UNION SELECT "Customer_ID" FROM loans WHERE mob = 0)""",
    ),
    "missing_pct": _with(LOANS, BOTH, MISSING, select="SELECT * FROM missing"),
    "missing_pct_pivot": _with(
        LOANS,
        BOTH,
        MISSING,
        select="SELECT dataset, "
        + ", ".join(
            f"max(CASE WHEN processing_date = DATE '{year}-{month:02}-01' THEN missing_pct END)"
            f" AS \"{dt.date(year, month, 1):%b %Y}\""
            for year in range(1995, 2003)
            for month in range(1, 13)
            if (year, month) <= (2002, 2)
        )
        + " FROM missing GROUP BY dataset",
    ),
    "column_stats": _with(
        LOANS,
        BOTH,
        LONG_VALUES,
        select="""
        SELECT metric, count(value) AS n, min(value) AS min, max(value) AS max,
               round(avg(value), 6) AS mean, median(value) AS median
        FROM profile GROUP BY metric""",
    ),
    "hist_equal_width": _with(
        LOANS,
        BOTH,
        LONG_VALUES,
        """
        binned AS (
          SELECT * FROM profile
          WHERE metric IN ('Age', 'loan_amt', 'Annual_Income') AND value IS NOT NULL)""",
        HISTOGRAM.format(
            values="binned",
            sizes="WHEN 'Age' THEN 30 WHEN 'loan_amt' THEN 40 WHEN 'Annual_Income' THEN 40",
        ),
        select=HISTOGRAM_SELECT,
    ),
    "range_filtered_hist": _with(
        FINANCIALS,
        """
        binned AS (
          SELECT 'debt_to_income_ratio' AS metric, debt_to_income_ratio AS value FROM financials
          WHERE debt_to_income_ratio BETWEEN 0 AND 2
          UNION ALL
          SELECT 'Credit_Utilization_Ratio', "Credit_Utilization_Ratio" FROM financials
          WHERE "Credit_Utilization_Ratio" BETWEEN 0 AND 100)""",
        HISTOGRAM.format(
            values="binned",
            sizes="WHEN 'debt_to_income_ratio' THEN 40 WHEN 'Credit_Utilization_Ratio' THEN 30",
        ),
        select=HISTOGRAM_SELECT,
    ),
    "threshold_share": _with(
        LOANS,
        FINANCIALS,
        select="""
        SELECT 'high_dti' AS metric, count(*) FILTER (WHERE debt_to_income_ratio > 0.43::DOUBLE) AS rows,
               count(*) FILTER (WHERE debt_to_income_ratio > 0.43::DOUBLE) * 100.0::DOUBLE
                 / count(debt_to_income_ratio) AS pct
        FROM financials
        UNION ALL
        SELECT 'healthy_utilization', count(*) FILTER (WHERE "Credit_Utilization_Ratio" <= 30),
               count(*) FILTER (WHERE "Credit_Utilization_Ratio" <= 30) * 100.0::DOUBLE
                 / count("Credit_Utilization_Ratio")
        FROM financials
        UNION ALL
        SELECT 'high_utilization', count(*) FILTER (WHERE "Credit_Utilization_Ratio" > 70),
               count(*) FILTER (WHERE "Credit_Utilization_Ratio" > 70) * 100.0::DOUBLE
                 / count("Credit_Utilization_Ratio")
        FROM financials
        UNION ALL
        SELECT 'high_value', count(*) FILTER (WHERE loan_amt >= 50000),
               count(*) FILTER (WHERE loan_amt >= 50000) * 100.0::DOUBLE / count(loan_amt)
        FROM loans WHERE mob = 0""",
    ),
    "dti_bucket_counts": _with(
        FINANCIALS,
        select="""
        , scores AS (
          SELECT CASE WHEN debt_to_income_ratio <= 0.3::DOUBLE THEN 'Excellent (5)'
                      WHEN debt_to_income_ratio <= 0.5::DOUBLE THEN 'Good (4)'
                      WHEN debt_to_income_ratio <= 0.7::DOUBLE THEN 'Fair (3)'
                      WHEN debt_to_income_ratio <= 1.0::DOUBLE THEN 'Poor (2)'
                      ELSE 'Critical (1)' END AS health_score
          FROM financials WHERE debt_to_income_ratio > 0)
        SELECT health_score, count(s.health_score) AS rows
        FROM (VALUES ('Excellent (5)'), ('Good (4)'), ('Fair (3)'), ('Poor (2)'), ('Critical (1)'))
               AS every(health_score)
        LEFT JOIN scores s USING (health_score) GROUP BY health_score""",
    ),
    # --- calendar and bronze
    "month_calendar": _with(CALENDAR, select="SELECT * FROM calendar"),
    "missing_months": _with(
        LOANS,
        CUSTOMER_MONTHS,
        CLICKSTREAM,
        CALENDAR,
        select="""
        SELECT 'loans' AS dataset, processing_date FROM calendar
        WHERE processing_date NOT IN (SELECT snapshot_date FROM loans)
        UNION ALL
        SELECT d.dataset, processing_date
        FROM calendar CROSS JOIN (VALUES ('financials'), ('attributes')) AS d(dataset)
        WHERE processing_date NOT IN (SELECT month FROM customer_months)
        UNION ALL
        SELECT 'clickstream', processing_date FROM calendar
        WHERE processing_date NOT IN (SELECT snapshot_date FROM clickstream)""",
    ),
    "date_normalize": _with(
        CUSTOMER_MONTHS,
        select="""
        SELECT "Customer_ID", raw_date AS snapshot_date,
               strftime(snapshot_date, '%Y-%m-%d') AS normalized_snapshot_date
        FROM snapshots""",
    ),
    "sample_dates": _with(
        CUSTOMER_MONTHS,
        select="""
        SELECT DISTINCT raw_date AS snapshot_date FROM snapshots
        ORDER BY raw_date NULLS FIRST LIMIT 5""",
    ),
    "latest_date": _with(
        CLICKSTREAM, select="SELECT max(snapshot_date) AS latest_date FROM clickstream"
    ),
    "latest_fallback": _with(
        CLICKSTREAM,
        CALENDAR,
        select="""
        , sizes AS (SELECT snapshot_date AS source_date, count(*) AS rows FROM clickstream GROUP BY ALL),
        mapped AS (
          SELECT 'skip' AS policy, processing_date, processing_date AS source_date FROM calendar
          UNION ALL
          SELECT 'latest_overall', processing_date,
                 CASE WHEN processing_date IN (SELECT source_date FROM sizes) THEN processing_date
                      ELSE (SELECT max(source_date) FROM sizes) END
          FROM calendar
          UNION ALL
          SELECT 'latest_as_of', processing_date,
                 (SELECT max(source_date) FROM sizes s WHERE s.source_date <= c.processing_date)
          FROM calendar c)
        SELECT policy, processing_date, source_date, rows FROM mapped JOIN sizes USING (source_date)""",
    ),
    "snapshot_slice": _with(
        ATTRIBUTES_RAW,
        select="""
        SELECT * EXCLUDE (raw_date, snapshot_date), raw_date AS snapshot_date,
               strftime(snapshot_date, '%Y-%m-%d') AS normalized_snapshot_date
        FROM attributes_text WHERE snapshot_date = DATE '1997-03-01'""",
    ),
    "snapshot_slice_typed": _with(
        LOANS, select=TYPED_LOANS + ", mob FROM loans WHERE snapshot_date = DATE '1997-03-01'"
    ),
    "undated_passthrough": "SELECT *, '1997-03-01' AS processed_date FROM customer",
    "bronze_slice": _with(
        ATTRIBUTES_RAW,
        select="""
        SELECT * EXCLUDE (raw_date, snapshot_date), raw_date AS snapshot_date,
               strftime(snapshot_date, '%Y-%m-%d') AS normalized_snapshot_date,
               snapshot_date AS processing_date
        FROM attributes_text WHERE snapshot_date IS NOT NULL""",
    ),
    "bronze_slice_fallback": _with(
        CLICKSTREAM,
        SERVED,
        select="""
        , sums AS (
          SELECT user_id, event_type, month, CAST(sum(excess) AS VARCHAR) AS total
          FROM events_excess GROUP BY ALL)
        SELECT 'C' || user_id AS "Customer_ID", max(total) FILTER (WHERE event_type = 'click') AS fe_1,
               max(total) FILTER (WHERE event_type = 'error') AS fe_2,
               max(total) FILTER (WHERE event_type = 'purchase') AS fe_3,
               max(total) FILTER (WHERE event_type = 'signup') AS fe_4,
               max(total) FILTER (WHERE event_type = 'view') AS fe_5,
               strftime(month, '%Y-%m-%d') AS snapshot_date,
               strftime(month, '%Y-%m-%d') AS normalized_snapshot_date, processing_date
        FROM sums JOIN served ON month = source_date
        GROUP BY user_id, month, processing_date""",
    ),
    "meta_bronze": _with(
        LOANS_TEXT,
        select="""
        SELECT loan_id, snapshot_date, 'lms_loan_daily.csv' AS bronze_source_file,
               snapshot_date AS bronze_processing_date
        FROM loans_text""",
    ),
    "meta_silver": _with(
        LOANS,
        select="""
        SELECT loan_id, snapshot_date, strftime(snapshot_date, '%Y-%m-%d') AS silver_processing_date
        FROM loans""",
    ),
    "meta_gold": _with(
        *LOANS_ATTRIBUTES_CLICKS,
        SPINE,
        select="""
        SELECT *, strftime(processing_date, '%Y-%m-%d') AS gold_processing_date,
               '1.0' AS feature_store_version, 0 AS feature_mob
        FROM spine""",
    ),
    # --- validation
    "store_summary": _with(
        *STORE,
        select=f"""
        SELECT 'features' AS store, count(*) AS rows, {STORE_COLUMNS} AS columns,
               count(DISTINCT "Customer_ID") AS customers
        FROM ({STORE_SELECT})
        UNION ALL
        SELECT 'labels', count(*), 5, count(DISTINCT "Customer_ID") FROM ({LABELS_WITHIN})""",
    ),
    "ml_overlap": _with(
        *LOANS_ATTRIBUTES_CLICKS,
        SPINE,
        select="""
        , sizes AS (
          SELECT (SELECT count(DISTINCT "Customer_ID") FROM spine) AS feature_customers,
                 (SELECT count(DISTINCT "Customer_ID") FROM loans WHERE mob BETWEEN 1 AND 6)
                   AS label_customers,
                 (SELECT count(*) FROM (
                    SELECT "Customer_ID" FROM spine
                    INTERSECT SELECT "Customer_ID" FROM loans WHERE mob BETWEEN 1 AND 6)) AS overlap)
        SELECT *, CAST(overlap AS DOUBLE) / greatest(feature_customers, 1) AS overlap_share,
               CAST(overlap AS DOUBLE) / greatest(feature_customers, 1) > 0.8::DOUBLE AS ready
        FROM sizes""",
    ),
    "leakage_check": _with(
        LOANS,
        CUSTOMER_MONTHS,
        CLICKSTREAM,
        SERVED,
        select="""
        , checked AS (
          SELECT 'features at mob' AS "check", count(*) AS rows,
                 count(*) FILTER (WHERE installment_num <> 0) AS violations
          FROM loans WHERE mob = 0
          UNION ALL
          SELECT 'labels after application', count(*), count(*) FILTER (WHERE installment_num < 1)
          FROM loans WHERE mob BETWEEN 1 AND 6
          UNION ALL
          SELECT 'loans not ahead', count(*), count(*) FILTER (WHERE snapshot_date > date_trunc('month', snapshot_date))
          FROM loans
          UNION ALL
          SELECT name || ' not ahead', count(*), 0
          FROM customer_months CROSS JOIN (VALUES ('financials'), ('attributes')) AS n(name)
          GROUP BY name
          UNION ALL
          SELECT 'clickstream not ahead', count(*),
                 count(*) FILTER (WHERE snapshot_date > processing_date)
          FROM clickstream JOIN served ON snapshot_date = source_date)
        SELECT "check", rows, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed
        FROM checked""",
    ),
    "leakage_planted": _with(
        LOANS,
        select="""
        , checked AS (
          SELECT 'features at mob' AS "check", count(*) AS rows,
                 count(*) FILTER (WHERE mob <> 0) AS violations FROM loans
          UNION ALL
          SELECT 'labels after application', count(*), count(*) FILTER (WHERE mob < 1) FROM loans
          UNION ALL
          SELECT 'loans not ahead', count(*), count(*) FILTER (WHERE mob > 3) FROM loans)
        SELECT "check", rows, violations, violations = 0 AS passed FROM checked""",
    ),
    "store_preview": _with(
        ATTRIBUTES,
        select="""
        SELECT "Customer_ID", snapshot_date, "Age" FROM attributes
        ORDER BY "Customer_ID" NULLS LAST, snapshot_date NULLS LAST, "Age" NULLS LAST LIMIT 7""",
    ),
    "backfill_labels_loan": _with(
        LOANS,
        select="""
        SELECT loan_id, "Customer_ID",
               CAST(max(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS INTEGER) AS label,
               '30dpd_within_6mob' AS label_def
        FROM loans WHERE mob BETWEEN 1 AND 6 GROUP BY loan_id, "Customer_ID" """,
    ),
    "backfill_rerun": _with(
        LOANS,
        CUSTOMER_MONTHS,
        CALENDAR,
        select="""
        , kept_loans AS (SELECT * FROM loans WHERE snapshot_date <> DATE '1997-03-01'),
        kept_attributes AS (SELECT * FROM snapshots WHERE snapshot_date < DATE '2000-01-01'),
        kept_served AS (
          SELECT processing_date, max(snapshot_date) AS source_date
          FROM calendar JOIN kept_attributes ON snapshot_date <= processing_date GROUP BY processing_date),
        layers AS (SELECT unnest(['bronze', 'silver']) AS layer)
        SELECT layer, 'loans' AS table_name, snapshot_date AS day, snapshot_date AS source_date, count(*) AS rows
        FROM kept_loans CROSS JOIN layers GROUP BY ALL
        UNION ALL
        SELECT layer, 'attributes', snapshot_date, snapshot_date, count(*)
        FROM kept_attributes CROSS JOIN layers GROUP BY ALL
        UNION ALL
        SELECT 'served', 'attributes', processing_date, source_date, 1 FROM kept_served
        UNION ALL
        SELECT 'gold', 'label_store', snapshot_date, snapshot_date, count(DISTINCT (loan_id, "Customer_ID"))
        FROM kept_loans WHERE mob BETWEEN 1 AND 6 GROUP BY snapshot_date
        UNION ALL
        SELECT 'gold', 'loan_label_store', NULL, NULL, count(DISTINCT (loan_id, "Customer_ID"))
        FROM kept_loans WHERE mob BETWEEN 1 AND 6""",
    ),
    "run_report_layers": _with(
        LOANS,
        CALENDAR,
        select="""
        , sizes AS (
          SELECT 'bronze' AS layer, 'loans' AS dataset, snapshot_date, count(*) AS rows
          FROM loans GROUP BY snapshot_date
          UNION ALL
          SELECT 'silver', 'loans', snapshot_date, count(*) FROM loans GROUP BY snapshot_date
          UNION ALL
          SELECT 'gold', 'label_store', snapshot_date, count(*)
          FROM loans WHERE mob BETWEEN 1 AND 6 GROUP BY snapshot_date),
        ran AS (SELECT * FROM (VALUES ('bronze', 'loans'), ('silver', 'loans'), ('gold', 'label_store'))
                AS r(layer, dataset))
        SELECT r.layer, r.dataset, processing_date,
               CASE WHEN rows IS NULL THEN 'missing' ELSE 'done' END AS status, coalesce(rows, 0) AS rows
        FROM calendar CROSS JOIN ran r
        LEFT JOIN sizes s ON s.layer = r.layer AND s.dataset = r.dataset AND snapshot_date = processing_date""",
    ),
    "source_report": _with(
        LOANS,
        ATTRIBUTES,
        select="""
        , days AS (
          SELECT 'loans' AS dataset, 11 AS columns, snapshot_date AS day FROM loans
          UNION ALL SELECT 'attributes', 6, snapshot_date FROM attributes)
        SELECT dataset, count(*) AS source_rows, any_value(columns) AS columns,
               count(*) FILTER (WHERE day IS NULL) AS unreadable_dates,
               count(*) FILTER (WHERE year(day) <> 1997) AS outside_calendar,
               count(*) FILTER (WHERE year(day) = 1997) AS in_calendar,
               min(day) AS first_date, max(day) AS last_date
        FROM days GROUP BY dataset""",
    ),
    "schema_preview": _with(
        ATTRIBUTES,
        select="""
        SELECT 1 AS position, 'Age' AS column_name, 'int' AS data_type, count("Age") AS filled
        FROM attributes
        UNION ALL SELECT 2, 'Customer_ID', 'string', count("Customer_ID") FROM attributes
        UNION ALL SELECT 3, 'Name', 'string', count("Name") FROM attributes
        UNION ALL SELECT 4, 'Name_cleaned', 'string', count("Name_cleaned") FROM attributes
        UNION ALL SELECT 5, 'Occupation', 'string', count("Occupation") FROM attributes
        UNION ALL SELECT 6, 'SSN', 'string', count("SSN") FROM attributes
        UNION ALL SELECT 7, 'SSN_cleaned', 'string', count("SSN_cleaned") FROM attributes
        UNION ALL SELECT 8, 'SSN_is_valid', 'boolean', count("SSN_is_valid") FROM attributes
        UNION ALL SELECT 9, 'snapshot_date', 'date', count(snapshot_date) FROM attributes""",
    ),
    # --- files
    "src_csv_string": _with(LOANS_TEXT, select="SELECT * FROM loans_text"),
    "src_csv_typed": _with(LOANS, select=TYPED_LOANS + " FROM loans"),
    "src_snapshot_scan": _with(
        LOANS,
        select="""
        SELECT *, snapshot_date AS processing_date FROM loans
        WHERE snapshot_date = DATE '1997-03-01'""",
    ),
    "src_all_snapshots": _with(
        LOANS, select="SELECT *, snapshot_date AS processing_date FROM loans"
    ),
    "src_month_labelled": _with(
        LOANS,
        select="SELECT loan_id, snapshot_date, strftime(snapshot_date, '%b %Y') AS data_month FROM loans",
    ),
    "quarantine_rows": _with(FAULTS, select="SELECT * FROM problems"),
    "quarantine_good": _with(
        LOANS,
        select=TYPED_LOANS
        + " FROM loans WHERE (CAST(loan_id[2:] AS BIGINT) + installment_num) % 60 NOT BETWEEN 1 AND 6",
    ),
    "quarantine_counts": _with(
        FAULTS, select="SELECT column_name, reason, count(*) AS problems FROM problems GROUP BY ALL"
    ),
    "stream_backfill": _with(
        LOANS_TEXT,
        select="""
        SELECT *, snapshot_date AS normalized_snapshot_date,
               'lms_loan_daily.csv' AS bronze_source_file, snapshot_date AS bronze_processing_date,
               CAST(snapshot_date AS DATE) AS processing_date, CAST(snapshot_date AS DATE) AS source_date
        FROM loans_text""",
    ),
    "changed_months": _with(
        LOANS,
        select="""
        , starts AS (SELECT * FROM loans WHERE mob = 0),
        touched AS (
          SELECT snapshot_date AS month, 'loans' AS dataset FROM starts
          WHERE loan_id = (SELECT min(loan_id) FROM loans) AND balance <> 1
          UNION ALL
          SELECT snapshot_date, 'loans' FROM starts WHERE loan_id = (SELECT max(loan_id) FROM loans)
          UNION ALL
          SELECT CAST(snapshot_date + INTERVAL 1 MONTH AS DATE), 'loans' FROM starts
          WHERE loan_id = (SELECT max(loan_id) FROM loans)
          UNION ALL
          SELECT DATE '1997-03-01', 'attributes'
          FROM orders WHERE date_trunc('month', o_orderdate) = DATE '1997-03-01')
        SELECT month AS processing_date, string_agg(DISTINCT dataset, ',' ORDER BY dataset) AS datasets
        FROM touched GROUP BY month""",
    ),
    "backfill_bronze": _with(
        LOANS_TEXT,
        select="""
        SELECT *, snapshot_date AS normalized_snapshot_date,
               'lms_loan_daily.csv' AS bronze_source_file, snapshot_date AS bronze_processing_date,
               CAST(snapshot_date AS DATE) AS processing_date, CAST(snapshot_date AS DATE) AS source_date
        FROM loans_text""",
    ),
    "backfill_labels": _with(
        LOANS,
        select=f"SELECT *, snapshot_date AS processing_date FROM ({LABELS_WITHIN})",
    ),
    "partition_inventory": _with(
        LOANS,
        CUSTOMER_MONTHS,
        CLICKSTREAM,
        select="""
        , days AS (
          SELECT 'loans' AS "table", snapshot_date AS day FROM loans
          UNION ALL SELECT 'financials', month FROM customer_months
          UNION ALL SELECT 'attributes', month FROM customer_months
          UNION ALL SELECT 'clickstream', snapshot_date FROM clickstream)
        SELECT 'bronze' AS layer, "table", count(DISTINCT day) AS partitions, count(*) AS rows,
               min(day) AS first_date, max(day) AS last_date
        FROM days GROUP BY "table" """,
    ),
    "run_report": _with(
        LOANS,
        CLICKSTREAM,
        SERVED,
        select="""
        , sizes AS (SELECT snapshot_date, count(*) AS rows FROM loans GROUP BY snapshot_date)
        SELECT 'bronze' AS layer, 'loans' AS dataset, processing_date,
               CASE WHEN rows IS NULL THEN 'missing' ELSE 'done' END AS status,
               coalesce(rows, 0) AS rows
        FROM calendar LEFT JOIN sizes ON snapshot_date = processing_date
        UNION ALL SELECT 'bronze', 'attributes', processing_date, 'failed', 0 FROM calendar
        UNION ALL SELECT 'bronze', 'financials', processing_date, 'missing', 0 FROM calendar
        UNION ALL
        SELECT 'bronze', 'clickstream', processing_date, 'done',
               (SELECT count(*) FROM clickstream WHERE snapshot_date = source_date)
        FROM served""",
    ),
}

# The layout of a layer changes no result.
ORACLE_SQL["backfill_features_bucketed"] = ORACLE_SQL["backfill_features"]
