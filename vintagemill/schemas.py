"""Schemas of the source and silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from .operators.silver import (
    FEATURE_PREFIX,
    FINANCIAL_NUMBERS,
    FINANCIAL_TEXT,
    LOAN_AMOUNTS,
)

CLICKSTREAM_FEATURES = tuple(f"{FEATURE_PREFIX}{i}" for i in range(1, 21))


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_STRING, _INT, _DOUBLE, _DATE = StringType(), IntegerType(), DoubleType(), DateType()

LOANS_TYPED = _schema(
    loan_id=_STRING,
    Customer_ID=_STRING,
    loan_start_date=_DATE,
    tenure=_INT,
    installment_num=_INT,
    **{c: FloatType() for c in LOAN_AMOUNTS},
    snapshot_date=_DATE,
)
SILVER = {
    "loans": StructType(
        [
            *LOANS_TYPED.fields,
            *_schema(mob=_INT, installments_missed=_INT, first_missed_date=_DATE, dpd=_INT).fields,
        ]
    ),
    "financials": _schema(
        Customer_ID=_STRING,
        **{c: _STRING for c in FINANCIAL_TEXT},
        **{c: _DOUBLE for c in FINANCIAL_NUMBERS},
        snapshot_date=_DATE,
        debt_to_income_ratio=_DOUBLE,
        monthly_debt_service_ratio=_DOUBLE,
    ),
    "attributes": _schema(
        Customer_ID=_STRING,
        Name=_STRING,
        Age=_INT,
        SSN=_STRING,
        Occupation=_STRING,
        snapshot_date=_DATE,
        Name_cleaned=_STRING,
        SSN_is_valid=BooleanType(),
        SSN_cleaned=_STRING,
    ),
    "clickstream": _schema(
        Customer_ID=_STRING,
        **{c: _DOUBLE for c in CLICKSTREAM_FEATURES},
        snapshot_date=_DATE,
        total_positive_features=_DOUBLE,
        total_negative_features=_DOUBLE,
        feature_balance_ratio=_DOUBLE,
    ),
}


def empty_silver(spark: SparkSession, dataset: str) -> DataFrame:
    """An absent dataset as a frame without rows, so that the gold schema stays the same."""
    processed = StructField("processing_date", _DATE)
    return spark.createDataFrame([], StructType([*SILVER[dataset].fields, processed]))
