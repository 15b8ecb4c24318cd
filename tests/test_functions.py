import datetime as dt

import pytest
from pyspark.sql import functions as F

from vintagemill.config import parse_snapshot_date
from vintagemill.functions import parsing

D = dt.date


def values(spark, build, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [row[0] for row in df.orderBy("i").select(build(F.col("v"))).collect()]


def check(spark, build, cases):
    assert values(spark, build, list(cases)) == list(cases.values())


def test_parse_date(spark, ansi):
    cases = {
        "2023-01-05": D(2023, 1, 5),
        "1/5/2023": D(2023, 1, 5),
        "01/05/2023": D(2023, 1, 5),
        "2023/01/05": None,
        " 2023-01-05": None,
        "": None,
        "13/45/2023": None,
        "2023-99-99": None,
        "2023-1-5": None,
        "2023-01-05 10:00": None,
        "2023-01-05\n": None,
        "2023-02-30": None,
        "1/5/2023 x": None,
        None: None,
    }
    check(spark, parsing.parse_date, cases)


def test_normalize_date(spark, ansi):
    cases = {
        "1/5/2023": "2023-01-05",
        "12/31/2023": "2023-12-31",
        "2023-01-05": "2023-01-05",
        "2023-99-99": "2023-99-99",
        "2023-01-05 10:00": "2023-01-05 10:00",
        "5 Jan 2023": None,
        "13/45/2023": None,
        None: None,
    }
    check(spark, parsing.normalize_date, cases)


def test_snapshot_day_drops_impossible_days(spark, ansi):
    cases = {"2023-99-99": None, "1/5/2023": D(2023, 1, 5), "2023-01-05 10:00": None}
    check(spark, parsing.snapshot_day, cases)


def test_parse_int(spark, ansi):
    cases = {
        "23": 23,
        "23.7": 23,
        "-23.7": -23,
        " 23 ": 23,
        "+5": 5,
        ".5": 0,
        "23_": None,
        "3e1": None,
        "23d": None,
        ".": None,
        "": None,
        "99999999999": None,
        None: None,
    }
    check(spark, parsing.parse_int, cases)


def test_clean_number(spark, ansi):
    cases = {
        "1e5": 15.0,
        "__-3.3__": -3.3,
        "_": None,
        "-": None,
        ".": None,
        "1.2.3": None,
        "1,234.5": 1234.5,
        "": None,
        None: None,
    }
    check(spark, parsing.clean_number, cases)


def test_clean_text(spark, ansi):
    cases = {"!@9#%8": "!98", "_": "_", "#": None, " a b ": "a b", "": None, None: None}
    check(spark, parsing.clean_text, cases)


def test_clean_occupation(spark, ansi):
    cases = {
        "_Manager": " Manager",
        "Media_Manager": "Media Manager",
        "_______": " " * 7,
        " Dev1per ": "Devper",
        None: None,
    }
    check(spark, parsing.clean_occupation, cases)


def test_age_and_ssn(spark, ansi):
    ages = {"17": None, "18": 18, "100": 100, "101": None, "23_": None, "40.9": 40, None: None}
    check(spark, parsing.age_in_range, ages)
    ssns = {"123-45-6789": True, "#F%$D@*&8": False, "123-45-67890": False, None: None}
    check(spark, parsing.is_valid_ssn, ssns)


def test_snapshot_date_argument():
    assert parse_snapshot_date("2023-01-05") == D(2023, 1, 5)
    assert parse_snapshot_date("1/5/2023") == D(2023, 1, 5)
    with pytest.raises(ValueError):
        parse_snapshot_date("5 Jan 2023")


def test_iso_text_is_that_of_date_format(spark, ansi):
    days = [(D(1995, 1, 31), dt.datetime(2002, 3, 31, 2, 30)), (D(2024, 2, 29), None), (None, dt.datetime(1969, 12, 31, 23, 59))]
    df = spark.createDataFrame(days, "d date, t timestamp")
    for c in ("d", "t"):
        both = df.select(parsing.iso_text(F.col(c)).alias("cast"), F.date_format(c, "yyyy-MM-dd").alias("formatted"))
        assert all(r["cast"] == r.formatted for r in both.collect())
