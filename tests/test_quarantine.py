import datetime as dt
import os

import pytest
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType

from vintagemill.sources import quarantine

SCHEMA = StructType(
    [
        StructField("id", StringType(), False),
        StructField("n", IntegerType()),
        StructField("x", DoubleType()),
        StructField("day", DateType()),
    ]
)
HEADER = "id,n,x,day"
GOOD = ["a,1,2.5,2023-01-01", "b,,,", '"c,""d""",3,1e3,2023-02-28']
BAD = {
    "e,one,2,2023-01-01": [("n", "one", "not a int")],
    "f,1.5,two,2023-02-30": [
        ("n", "1.5", "not a int"),
        ("x", "two", "not a double"),
        ("day", "2023-02-30", "not a date"),
    ],
    "g,1": [(None, None, "number of values")],
    "h,1,2,2023-01-01,extra,more": [(None, None, "number of values")],
    "i,99999999999,2,2023-01-01": [("n", "99999999999", "not a int")],
    "j,x": [(None, None, "number of values"), ("n", "x", "not a int")],
}


def checked(spark, folder, lines, header=HEADER, **options):
    path = folder / "source.csv"
    path.write_text("\n".join(([header] if header else []) + lines) + "\n")
    table = str(folder / "table")
    quarantine.write_checked(quarantine.checked_csv(spark, str(path), SCHEMA, **options), table)
    return quarantine.good_rows(spark, table, SCHEMA), quarantine.quarantined(spark, table, SCHEMA)


def problems(bad):
    return {r._raw: [tuple(p) for p in r._problems] for r in bad.collect()}


def test_good_and_bad_rows_are_the_source(spark, ansi, tmp_path):
    good, bad = checked(spark, tmp_path, [*GOOD, *BAD])
    assert good.columns == SCHEMA.fieldNames()
    assert sorted(tuple(r) for r in good.collect()) == [
        ("a", 1, 2.5, dt.date(2023, 1, 1)),
        ("b", None, None, None),
        ('c,"d"', 3, 1000.0, dt.date(2023, 2, 28)),
    ]
    assert problems(bad) == BAD
    # What could be read of a bad row stays.
    kept = {r.id: (r.n, r.x) for r in bad.collect()}
    assert kept["e"] == (None, 2.0) and kept["g"] == (1, None)


def test_reading_few_columns_changes_no_verdict(spark, tmp_path):
    good, bad = checked(spark, tmp_path, [*GOOD, *BAD])
    assert good.select("id").count() == len(GOOD)
    assert bad.count() == len(BAD) and good.count() == len(GOOD)


def test_repeated_and_blank_lines(spark, tmp_path):
    lines = ["e,one,2,2023-01-01"] * 3 + ["", "a,1,2.5,2023-01-01", "a,1,2.5,2023-01-01"]
    good, bad = checked(spark, tmp_path, lines)
    assert good.count() == 2 and bad.count() == 3
    counts = quarantine.problem_counts(bad).collect()
    assert [tuple(r) for r in counts] == [("n", "not a int", 3)]


def test_required_values(spark, tmp_path):
    good, bad = checked(spark, tmp_path, [*GOOD, ",7,1,2023-01-01", "k,z,1,"], required=["id", "n"])
    assert {r.id for r in good.collect()} == {"a", 'c,"d"'}
    found = sorted((r._raw or "", r.id or "", [tuple(p) for p in r._problems]) for r in bad.collect())
    assert found == [
        ("", "", [("id", None, "required and empty")]),
        ("", "b", [("n", None, "required and empty")]),
        ("k,z,1,", "k", [("n", "z", "not a int")]),
    ]


def test_headers(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text("\n".join(GOOD))
    rows = quarantine.checked_csv(spark, str(path), SCHEMA, header=False)
    assert rows.count() == len(GOOD)
    with pytest.raises(Exception, match="header"):
        checked(spark, tmp_path, GOOD, header="id,n,y,day")[0].collect()


def test_line_breaks_in_values(spark, tmp_path):
    lines = ['"two\nlines",1,2,2023-01-01', '"bad\nline",one,2,2023-01-01', "a,1,2.5,2023-01-01"]
    good, bad = checked(spark, tmp_path, lines, multiline=True)
    assert {r.id for r in good.collect()} == {"two\nlines", "a"}
    (row,) = bad.collect()
    assert [tuple(p) for p in row._problems] == [("n", "one", "not a int")]


def test_empty_file_and_clashing_names(spark, tmp_path):
    good, bad = checked(spark, tmp_path, [])
    assert good.count() == bad.count() == 0
    with pytest.raises(ValueError, match="columns"):
        quarantine.checked_csv(spark, "x", StructType([StructField("_raw", StringType())]))
    with pytest.raises(ValueError, match="required"):
        quarantine.checked_csv(spark, "x", SCHEMA, required=["y"])


def test_bad_files_stay_closed_for_good_rows(spark, tmp_path):
    """One job writes both kinds; reading one leaves the other's files alone."""
    checked(spark, tmp_path, [*GOOD, *BAD])
    folder = tmp_path / "table" / "_unreadable=true"
    for name in os.listdir(folder):
        (folder / name).write_bytes(b"broken")
        crc = folder / f".{name}.crc"
        if not name.startswith(".") and crc.exists():
            crc.unlink()
    assert quarantine.good_rows(spark, str(tmp_path / "table"), SCHEMA).count() == len(GOOD)
