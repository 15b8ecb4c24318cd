"""Typed CSV in one pass: good rows, and a side table of the rows that cannot be read.

The reader marks a row it cannot turn into the schema and keeps its raw line.  Both
kinds are written together, split by a partition column, so the source is read
once and either kind is read back without the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from .files import CSV_OPTIONS

RAW, TEXT, SURPLUS, PROBLEMS, UNREADABLE = "_raw", "_text", "_surplus", "_problems", "_unreadable"
PROBLEM = StructType([StructField(name, StringType()) for name in ("column_name", "value", "reason")])


def checked_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    required: Sequence[str] = (),
    header: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """The typed columns of a CSV, the raw line of a bad row, and what is wrong with it.

    A row is bad if a value is not of its column's type, if it has more or fewer values than
    columns, or if a ``required`` column is empty.  ``_problems`` names each column with its text
    and reason, in the order of the schema; a row-wide problem has no column.  A good row has
    no problems and no raw line.  Blank lines are no rows.  A bad value is null
    among the typed columns; the others keep what was read.  Names are matched without regard to case,
    as Spark does; the names that begin with an underscore above are taken.
    """
    names = schema.fieldNames()
    if len({name.lower() for name in (*names, RAW, TEXT, SURPLUS, PROBLEMS, UNREADABLE)}) != len(names) + 5:
        raise ValueError("columns of one name, or of a name that the quarantine uses")
    unknown = set(required) - set(names)
    if unknown:
        raise ValueError(f"required columns that are not in the schema: {sorted(unknown)}")
    options = CSV_OPTIONS | {"mode": "PERMISSIVE", "header": header, "multiLine": multiline}
    nullable = [StructField(f.name, f.dataType) for f in schema.fields]
    reader = spark.read.options(**options).option("columnNameOfCorruptRecord", RAW)
    # A header of other names is an error; without a header there is nothing to check.
    rows = reader.schema(StructType([*nullable, StructField(RAW, StringType())])).csv(
        path, enforceSchema=not header
    )
    # The texts of a bad row: what is text there and null among the typed columns failed.
    texts = StructType([*(StructField(name, StringType()) for name in names), StructField(SURPLUS, StringType())])
    read_again = CSV_OPTIONS | {
        "header": "false",
        "mode": "PERMISSIVE",
        "multiLine": str(multiline).lower(),
        "columnNameOfCorruptRecord": SURPLUS,
    }
    ddl = ", ".join(f"`{f.name}` string" for f in texts.fields)
    again = F.from_csv(F.col(RAW), ddl, {k: str(v) for k, v in read_again.items()})
    parsed = rows.withColumn(TEXT, F.when(F.col(RAW).isNotNull(), again))
    found = [_problem(F.col(TEXT)[SURPLUS].isNotNull(), None, None, "number of values")]
    for field in schema.fields:
        typed, text = F.col(f"`{field.name}`"), F.col(TEXT)[field.name]
        kind = f"not a {field.dataType.simpleString()}"
        found.append(_problem(typed.isNull() & text.isNotNull(), field.name, text, kind))
        if field.name in required:
            empty = typed.isNull() & text.isNull()
            found.append(_problem(empty, field.name, None, "required and empty"))
    problems = F.filter(F.array(*found), lambda p: p.isNotNull())
    # Whatever the reader marks is bad, also where no single column explains it.
    marked = F.col(RAW).isNotNull() & (F.size(problems) == 0)
    whole = F.array(_problem(marked, None, None, "unreadable"))
    problems = F.when(marked, whole).otherwise(problems)
    return parsed.withColumn(PROBLEMS, problems).drop(TEXT)


def _problem(when: Column, column: str | None, value: Column | None, reason: str) -> Column:
    value = F.lit(None) if value is None else value
    parts = zip((F.lit(column), value, F.lit(reason)), PROBLEM.names, strict=True)
    return F.when(when, F.struct(*[part.cast("string").alias(name) for part, name in parts]))


def write_checked(checked: DataFrame, path: str) -> None:
    """Write good and bad rows of ``checked_csv`` in one job, side by side."""
    bad = F.size(PROBLEMS) > 0
    checked.withColumn(UNREADABLE, bad).write.mode("overwrite").partitionBy(UNREADABLE).parquet(path)


def _read(spark: SparkSession, path: str, schema: StructType, bad: bool) -> DataFrame:
    extra = {RAW: StringType(), PROBLEMS: ArrayType(PROBLEM), UNREADABLE: BooleanType()}
    stored = [*schema.fields, *(StructField(name, kind) for name, kind in extra.items())]
    return spark.read.schema(StructType(stored)).parquet(path).where(F.col(UNREADABLE) == F.lit(bad))


def good_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The typed rows of a checked table; files of bad rows are not opened."""
    return _read(spark, path, schema, False).select(*[f"`{name}`" for name in schema.fieldNames()])


def quarantined(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The bad rows of a checked table: raw line and problems.

    The reader keeps the line of a row that it could not read.  A row that is bad only because a
    required value is empty was read, so its raw line is null and its typed columns hold it.
    """
    return _read(spark, path, schema, True)


def problem_rows(bad: DataFrame) -> DataFrame:
    """One row per problem: raw line, column, text and reason."""
    return bad.select(F.col(RAW).alias("raw"), F.explode(PROBLEMS).alias("p")).select("raw", "p.*")


def problem_counts(bad: DataFrame) -> DataFrame:
    """Problems by column and reason, combined before they shuffle."""
    named = bad.select(F.explode(PROBLEMS).alias("p")).select("p.column_name", "p.reason")
    return named.groupBy("column_name", "reason").agg(F.count(F.lit(1)).alias("problems"))
