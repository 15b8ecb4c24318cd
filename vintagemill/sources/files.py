"""CSV and Parquet readers and writers of the layer tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Quotes inside quoted values are doubled, as CSV writers do.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def read_csv_strings(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """CSV with every column as text, named by the header line.

    Only the header is looked at up front.  ``multiline`` accepts line breaks
    inside values, at the price of one task per file.
    """
    return spark.read.options(**CSV_OPTIONS).csv(path, inferSchema=False, multiLine=multiline)


def read_csv_typed(
    spark: SparkSession, path: str, schema: StructType | None = None, multiline: bool = False
) -> DataFrame:
    """CSV with typed columns: a given schema, checked against the header, or inference.

    Inference reads the data one more time.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multiline)
    if schema is None:
        return reader.csv(path, inferSchema=True)
    return reader.schema(schema).csv(path, enforceSchema=False)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export in parallel part files; empty text reads back as null."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    rebalance: bool = True,
    observe: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write a layer table, replacing only the partitions that the rows belong to.

    Rebalancing by the partition columns lets adaptive execution merge small
    months into few files and split a month that holds much of the data.  Rows
    that come from files of the same partitions need no such shuffle.  ``observe``
    gets the frame as it is written.
    """
    if rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if observe is not None:
        df = observe(df)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """All snapshots of a layer table.

    ``merge_schema`` reads every file footer to accept months with other
    columns; the layer jobs write one schema and do without.
    """
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def drop_partitions(
    spark: SparkSession, path: str, column: str, values: Sequence[str], literal: bool = True
) -> None:
    """Delete exactly the named partitions of a table; a path that is not literal may be a pattern."""
    file_system, root = _file_system(spark, path)
    if not values or (literal and not file_system.exists(root)):
        return
    for value in values:
        found = file_system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}"))
        for status in found or ():
            file_system.delete(status.getPath(), True)


def partition_files(
    spark: SparkSession, path: str, column: str, literal: bool = True
) -> dict[str, set[str]]:
    """The file names of each partition of a table, by its value; a rewritten partition has new names.

    A path that is not literal may be a pattern.
    """
    file_system, root = _file_system(spark, path)
    files: dict[str, set[str]] = {}
    if not literal or file_system.exists(root):
        pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}=*/*")
        for status in file_system.globStatus(pattern) or ():
            value = status.getPath().getParent().getName().split("=", 1)[1]
            files.setdefault(value, set()).add(status.getPath().getName())
    return files


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    file_system, hadoop_path = _file_system(spark, path)
    return bool(file_system.exists(hadoop_path))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a partitioned table lies there with at least one partition."""
    file_system, hadoop_path = _file_system(spark, path)
    if not file_system.exists(hadoop_path):
        return False
    return any("=" in child.getPath().getName() for child in file_system.listStatus(hadoop_path))


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below a shared one: ``spark.checkpoint.dir``, else the session's warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{shared.rstrip('/')}/vintagemill-{uuid.uuid4().hex}"
