"""Layer tables laid out by customer, so that joins and aggregations by customer move nothing.

A table is partitioned by its date and bucketed and sorted by its key.  Tables of as many
buckets of the same key lie side by side: their joins by key, or by key and month, need no
exchange once ``CO_PARTITIONED`` is set in the session that runs them.

The layout lives in the session catalog; ``register`` declares it for files that a former
session wrote, and both must name the same key and number of buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A join by month and customer may use rows that are partitioned by customer alone, and rows
# keep their plain partitioning through a broadcast join, so that unions can compare it.
CO_PARTITIONED = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.broadcastHashJoin.outputPartitioningExpandLimit": "0",
}
# Inserts take this from the session, not from an option.
REPLACE_DATES = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register(
    spark: SparkSession, table: str, path: str, schema: StructType, key: str, day: str, buckets: int
) -> None:
    """Declare the layout of a table below a path, unless the catalog has it.

    A catalog entry of another path or another layout is an error, as its rows would be taken
    to lie where they do not.
    """
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({columns}) USING parquet PARTITIONED BY ({_quoted(day)}) "
        f"CLUSTERED BY ({_quoted(key)}) SORTED BY ({_quoted(key)}) INTO {int(buckets)} BUCKETS "
        f"LOCATION '{path}'"
    )
    found = {row[0]: row[1] for row in spark.sql(f"DESCRIBE EXTENDED {_quoted(table)}").collect()}
    wanted = {
        "Num Buckets": str(buckets),
        "Bucket Columns": f"[{_quoted(key)}]",
        "Location": spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath(),
    }
    found["Location"] = spark._jvm.org.apache.hadoop.fs.Path(found["Location"]).toUri().getPath()
    differs = {name: found.get(name) for name, value in wanted.items() if found.get(name) != value}
    if differs:
        raise ValueError(f"table {table} is laid out differently: {differs}")


def write_bucketed(
    df: DataFrame,
    table: str,
    path: str,
    key: str,
    day: str,
    buckets: int,
    observe: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write rows by date and customer, replacing only the dates that they belong to.

    One shuffle brings each bucket into one task, which then writes one file per date, so a
    table has at most ``buckets`` files a date.  Choose the buckets for the largest date, at some
    200 MB a file; rows without a key share a bucket.  ``observe`` gets the frame as it is written.
    """
    spark = df.sparkSession
    ordered = df.select(*[c for c in df.columns if c != day], day)
    register(spark, table, path, ordered.schema, key, day, buckets)
    stored = spark.table(_quoted(table)).columns
    if set(stored) != set(df.columns):
        raise ValueError(f"table {table} has other columns: {sorted(set(stored) ^ set(df.columns))}")
    # The same hash as that of the buckets.
    placed = ordered.select(*[_quoted(c) for c in stored]).repartition(buckets, F.col(_quoted(key)))
    placed = placed if observe is None else observe(placed)
    with _settings(spark, REPLACE_DATES):
        placed.write.insertInto(_quoted(table), overwrite=True)


def read_bucketed(
    spark: SparkSession, table: str, path: str, schema: StructType, key: str, day: str, buckets: int
) -> DataFrame:
    """The rows of a bucketed table, whoever wrote or deleted its dates."""
    register(spark, table, path, schema, key, day, buckets)
    spark.sql(f"MSCK REPAIR TABLE {_quoted(table)} SYNC PARTITIONS")
    return spark.table(_quoted(table))


def co_partitioned(spark: SparkSession) -> AbstractContextManager[None]:
    """Plan and run what is inside with ``CO_PARTITIONED``; a frame that leaves it must have run."""
    return _settings(spark, CO_PARTITIONED)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
