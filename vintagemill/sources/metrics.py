"""Row counts of partitions, taken by the write itself and kept beside the table.

A count is good for exactly the files that it was taken for: it carries a digest of their
names, and every write gives new names.  Partitions without a good count are counted by reading them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Collection

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .files import partition_files, read_table, table_exists, write_table

ALL_ROWS, BY_VALUE = "_rows", "_rows_by_value"
COUNTED = "rows bigint, digest string, partition string"


class WrittenRows:
    """Counts the rows of known partitions while a table is written.

    The metric sits in the last stage of the write, whose tasks count once however often the stages
    before it are run again.  It looks up each row's partition once, however many there are: the
    sketch of the most frequent values counts exactly while it has room for all, and it has room for
    the known ones.  Beyond, its counts no longer add up to the rows, and none is used.
    """

    def __init__(self, column: str, values: Collection[str]) -> None:
        self.column, self.values = column, sorted(values)
        # A sketch is exact below three quarters of the values that it tracks, which are at most a million.
        self._tracked = min(max(1024, 2 * len(self.values)), 1_000_000)
        self._observation = Observation()

    def attach(self, df: DataFrame) -> DataFrame:
        """The frame to write, with its counts."""
        value = F.col(self.column)
        most = F.call_function("approx_top_k", value, F.lit(self._tracked), F.lit(self._tracked))
        return df.observe(self._observation, F.count(F.lit(1)).alias(ALL_ROWS), most.alias(BY_VALUE))

    def rows(self) -> dict[str, int]:
        """Rows of each partition, after the write.  Empty if there were rows of no known partition."""
        found = self._observation.get
        known = set(self.values)
        counts = {str(value): n for value, n in found[BY_VALUE] or () if str(value) in known}
        return counts if sum(counts.values()) == found[ALL_ROWS] else {}


def _digest(files: Collection[str]) -> str:
    return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()


def store_counts(
    spark: SparkSession, path: str, rows: dict[str, int], files: dict[str, set[str]]
) -> None:
    """Keep the counts of written partitions with the digest of the files they hold now."""
    kept = [(n, _digest(files[value]), value) for value, n in rows.items() if value in files]
    if kept:
        counts = spark.createDataFrame(kept, COUNTED).coalesce(1)
        write_table(counts, path, ["partition"], rebalance=False)


def partition_rows(spark: SparkSession, table: str, counts: str, column: str) -> DataFrame:
    """Rows of each partition of a table: its values under ``column`` as dates, and ``rows``.

    Reads the kept counts, a row per partition, and the data of those partitions only whose
    count is absent or was taken for other files.
    """
    files = partition_files(spark, table, column)
    kept: dict[str, int] = {}
    if files and table_exists(spark, counts):
        stored = read_table(spark, counts).select("rows", "digest", F.col("partition").cast("string"))
        kept = {
            value: rows
            for rows, digest, value in stored.collect()
            if value in files and digest == _digest(files[value])
        }
    found = spark.createDataFrame(sorted(kept.items()), f"{column} string, rows bigint")
    found = found.select(F.col(column).cast("date").alias(column), "rows")
    rest = sorted(set(files) - set(kept))
    if rest:
        some = read_table(spark, table).where(F.col(column).cast("string").isin(rest))
        per_day = some.groupBy(F.col(column).cast("date").alias(column)).agg(F.count(F.lit(1)).alias("rows"))
        found = found.unionByName(per_day)
    return found
