"""Which months changed: fingerprints of the rows of a day that do not depend on their order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADDED, REMOVED, ALTERED = "added", "removed", "altered"
DIGITS = "decimal(38,0)"
MARKS = ("rows", "sum_1", "sum_2")


def row_hash(columns: list[str], salt: str) -> Column:
    """A 64-bit hash of a row; a null is told from any other value, whatever its column."""
    shape = F.concat_ws("", *[F.col(f"`{c}`").isNull().cast("int") for c in columns])
    return F.xxhash64(F.lit(salt), shape, *[F.col(f"`{c}`") for c in columns])


def day_fingerprints(rows: DataFrame, day: Column) -> DataFrame:
    """Rows and two sums of row hashes per ``source_date``; repeated rows count as often as they occur.

    One aggregation, which combines before it shuffles to one row per day.  Columns
    count by name, so their order does not matter; rows without a day are left out.
    """
    columns = sorted(rows.columns)
    sums = [F.sum(row_hash(columns, salt).cast("decimal(20,0)")).cast(DIGITS).alias(salt) for salt in MARKS[1:]]
    return (
        rows.withColumn("_day", day)
        .where("_day is not null")
        .groupBy(F.col("_day").alias("source_date"))
        .agg(F.count(F.lit(1)).alias("rows"), *sums)
    )


def changed_days(old: DataFrame, new: DataFrame) -> DataFrame:
    """Days whose fingerprints differ, with what happened to them; both sides have a row per day."""
    a = old.select("source_date", F.struct(*MARKS).alias("old"))
    b = new.select("source_date", F.struct(*MARKS).alias("new"))
    change = (
        F.when(F.col("old").isNull(), ADDED).when(F.col("new").isNull(), REMOVED).otherwise(ALTERED).alias("change")
    )
    both = a.join(b, "source_date", "full").where(~F.col("old").eqNullSafe(F.col("new")))
    return both.select("source_date", change)


def months_to_rebuild(days: DataFrame, old_map: DataFrame, new_map: DataFrame) -> DataFrame:
    """Months that took or take a changed day, or take another day than before.

    The maps have one row per month (``processing_date``, ``source_date``).  A month that is
    served anew, by another date or no more is among them.
    """
    maps = old_map.select("processing_date", F.col("source_date").alias("old_date")).join(
        new_map.select("processing_date", F.col("source_date").alias("new_date")), "processing_date", "full"
    )
    # One row per changed day, for each of the two dates of a month.
    before, after = (
        days.select(F.col("source_date").alias(date), F.col("change").alias(change))
        for date, change in (("old_date", "old_change"), ("new_date", "new_change"))
    )
    seen = maps.join(before, "old_date", "left").join(after, "new_date", "left")
    moved = ~F.col("old_date").eqNullSafe(F.col("new_date"))
    kind = F.when(F.col("old_date").isNull(), ADDED).when(F.col("new_date").isNull(), REMOVED).otherwise(ALTERED)
    rebuilt = seen.where(moved | F.col("old_change").isNotNull() | F.col("new_change").isNotNull())
    return rebuilt.select("processing_date", "old_date", "new_date", kind.alias("change"))


def by_month(found: dict[str, DataFrame]) -> DataFrame:
    """Gold months with the datasets that they are to be rebuilt for."""
    tagged = [df.select("processing_date", F.lit(name).alias("dataset")) for name, df in found.items()]
    every = reduce(DataFrame.unionByName, tagged)
    return every.groupBy("processing_date").agg(F.array_join(F.array_sort(F.collect_set("dataset")), ",").alias("datasets"))
