"""Left joins that keep every match and survive hot keys on their right sides."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import scratch_folder


def split_left_joins(
    left: DataFrame,
    rights: Sequence[DataFrame],
    keys: Sequence[str],
    rows_per_split: int | None = 1_000_000,
) -> DataFrame:
    """``left`` LEFT JOIN each of ``rights`` on the same keys; hot keys spread over several tasks.

    Spark cannot split the right side of a left join at run time.  Keys with more
    than ``rows_per_split`` rows on a right side are found up front in one aggregation over the
    keys of all sides and kept as a small table; there are at most ``rows / rows_per_split``
    of them, which bounds their broadcast.  Without any, the joins are a plain chain, for which
    the left side and each right side shuffle once.  With some, rows of hot keys take a salted path
    of their own and all others the plain chain.  ``None`` looks for no hot
    keys, for right sides known to be unique.
    """
    keys = list(keys)
    hot = hot_keys(rights, keys, rows_per_split) if rights and rows_per_split is not None else None
    if hot is None:
        return reduce(lambda df, right: df.join(right, keys, "left"), rights, left)
    few = F.broadcast(hot.select(*keys).distinct())

    def part(df: DataFrame, how: str) -> DataFrame:
        return df.join(few, keys, how)

    cold = reduce(
        lambda df, right: df.join(part(right, "left_anti"), keys, "left"), rights, part(left, "left_anti")
    )
    spread = part(left, "left_semi")
    for i, right in enumerate(rights):
        splits = hot.where(F.col("_side") == i).select(
            *keys, F.ceil(F.col("_rows") / rows_per_split).cast("int").alias("_splits")
        )
        spread = _salted(spread, part(right, "left_semi"), keys, splits)
    return cold.unionByName(spread)


def hot_keys(rights: Sequence[DataFrame], keys: Sequence[str], rows_per_split: int) -> DataFrame | None:
    """Keys with more than ``rows_per_split`` rows on a side (``_side``, ``_rows``), or nothing.

    Only the keys are read, and they are combined before they shuffle.
    """
    sides = [right.select(F.lit(i).alias("_side"), *keys) for i, right in enumerate(rights)]
    counted = reduce(DataFrame.unionAll, sides).groupBy("_side", *keys).agg(F.count(F.lit(1)).alias("_rows"))
    spark = rights[0].sparkSession
    path = f"{scratch_folder(spark)}/hot_keys"
    known = counted.where(F.col("_rows") > rows_per_split).dropna(subset=list(keys))
    known.write.parquet(path)
    hot = spark.read.schema(known.schema).parquet(path)
    return None if hot.isEmpty() else hot


def split_left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], rows_per_split: int | None = 1_000_000
) -> DataFrame:
    """``split_left_joins`` with one right side."""
    return split_left_joins(left, [right], keys, rows_per_split)


def _salted(left: DataFrame, right: DataFrame, keys: list[str], splits: DataFrame) -> DataFrame:
    """Left join in which a left row is repeated per split and each right row falls into one.

    The split of a right row follows from its content and partition, so a retried
    task repeats it, and copies in different partitions separate.
    """
    splits = F.broadcast(splits)
    repeated = left.join(splits, keys, "left").withColumn(
        "_split", F.explode(F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1))
    )
    number = F.pmod(F.xxhash64(F.spark_partition_id(), *right.columns), F.col("_splits"))
    spread = (
        right.join(splits, keys, "left")
        .withColumn("_split", F.when(F.col("_splits") > 0, number).otherwise(0).cast("int"))
        .withColumn("_matched", F.lit(True))
        .drop("_splits")
    )
    # A hot key has matches, so its row from an empty split is not a result.
    return (
        repeated.join(spread, [*keys, "_split"], "left")
        .where(F.col("_matched").isNotNull() | F.col("_splits").isNull())
        .drop("_split", "_splits", "_matched")
    )
