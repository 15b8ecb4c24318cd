"""The input tables and written intermediate tables of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import scratch_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    It cuts the lineage and survives lost executors, unlike a cache.  With ``free``
    the shuffle files of the write are removed when it is done.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{name}"
    before = spark.conf.get(_FREE)
    spark.conf.set(_FREE, str(free or before == "true").lower())
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FREE, before)
    return spark.read.schema(df.schema).parquet(path)
