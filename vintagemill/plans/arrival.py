"""Months that arrive as files: a stream into the bronze layer that may repeat any step.

Every trigger takes a few files of a landing folder.  Their rows go to
``bronze/<dataset>`` below ``source_date`` and ``arrival``, a name that follows from the
files of the batch, and then the files to ``ledger/<dataset>``.  A repeated batch has the same
files, so it rewrites the same partitions; files in the ledger are not taken again, even
where the stream lost its checkpoint and deals them anew.  Partitions of an arrival that never
came into the ledger are dropped before a stream starts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..config import DATASETS, SKIP, DatasetSpec
from ..operators.bronze import source_slices, with_bronze_lineage
from ..sources.files import CSV_OPTIONS, drop_partitions, partition_files
from .backfill import Store, run_silver

ARRIVAL, FILE = "arrival", "_file"


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in columns])


def stream_bronze(
    store: Store,
    dataset: str,
    landing: str,
    columns: Sequence[str],
    calendar: DataFrame,
    checkpoint: str,
    files_per_batch: int = 100,
    silver: bool = False,
    specs: dict[str, DatasetSpec] = DATASETS,
    before_ledger: Callable[[str], None] | None = None,
) -> None:
    """Take all files that lie in a landing folder and have not been taken, then stop.

    The dataset must date its rows and serve months by their own rows.  ``silver`` cleans
    the months that a batch touched.  ``before_ledger`` is called with the name of an arrival
    when its rows are stored and its files are not yet in the ledger.
    """
    spec = specs[dataset]
    if spec.fallback != SKIP or spec.date_column not in columns:
        raise ValueError(f"{dataset} does not serve months by their own rows")
    _drop_unfinished(store, dataset)
    own = calendar.withColumn("source_date", F.col("processing_date"))
    rows = store.spark.readStream.options(**CSV_OPTIONS).option("maxFilesPerTrigger", files_per_batch)
    stream = rows.schema(text_schema(columns)).csv(landing).select("*", F.col("_metadata.file_path").alias(FILE))

    def take(batch: DataFrame, _: int) -> None:
        named = batch.select(FILE).distinct()
        if store.has("ledger", dataset):
            named = named.join(store.read("ledger", dataset).select("file"), F.col(FILE) == F.col("file"), "left_anti")
        # At most the files of one batch.
        taken = sorted(row[0] for row in named.collect())
        if not taken:
            return
        arrival = hashlib.sha256("\n".join(taken).encode()).hexdigest()[:32]
        new = source_slices(batch.where(F.col(FILE).isin(taken)).drop(FILE), own, spec.date_column)
        lined = with_bronze_lineage(new, spec.source_file, F.col("source_date")).withColumn(ARRIVAL, F.lit(arrival))
        store.write(lined, "bronze", dataset, ["source_date", ARRIVAL])
        if before_ledger is not None:
            before_ledger(arrival)
        ledger = store.spark.createDataFrame([(name,) for name in taken], "file string")
        store.write(ledger.withColumn(ARRIVAL, F.lit(arrival)), "ledger", dataset, [ARRIVAL], rebalance=False)
        if silver and store.has("bronze", dataset):
            run_silver(store, [dataset], months_of(store, dataset, [arrival]))
            if store.log.failures():
                raise RuntimeError(str(store.log.failures()))

    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def months_of(store: Store, dataset: str, arrivals: Sequence[str]) -> DataFrame:
    """A calendar of the months that some arrivals brought rows for; read off the partitions."""
    rows = store.read("bronze", dataset).where(F.col(ARRIVAL).isin(*arrivals))
    return rows.select(F.col("source_date").alias("processing_date")).distinct()


def ledger(store: Store, dataset: str) -> DataFrame:
    """Every file taken, with its arrival."""
    return store.read("ledger", dataset)


def _drop_unfinished(store: Store, dataset: str) -> None:
    """Delete partitions of arrivals that are not in the ledger."""
    days = f"{store.path('bronze', dataset)}/source_date=*"
    stored = set(partition_files(store.spark, days, ARRIVAL, literal=False))
    done = set(partition_files(store.spark, store.path("ledger", dataset), ARRIVAL))
    drop_partitions(store.spark, days, ARRIVAL, sorted(stored - done), literal=False)
