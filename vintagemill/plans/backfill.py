"""Layer jobs: each runs over all requested months of a dataset at once.

Layout below the store root::

    bronze/<dataset>         partitioned by source_date
    silver/<dataset>         partitioned by source_date; by customer in buckets where asked for
    served/<dataset>         which source date serves which processing_date, for
                             datasets where that is not the month itself
    gold/feature_store       partitioned by processing_date
    gold/label_store         partitioned by label_def, processing_date
    gold/loan_label_store    partitioned by label_def: labels over all months of a loan
    counts/<layer>/...       rows of each partition, taken by the write that made it

A source date is stored and cleaned once however many months it serves; the
map fans it out when the months are read.  Writes replace whole partitions, so a
rerun of a month gives the same store.  What a run was asked for and finds no rows for any more
is deleted, as seen from the files before and after its write; a layer without
any input is an error and deletes nothing.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DATASETS, DPD_THRESHOLD, FEATURE_MOB, LABEL_MOB, SKIP, DatasetSpec
from ..functions.parsing import snapshot_day
from ..operators.bronze import dataset_source_map, source_slices, with_bronze_lineage
from ..operators.calendar import month_calendar, source_map
from ..operators.changes import changed_days, day_fingerprints, months_to_rebuild
from ..operators.labels import label_at_mob, label_within_window
from ..operators.silver import CLEANERS, with_silver_metadata
from ..operators.store import Snapshots, feature_store, with_gold_metadata
from ..sources import bucketed, metrics
from ..sources.files import (
    drop_partitions,
    partition_files,
    path_exists,
    read_csv_strings,
    read_table,
    scratch_folder,
    table_exists,
    write_table,
)

DONE, MISSING, FAILED = "done", "missing", "failed"
LOG_COLUMNS = ("layer", "dataset", "status", "error")
BY_CUSTOMER = ("Customer_ID", "source_date")


@dataclass
class JobLog:
    """Outcome of each dataset job: one entry per dataset and layer."""

    entries: list[tuple[str, str, str, str | None]] = field(default_factory=list)

    def run(self, layer: str, dataset: str, job: Callable[[], bool]) -> None:
        """Run one job; an error is recorded and does not stop the other datasets."""
        try:
            status, error = (DONE if job() else MISSING), None
        except Exception as exc:  # noqa: BLE001 - recorded in the report
            status, error = FAILED, f"{type(exc).__name__}: {exc}".splitlines()[0]
        self.entries.append((layer, dataset, status, error))

    def failures(self) -> list[tuple[str, str, str, str | None]]:
        return [entry for entry in self.entries if entry[2] == FAILED]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        schema = ", ".join(f"{name} string" for name in LOG_COLUMNS)
        return spark.createDataFrame(self.entries, schema)


@dataclass
class Store:
    """A store below one root folder.

    With ``buckets`` the silver layer is laid out by customer in so many buckets, and the
    feature store joins it without a shuffle.  A store keeps its number of buckets.
    """

    spark: SparkSession
    root: str
    log: JobLog = field(default_factory=JobLog)
    buckets: int | None = None

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def has(self, layer: str, name: str) -> bool:
        return table_exists(self.spark, self.path(layer, name))

    def read(self, layer: str, name: str) -> DataFrame:
        path = self.path(layer, name)
        rows = read_table(self.spark, path)
        if not self._by_customer(layer):
            return rows
        return bucketed.read_bucketed(self.spark, self._table(layer, name), path, rows.schema, *BY_CUSTOMER, self.buckets)

    def _by_customer(self, layer: str) -> bool:
        return self.buckets is not None and layer == "silver"

    def _table(self, layer: str, name: str) -> str:
        """The catalog name of a table: its layout lies there, its rows below the root."""
        return f"vintagemill_{layer}_{name}_{hashlib.sha256(self.root.encode()).hexdigest()[:12]}"

    def write(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        partition_by: Sequence[str],
        rebalance: bool = True,
    ) -> None:
        write_table(df, self.path(layer, name), partition_by, rebalance)

    def replace(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        column: str,
        level: tuple[str, str] | None = None,
        rebalance: bool = True,
        expected: set[str] | None = None,
    ) -> set[str]:
        """Write a table and return the stored values of a partition column that it did not touch.

        A rewritten partition has files of other names.  ``level`` is a partition
        column above with its one value.  With the ``expected`` partitions the write counts
        their rows for the report.
        """
        inside = name if level is None else f"{name}/{'='.join(level)}"
        path = self.path(layer, inside)
        before = partition_files(self.spark, path, column)
        written = None if expected is None else metrics.WrittenRows(column, expected)
        observe = written and written.attach
        if self._by_customer(layer):
            bucketed.write_bucketed(df, self._table(layer, name), path, *BY_CUSTOMER, self.buckets, observe)
        else:
            partition_by = [*([] if level is None else [level[0]]), column]
            write_table(df, self.path(layer, name), partition_by, rebalance, observe)
        after = partition_files(self.spark, path, column)
        if written is not None:
            metrics.store_counts(self.spark, self.path("counts", f"{layer}/{inside}"), written.rows(), after)
        return {value for value, files in before.items() if after.get(value) == files}

    def rows(self, layer: str, inside: str, column: str = "source_date") -> DataFrame:
        """Rows of each partition, as the writes counted them, else read off the partition."""
        counts = self.path("counts", f"{layer}/{inside}")
        return metrics.partition_rows(self.spark, self.path(layer, inside), counts, column)

    def drop(self, layer: str, name: str, column: str, values: set[str]) -> None:
        drop_partitions(self.spark, self.path(layer, name), column, sorted(values))

    def days(self, layer: str, name: str, column: str = "source_date") -> set[str]:
        """The values of a partition column, from a listing of the files."""
        return set(partition_files(self.spark, self.path(layer, name), column))

    def write_served(self, served: DataFrame, dataset: str, calendar: DataFrame) -> None:
        """Store a month map, one small row per month; months asked for and left out lose theirs."""
        rows = served.select("source_date", "processing_date").coalesce(1)
        left = self.replace(rows, "served", dataset, "processing_date", rebalance=False)
        self.drop("served", dataset, "processing_date", left & _days(calendar))

    def served_dates(self, dataset: str) -> set[str]:
        """The source dates that some month takes: at most one per month."""
        if not self.has("served", dataset):
            return set()
        dates = self.read("served", dataset).select("source_date").distinct()
        return {str(row[0]) for row in dates.collect()}

    def served(self, dataset: str, calendar: DataFrame | None = None) -> DataFrame | None:
        """The month map of a dataset, or nothing where months serve themselves."""
        if not self.has("served", dataset):
            return None
        return _in_calendar(self.read("served", dataset), "processing_date", calendar)

    def snapshots(
        self, layer: str, dataset: str, calendar: DataFrame | None = None
    ) -> Snapshots | None:
        """A dataset with its month map, or nothing where it was never loaded.

        The months prune the partitions read, at run time.
        """
        if not self.has(layer, dataset):
            return None
        rows, served = self.read(layer, dataset), self.served(dataset, calendar)
        if served is not None:
            return Snapshots(rows, served)
        own = _in_calendar(rows, "source_date", calendar)
        return Snapshots(own.withColumn("processing_date", F.col("source_date")))

    def months(self, layer: str, dataset: str, calendar: DataFrame | None = None) -> DataFrame:
        """Rows of a dataset for each ``processing_date``, their date stamps set to it."""
        found = self.snapshots(layer, dataset, calendar)
        if found is None:
            raise ValueError(f"no {layer} table of {dataset}")
        if found.served is None:
            return found.frame
        fanned = found.frame.join(F.broadcast(found.served), "source_date")
        day = F.date_format("processing_date", "yyyy-MM-dd")
        stamps = ("bronze_processing_date", "silver_processing_date")
        return fanned.withColumns({c: day for c in stamps if c in fanned.columns})

    def month(self, layer: str, dataset: str, month: dt.date) -> DataFrame:
        """Rows of one month of a dataset."""
        return self.months(layer, dataset, month_calendar(self.spark, month, month))


def _days(calendar: DataFrame) -> set[str]:
    """The months of a calendar as partition values; it has one row per month."""
    return {str(row[0]) for row in calendar.select("processing_date").collect()}


def _in_calendar(df: DataFrame, day: str, calendar: DataFrame | None) -> DataFrame:
    """Rows whose day is a calendar month; a calendar has one row per month."""
    if calendar is None:
        return df
    months = F.broadcast(calendar.withColumnRenamed("processing_date", day))
    return df.join(months, day, "left_semi")


def run_bronze(
    store: Store,
    sources: dict[str, DataFrame | str],
    calendar: DataFrame,
    specs: dict[str, DatasetSpec] = DATASETS,
) -> None:
    """Slice every source into its months.  A source is a frame or a CSV path."""
    for name, source in sources.items():
        store.log.run("bronze", name, lambda: _bronze(store, specs[name], source, calendar))


def _bronze(
    store: Store, spec: DatasetSpec, source: DataFrame | str, calendar: DataFrame
) -> bool:
    if isinstance(source, str):
        if not path_exists(store.spark, source):
            return False
        source_file, source = source, read_csv_strings(store.spark, source)
    else:
        source_file = spec.source_file
    dated = spec.date_column is not None and spec.date_column in source.columns
    before = store.served_dates(spec.name)
    if not dated:
        # Without dates every month takes all rows: one stored copy serves them all.
        day = calendar.agg(F.min("processing_date")).scalar()
        store.write_served(calendar.withColumn("source_date", day), spec.name, calendar)
        rows = source.withColumns(
            {"processed_date": F.date_format(day, "yyyy-MM-dd"), "source_date": day}
        )
    elif spec.fallback == SKIP:
        # A month serves itself, so the calendar picks the rows without a look at the dates.
        themselves = calendar.withColumn("source_date", F.col("processing_date"))
        rows = source_slices(source, themselves, spec.date_column)
    else:
        found = dataset_source_map(source, calendar, spec.fallback, spec.date_column)
        store.write_served(found, spec.name, calendar)
        if not store.has("served", spec.name):
            # No month is served any more, nor was one not asked for.
            _forget(store, spec.name, store.days("bronze", spec.name) if before else set())
            return True
        rows = source_slices(source, store.served(spec.name, calendar), spec.date_column)
    lined = with_bronze_lineage(rows, source_file, F.col("source_date"))
    own = dated and spec.fallback == SKIP
    dates = _days(calendar) if own else store.served_dates(spec.name)
    left = store.replace(lined, "bronze", spec.name, "source_date", expected=dates)
    if own:
        _forget(store, spec.name, left & dates)
    elif before:
        # Dates that a month took before this run and none takes now.
        _forget(store, spec.name, left - dates)
    return True


def _forget(store: Store, dataset: str, days: set[str]) -> None:
    """Delete stored source dates; the silver layer has the same."""
    for layer in ("bronze", "silver"):
        store.drop(layer, dataset, "source_date", days)


def run_silver(
    store: Store, datasets: Sequence[str] = tuple(DATASETS), calendar: DataFrame | None = None
) -> None:
    """Clean every bronze dataset; each source date is cleaned once."""
    for name in datasets:
        store.log.run("silver", name, lambda: _silver(store, name, calendar))


def _silver(store: Store, dataset: str, calendar: DataFrame | None) -> bool:
    if not store.has("bronze", dataset):
        return False
    bronze = store.read("bronze", dataset)
    if calendar is not None:
        served = store.served(dataset, calendar)
        if served is None:
            bronze = _in_calendar(bronze, "source_date", calendar)
        else:
            dates = served.select("source_date").distinct()
            bronze = bronze.join(F.broadcast(dates), "source_date", "left_semi")
    rows = with_silver_metadata(CLEANERS[dataset](bronze), F.col("source_date"))
    # Cleaning is row by row and bronze files hold one date each, so nothing shuffles.
    dates = store.days("bronze", dataset)
    left = store.replace(rows, "silver", dataset, "source_date", rebalance=False, expected=dates)
    store.drop("silver", dataset, "source_date", left - dates)
    return True


def _rebuild(
    store: Store,
    rows: DataFrame,
    name: str,
    calendar: DataFrame | None,
    datasets: Sequence[str],
    label_def: str | None = None,
) -> None:
    """Write a gold table and delete the stored months that were asked for and got no rows.

    Without a calendar every stored month was asked for.  ``label_def`` limits this to one definition.
    The rows are of months that some of the silver datasets serve.
    """
    level = None if label_def is None else ("label_def", label_def)
    asked = None if calendar is None else _days(calendar)
    served = set().union(*(_served_months(store, dataset) for dataset in datasets)) if asked is None else asked
    left = store.replace(rows, "gold", name, "processing_date", level, expected=served)
    months = name if label_def is None else f"{name}/label_def={label_def}"
    store.drop("gold", months, "processing_date", left if asked is None else left & asked)


def _served_months(store: Store, dataset: str) -> set[str]:
    """The months that a dataset has silver rows for, from listings."""
    if store.has("served", dataset):
        return store.days("served", dataset, "processing_date")
    return store.days("silver", dataset)


def run_features(
    store: Store, mob: int = FEATURE_MOB, calendar: DataFrame | None = None, **options
) -> None:
    store.log.run("gold", "feature_store", lambda: _features(store, mob, calendar, options))


def _features(store: Store, mob: int, calendar: DataFrame | None, options: dict) -> bool:
    inputs = {name: store.snapshots("silver", name, calendar) for name in DATASETS}
    if all(dataset is None for dataset in inputs.values()):
        raise ValueError("no silver layer to build features from")
    if inputs["loans"] is not None:
        inputs["loans"] = store.months("silver", "loans", calendar)
    # Months and customers meet where the customers lie.
    with bucketed.co_partitioned(store.spark) if store.buckets else nullcontext():
        features = feature_store(**inputs, mob=mob, co_located=store.buckets is not None, **options)
        rows = with_gold_metadata(features, F.col("processing_date"), mob)
        _rebuild(store, rows, "feature_store", calendar, list(DATASETS))
    return True


def run_labels(
    store: Store,
    dpd: int = DPD_THRESHOLD,
    mob: int = LABEL_MOB,
    label_type: str = "within_window",
    calendar: DataFrame | None = None,
) -> None:
    """Store labels; ``ever_in_window`` has one per loan and no month of its own."""
    store.log.run(
        "gold", "label_store", lambda: _labels(store, dpd, mob, label_type, calendar)
    )


def _labels(
    store: Store, dpd: int, mob: int, label_type: str, calendar: DataFrame | None
) -> bool:
    build = {"within_window": label_within_window, "at_mob": label_at_mob}.get(label_type)
    label_def = f"{dpd}dpd_at_{mob}mob" if label_type == "at_mob" else f"{dpd}dpd_within_{mob}mob"
    if not store.has("silver", "loans"):
        raise ValueError("no silver loans to build labels from")
    loans = store.months("silver", "loans", calendar)
    if label_type == "ever_in_window":
        labels = label_within_window(loans, dpd, mob, scope="loan")
        # One partition per definition, emptied where no loan has a label any more.
        left = store.replace(labels, "gold", "loan_label_store", "label_def")
        store.drop("gold", "loan_label_store", "label_def", left & {label_def})
        return True
    labels = build(loans, dpd, mob).withColumn("processing_date", F.col("snapshot_date"))
    _rebuild(store, labels, "label_store", calendar, ["loans"], label_def)
    return True


def run_report(store: Store, calendar: DataFrame, layer: str = "bronze") -> DataFrame:
    """Rows and status of every requested month of every dataset that ran in a layer.

    One row per dataset and month, by the dataset's last run.  A month is ``done``
    with its row count, ``missing`` where the dataset has nothing for it, or shares
    the ``failed`` status and error of its dataset job.
    """
    last = {entry[1]: entry for entry in store.log.entries if entry[0] == layer}
    outcome = F.array(*[_outcome(entry) for entry in last.values()])
    wanted = calendar.withColumn("outcome", F.explode(outcome.cast(f"array<{OUTCOME}>")))
    wanted = wanted.select("processing_date", "outcome.*")
    counts = store.spark.createDataFrame([], "dataset string, processing_date date, rows bigint")
    for _, name, status, _ in last.values():
        if status == DONE and store.has(layer, name):
            counts = counts.unionByName(month_counts(store, layer, name))
    rows = F.coalesce("rows", F.lit(0))
    status = F.when((F.col("status") == DONE) & (rows == 0), MISSING).otherwise(F.col("status"))
    return wanted.join(F.broadcast(counts), ["dataset", "processing_date"], "left").select(
        "layer", "dataset", "processing_date", status.alias("status"), rows.alias("rows"), "error"
    )


OUTCOME = f"struct<{','.join(f'{name}:string' for name in LOG_COLUMNS)}>"


def _outcome(entry: Sequence[str | None]) -> Column:
    named = zip(LOG_COLUMNS, entry, strict=True)
    return F.struct(*[F.lit(value).cast("string").alias(name) for name, value in named])


def month_counts(store: Store, layer: str, dataset: str) -> DataFrame:
    """Rows that each served month takes, counted per stored date before the fan-out.

    The counts are those that the writes took.  Gold tables are stored by month and have no
    date of their own; labels are added up over their definitions.
    """
    if layer == "gold":
        definitions = sorted(store.days("gold", dataset, "label_def"))
        inside = [f"{dataset}/label_def={value}" for value in definitions] or [dataset]
        used = reduce(DataFrame.unionByName, [store.rows("gold", name, "processing_date") for name in inside])
    else:
        used, served = store.rows(layer, dataset), store.served(dataset)
        if served is None:
            used = used.withColumn("processing_date", F.col("source_date"))
        else:
            used = served.join(F.broadcast(used), "source_date")
    return used.groupBy(F.lit(dataset).alias("dataset"), "processing_date").agg(
        F.sum("rows").alias("rows")
    )


def store_fingerprints(
    store: Store, sources: dict[str, DataFrame], specs: dict[str, DatasetSpec] = DATASETS
) -> None:
    """Keep the fingerprints of the sources' days, after a bronze run over all of them."""
    for name, source in sources.items():
        marks = day_fingerprints(source, snapshot_day(F.col(specs[name].date_column)))
        path = store.path("fingerprints", name)
        left = store.replace(marks.coalesce(1), "fingerprints", name, "source_date", rebalance=False)
        drop_partitions(store.spark, path, "source_date", sorted(left))


def changed_months(
    store: Store, sources: dict[str, DataFrame], calendar: DataFrame, specs: dict[str, DatasetSpec] = DATASETS
) -> dict[str, DataFrame]:
    """The months of each dated source that differ from what the store was filled from.

    Days are compared by fingerprint, one pass per source, whose row per day is written; the walk to months goes through the
    stored month map and the one that the source would get now, so a month that takes a
    changed date, or another date than before, is named.
    """
    found = {}
    for name, source in sources.items():
        spec = specs[name]
        day = snapshot_day(F.col(spec.date_column))
        path = f"{scratch_folder(store.spark)}/{name}"
        new = day_fingerprints(source, day)
        new.write.parquet(path)
        new = store.spark.read.schema(new.schema).parquet(path)
        old = store.read("fingerprints", name) if store.has("fingerprints", name) else new.limit(0)
        was = store.served(name, calendar)
        if was is None:
            dates = old.select("source_date")
            was = source_map(calendar, dates, SKIP)
        now = source_map(calendar, new.select("source_date"), spec.fallback)
        found[name] = months_to_rebuild(changed_days(old, new), was, now)
    return found


def refresh(
    store: Store, sources: dict[str, DataFrame], calendar: DataFrame, specs: dict[str, DatasetSpec] = DATASETS
) -> list[dt.date]:
    """Run bronze and silver again for the months that changed, keep the new fingerprints, name the gold months.

    A failed job leaves the old fingerprints, so the next call names its months again.
    """
    changed = changed_months(store, sources, calendar, specs)
    days = {name: [row[0] for row in df.select("processing_date").collect()] for name, df in changed.items()}
    for name, months in days.items():
        if months:
            asked = store.spark.createDataFrame([(month,) for month in months], "processing_date date")
            run_bronze(store, {name: sources[name]}, asked, specs)
            run_silver(store, [name], asked)
    if not store.log.failures():
        store_fingerprints(store, {name: sources[name] for name, months in days.items() if months}, specs)
    return sorted({month for months in days.values() for month in months})


def source_report(
    sources: dict[str, DataFrame], calendar: DataFrame, specs: dict[str, DatasetSpec] = DATASETS
) -> DataFrame:
    """What a bronze run reads of each source and what it leaves out, in one pass per source.

    Rows and columns of the source, rows whose date cannot be read, rows dated
    outside the calendar, rows dated in one of its months, and the dates' range.
    Sources without a date column serve all months: all their rows are dated.
    """
    # One row per calendar month, matched with one row per day of a source.
    months = calendar.select(F.col("processing_date").alias("day"), F.lit(True).alias("asked"))

    def of(name: str, source: DataFrame) -> DataFrame:
        column = specs[name].date_column
        dated = column is not None and column in source.columns
        day = snapshot_day(F.col(column)) if dated else F.lit(None).cast("date")
        per_day = source.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("rows"))
        inside = F.coalesce("asked", F.lit(False)) if dated else F.lit(True)
        unread = F.col("day").isNull() if dated else F.lit(False)
        rows, zero = F.col("rows"), F.lit(0)

        def total(which: Column) -> Column:
            return F.coalesce(F.sum(F.when(which, rows)), zero).cast("long")

        return per_day.join(F.broadcast(months), "day", "left").agg(
            F.lit(name).alias("dataset"),
            total(F.lit(True)).alias("source_rows"),
            F.lit(len(source.columns)).alias("columns"),
            total(unread).alias("unreadable_dates"),
            total(~unread & ~inside).alias("outside_calendar"),
            total(~unread & inside).alias("in_calendar"),
            F.min("day").alias("first_date"),
            F.max("day").alias("last_date"),
        )

    return reduce(DataFrame.unionByName, [of(name, source) for name, source in sources.items()])


def partition_inventory(store: Store, tables: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Partitions, rows and date range of each ``(layer, table, date column)``, read off the files."""

    def of(layer: str, name: str, day: Column) -> DataFrame:
        per_day = store.read(layer, name).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("rows"))
        return per_day.agg(
            F.lit(layer).alias("layer"),
            F.lit(name).alias("table"),
            F.count("day").alias("partitions"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.min("day").alias("first_date"),
            F.max("day").alias("last_date"),
        )

    frames = [of(layer, name, F.col(day)) for layer, name, day in tables if store.has(layer, name)]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
