"""Point-in-time joins: each row with the latest record of its key that is not after its day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import FEATURE_MOB
from .features import attribute_features, clickstream_features, financial_features
from .store import Snapshots, spine_with_loan_features

HISTORY = ("snapshot_date", "Customer_ID")


def asof_joins(
    left: DataFrame,
    rights: dict[str, DataFrame],
    key: str,
    day: str,
    right_day: str = "snapshot_date",
    few_left_rows: bool = False,
) -> DataFrame:
    """``left`` LEFT JOIN the latest record of every right side with the same key, up to ``day``.

    Left rows and the records of all right sides move once, by key, and one sorted
    pass carries the last record of each side forward; there is no map of months and
    no join per side.  Records are folded to one per key and day first (the greatest of
    several), and so are the left rows unless there are ``few_left_rows`` of a key
    and day, so a hot key brings at most a row per day and side to its task.  Folded left
    rows get their records back by a join in which a hot key can be split.

    Added are the columns of the right sides and ``<name>_as_of``, the day of the
    record.  Null keys and days match nothing.  Columns that start with an underscore are taken.
    """
    if not rights:
        return left
    sides = [_records(frame, f"_{name}", key, right_day) for name, frame in rights.items()]
    names = list(rights)
    matchable = F.col(key).isNotNull() & F.col(day).isNotNull()
    if few_left_rows:
        # Rows without a key meet no record, so they may part; those without a day come before all.
        apart = F.when(F.col(key).isNull(), F.xxhash64(*left.columns)).otherwise(F.lit(0).cast("long"))
        asked = left.select(key, apart.alias("_apart"), F.col(day).alias("_day"), F.struct(*left.columns).alias("_left"))
        carried = _carried(asked, sides, names, key).where("_left is not null")
        found = carried.select("_left.*", *[f"_{name}" for name in names])
    else:
        asked = left.where(matchable).select(key, F.col(day).alias("_day")).distinct()
        asked = asked.withColumns({"_left": F.lit(True), "_apart": F.lit(0).cast("long")})
        carried = _carried(asked, sides, names, key).where("_left").drop("_left", "_apart").withColumnRenamed("_day", day)
        found = left.join(carried, [key, day], "left")
    columns = [
        c
        for name, frame in rights.items()
        for c in (
            *[F.col(f"_{name}.row")[p].alias(p) for p in _payload(frame, key, right_day)],
            F.col(f"_{name}.as_of").alias(f"{name}_as_of"),
        )
    ]
    return found.select(*left.columns, *columns)


def _payload(frame: DataFrame, key: str, right_day: str) -> list[str]:
    return [c for c in frame.columns if c not in (key, right_day)]


def _records(frame: DataFrame, name: str, key: str, right_day: str) -> DataFrame:
    """One record per key and day."""
    row = F.max(F.struct(*_payload(frame, key, right_day))).alias("row")
    known = frame.where(F.col(key).isNotNull() & F.col(right_day).isNotNull())
    folded = known.groupBy(key, right_day).agg(row)
    record = F.struct(F.col(right_day).alias("as_of"), "row")
    return folded.select(key, F.lit(0).cast("long").alias("_apart"), F.col(right_day).alias("_day"), record.alias(name))


def _carried(asked: DataFrame, sides: list[DataFrame], names: list[str], key: str) -> DataFrame:
    """Asked rows and records together, each with the last record of every side up to its day."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [asked, *sides])
    # A record of the same day comes before the row that asks for it.
    order = Window.partitionBy(key, "_apart").orderBy("_day", F.col("_left").isNotNull())
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns({f"_{name}": F.last(f"_{name}", ignorenulls=True).over(so_far) for name in names})


def feature_store_asof(
    loans: DataFrame,
    financials: DataFrame | None = None,
    attributes: DataFrame | None = None,
    clickstream: DataFrame | None = None,
    mob: int = FEATURE_MOB,
    ratio: str = "signed",
) -> DataFrame:
    """The feature store with every customer's latest record up to the month, however old it is.

    Inputs are silver tables; their rows count from their ``snapshot_date`` on, so nothing
    looks ahead.  Months without loans at ``mob`` take the customers that attributes,
    else financials, else clickstream date in them.  An absent dataset adds no columns.
    """
    given = {"attributes": attributes, "financials": financials, "clickstream": clickstream}
    own_months = [
        Snapshots(frame.where("snapshot_date is not null").withColumn("processing_date", F.col("snapshot_date")))
        for frame in given.values()
        if frame is not None
    ]
    spine = spine_with_loan_features(loans, own_months, mob)
    builders = {
        "financials": financial_features,
        "attributes": attribute_features,
        "clickstream": lambda df, keys: clickstream_features(df, keys, ratio),
    }
    rights = {name: build(given[name], HISTORY) for name, build in builders.items() if given[name] is not None}
    return asof_joins(spine, rights, "Customer_ID", "processing_date", few_left_rows=True)


def records_used(store: DataFrame, name: str) -> DataFrame:
    """Rows of each month by the day of the record they took from a side, for the leakage check."""
    used = store.where(F.col(f"{name}_as_of").isNotNull())
    return used.groupBy("processing_date", F.col(f"{name}_as_of").alias("snapshot_date")).agg(
        F.count(F.lit(1)).alias("rows")
    )
