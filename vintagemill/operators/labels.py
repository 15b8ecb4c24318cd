"""Gold label builders: default flags by days past due at or within a month-on-book."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DPD_THRESHOLD, LABEL_MOB
from ..functions.arithmetic import flag, percent

LABEL_COLUMNS = ("loan_id", "Customer_ID", "label", "label_def", "snapshot_date")


def _bad(dpd: int):
    return flag(F.col("dpd") >= dpd)


def label_within_window(
    loans: DataFrame,
    dpd: int = DPD_THRESHOLD,
    mob: int = LABEL_MOB,
    scope: str = "snapshot",
) -> DataFrame:
    """1 where the threshold is reached at a month-on-book from 1 to ``mob``.

    ``scope="snapshot"`` gives a label per loan and snapshot month;
    ``scope="loan"`` looks across all snapshots and gives one label per loan.
    """
    keys = {
        "snapshot": ("loan_id", "Customer_ID", "snapshot_date"),
        "loan": ("loan_id", "Customer_ID"),
    }[scope]
    return (
        loans.where(F.col("mob").between(1, mob))
        .groupBy(*keys)
        .agg(F.max(_bad(dpd)).alias("label"))
        .withColumn("label_def", F.lit(f"{dpd}dpd_within_{mob}mob"))
    )


def label_at_mob(
    loans: DataFrame,
    dpd: int = DPD_THRESHOLD,
    mob: int = LABEL_MOB,
    label_def: str | None = None,
) -> DataFrame:
    """1 where the threshold is reached exactly at month-on-book ``mob``."""
    named = label_def or f"{dpd}dpd_at_{mob}mob"
    labelled = loans.where(F.col("mob") == mob).withColumns(
        {"label": _bad(dpd), "label_def": F.lit(named)}
    )
    return labelled.select(*LABEL_COLUMNS)


def label_at_mob_small(
    loans: DataFrame, dpd: int = DPD_THRESHOLD, mob: int = LABEL_MOB
) -> DataFrame:
    """The loans-only variant of :func:`label_at_mob`, with its shorter definition text."""
    return label_at_mob(loans, dpd, mob, label_def=f"{dpd}dpd_{mob}mob")


def label_distribution(labels: DataFrame, by: Sequence[str] = ("label",)) -> DataFrame:
    """Count and percentage of each label; the window runs over the few label rows."""
    everything = Window.partitionBy(F.lit(1))
    counts = labels.groupBy(*by).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("pct", percent(F.col("count"), F.sum("count").over(everything)))
