"""Command line: run layers for one snapshot date or a range of months.

    python -m vintagemill.plans.cli --layer bronze --snapshotdate 2023-01-01 \\
        --source /data --root /store
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import SparkSession

from ..config import (
    BACKFILL_END,
    BACKFILL_START,
    DATASETS,
    DPD_THRESHOLD,
    FALLBACK_POLICIES,
    FEATURE_MOB,
    LABEL_MOB,
    DatasetSpec,
    parse_snapshot_date,
)
from ..operators.calendar import month_calendar
from .backfill import Store, run_bronze, run_features, run_labels, run_silver

LAYERS = ("bronze", "silver", "features", "labels")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--layer", choices=(*LAYERS, "all"), default="all")
    p.add_argument("--snapshotdate", help="run this month only, YYYY-MM-DD or M/D/YYYY")
    p.add_argument("--start", default=BACKFILL_START)
    p.add_argument("--end", default=BACKFILL_END)
    p.add_argument("--source", required=True, help="folder of the source CSV files")
    p.add_argument("--root", required=True, help="root folder of the store")
    p.add_argument("--dataset", action="append", choices=tuple(DATASETS))
    p.add_argument("--mob", type=int, default=LABEL_MOB, help="month-on-book of the label")
    p.add_argument("--dpd", type=int, default=DPD_THRESHOLD)
    p.add_argument(
        "--fallback",
        action="append",
        default=[],
        metavar="DATASET=POLICY",
        help=f"what an empty month of a dataset takes: {', '.join(FALLBACK_POLICIES)}",
    )
    p.add_argument("--buckets", type=int, help="lay silver out by customer in so many buckets")
    p.add_argument(
        "--label-type", choices=("within_window", "at_mob", "ever_in_window"), default="within_window"
    )
    return p


def dataset_specs(fallbacks: Sequence[str]) -> dict[str, DatasetSpec]:
    """The datasets with the fallback policies named as ``DATASET=POLICY``."""
    specs = dict(DATASETS)
    for text in fallbacks:
        name, _, policy = text.partition("=")
        if name not in specs or policy not in FALLBACK_POLICIES:
            raise ValueError(f"{text!r} is not a dataset and one of {', '.join(FALLBACK_POLICIES)}")
        specs[name] = replace(specs[name], fallback=policy)
    return specs


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("vintagemill").getOrCreate()
    first = parse_snapshot_date(args.snapshotdate or args.start)
    last = parse_snapshot_date(args.snapshotdate or args.end)
    calendar = month_calendar(spark, first, last)
    datasets = args.dataset or list(DATASETS)
    specs = dataset_specs(args.fallback)
    store = Store(spark, args.root, buckets=args.buckets)
    layers = LAYERS if args.layer == "all" else (args.layer,)
    if "bronze" in layers:
        paths = {name: f"{args.source}/{DATASETS[name].source_file}" for name in datasets}
        run_bronze(store, paths, calendar, specs)
    if "silver" in layers:
        run_silver(store, datasets, calendar)
    if "features" in layers:
        run_features(store, FEATURE_MOB, calendar)
    if "labels" in layers:
        run_labels(store, args.dpd, args.mob, args.label_type, calendar)
    for layer, dataset, status, error in store.log.entries:
        print(f"{layer}/{dataset}: {status}" + (f" ({error})" if error else ""))
    return 1 if store.log.failures() else 0


if __name__ == "__main__":
    sys.exit(main())
