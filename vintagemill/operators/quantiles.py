"""Exact medians that never gather a column in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The sketch is off by at most one rank in this many.
SKETCH_ACCURACY = 100_000
SLICES = 1024


def in_long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (``metric``, ``value``) per value of the given columns; nulls and NaN are missing."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns]
    return (
        df.select(F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.*")
        .where("value is not null and not isnan(value)")
    )


def exact_medians(
    values: DataFrame, accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Median per ``metric`` of a long frame, interpolated between the two middle values.

    A first pass sketches a narrow band around the median.  A second pass counts
    the distinct values inside the band and lumps everything below and above it.
    The band is cut into ``SLICES`` of equal width; sums per slice tell in which
    the middle ranks fall, and only the values of these one or two slices are put
    in order.  The counts are exact, and so is the result; a band that missed the
    median would raise an error.
    """
    margin = 2.0 / accuracy
    band = values.groupBy("metric").agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("value", [0.5 - margin, 0.5 + margin], accuracy).alias("band"),
    )
    low, high, value = F.col("band")[0], F.col("band")[1], F.col("value")
    region = F.when(value < low, -1).when(value > high, 1).otherwise(0)
    # Halves, so that a band over the whole range of doubles has a width.
    place = (value / 2 - low / 2) / (high / 2 - low / 2)
    inner = F.when(high > low, F.least(F.floor(place * SLICES), F.lit(SLICES - 1))).otherwise(0)
    part = F.when(region < 0, -1).when(region > 0, SLICES).otherwise(inner)
    counted = (
        values.join(F.broadcast(band), "metric")
        .select("metric", "n", part.alias("slice"), F.when(region == 0, value).alias("value"))
        .groupBy("metric", "n", "slice", "value")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    # At most SLICES + 2 rows per metric.
    running = Window.partitionBy("metric").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    lower, upper = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    slices = (
        counted.groupBy("metric", "n", "slice")
        .agg(F.sum("copies").alias("rows"))
        .withColumn("before", F.sum("rows").over(running) - F.col("rows"))
    )
    first, last = F.col("before") + 1, F.col("before") + F.col("rows")
    middle = slices.where(lower.between(first, last) | upper.between(first, last))
    inside = Window.partitionBy("metric", "slice").orderBy("value")
    ranked = counted.join(F.broadcast(middle.select("metric", "slice", "before")), ["metric", "slice"])
    ranked = ranked.withColumn(
        "last_rank",
        F.col("before") + F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
    )
    first_rank = F.col("last_rank") - F.col("copies") + 1

    def at_rank(rank):
        known = F.coalesce(value, F.raise_error(F.lit("median outside its band")).cast("double"))
        return F.max(F.when(rank.between(first_rank, F.col("last_rank")), known))

    return ranked.groupBy("metric").agg(
        ((at_rank(lower) + at_rank(upper)) / 2).alias("median")
    )
