"""Operator 7: mix sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0 to 1, linear between
knots.  Its integral is the source's demand for words up to a time.  A source
meets its demand with its documents in a fixed pseudo-random order, epoch after
epoch; the inverse of the demand gives each document the time at which its first
word is due, and a range sort by time puts the mix in training order.

Only sums per source and per hash range are gathered; no source, however hot,
is ever in one task.  The order follows from the rows alone, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import documents, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1.0, 2.0, 3.0)
MOST_EPOCHS = 3
# How the weight of a source moves over training time, by its place in the order of sources:
# fading, steady, growing.  Knots are (time, factor).
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 0.5), (1.0, 2.0)),
)
FEW_SOURCES = 10_000


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most_epochs: int = MOST_EPOCHS
) -> DataFrame:
    """Per source: ``place``, ``source_size`` and ``target``.

    Sources in the order of their code points, null last, weigh ``weights`` in
    turn and share the size of all.  A target above ``most_epochs`` times its
    source's size stops there; its excess goes to the others by weight.  With
    r = most_epochs * size / weight, the sources that stop are those of the
    smallest r, so sums over the sources sorted by r settle it at once.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", "place")
    turn = F.element_at(F.array(*map(F.lit, map(float, weights))), F.col("place") % len(weights) + 1)
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", (F.row_number().over(by_name) - 1).cast("int"))
        .withColumn("weight", turn)
        .withColumn("most", F.col("source_size") * float(most_epochs))
        .withColumn("room", F.col("most") / F.col("weight"))
        # Words and weight left if all sources before this one stop at their most.
        .withColumn("all_size", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("all_weight", F.sum("weight").over(Window.partitionBy()))
        .withColumn("left_size", F.col("all_size") - F.sum("most").over(by_room) + F.col("most"))
        .withColumn("left_weight", F.col("all_weight") - F.sum("weight").over(by_room) + F.col("weight"))
        .withColumn("share", F.col("left_size") / F.col("left_weight"))
        .withColumn("stops", F.col("share") > F.col("room"))
    )
    # Stopping is monotone in r: the first source that does not stop fixes the share of the rest.
    share = F.min(F.when(~F.col("stops"), F.struct("room", "place", "share"))).over(Window.partitionBy())
    return ranked.withColumn("level", share["share"]).select(
        "source",
        "place",
        "source_size",
        F.when(F.col("stops"), F.col("most"))
        .otherwise(F.col("level") * F.col("weight"))
        .alias("target"),
    )


def _cumulative(knots: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float]]:
    """Segments (start, area before, weight at start, slope) of a schedule scaled to area 1."""
    area, segments = 0.0, []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        segments.append((t0, area, w0, (w1 - w0) / (t1 - t0)))
        area += (w0 + w1) / 2 * (t1 - t0)
    if knots[0][0] != 0.0 or knots[-1][0] != 1.0 or area <= 0 or min(w for _, w in knots) < 0:
        raise ValueError("a schedule runs from time 0 to 1 with weights of at least 0, not all 0")
    return [(t, a / area, w / area, slope / area) for t, a, w, slope in segments]


def due_time(demand: Column, place: Column, schedules=SCHEDULES) -> Column:
    """The time at which a share ``demand`` (0 to 1) of a source's words has been asked for."""
    times = []
    for knots in schedules:
        time = F.lit(None).cast("double")
        for start, area, weight, slope in _cumulative(knots):
            rest = demand - F.lit(area)
            # Root of weight * x + slope / 2 * x^2 = rest, in the form that bears slope 0.
            root = F.sqrt(F.greatest(F.lit(0.0), F.lit(weight * weight) + 2 * slope * rest))
            below = F.lit(weight) + root
            step = F.when(below > 0, 2 * rest / below).otherwise(0.0)
            time = F.when(rest >= 0, F.lit(start) + step).otherwise(time)
        times.append(F.least(F.lit(1.0), time))
    return F.element_at(F.array(*times), place % len(schedules) + 1)


def _key(source: Column) -> Column:
    """A source as a join key that is never null."""
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source))


def _ordered_sums(sized: DataFrame, order: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """``before``: words of the documents of the same source that come first in its order.

    The order is that of a digest of the columns of ``order``, then of ``ties``; rows
    equal in all of these stand one behind the other.  Sums per source
    and digest range, in two levels of 256, give the words before each range; a
    window inside a range gives the rest, so a task holds a 65536th of the rows
    of a source.
    """
    wide = Window.partitionBy("key").orderBy("range1")
    narrow = Window.partitionBy("key", "range1").orderBy("range2")
    within = Window.partitionBy("key", "range1", "range2").orderBy("ticket", *order, *ties)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hashed = (
        sized.withColumn("key", _key(F.col("source")))
        .withColumn("ticket", F.md5(F.concat_ws("|", *order)))
        .withColumn("range1", F.substring("ticket", 1, 2))
        .withColumn("range2", F.substring("ticket", 3, 2))
    )
    level2 = hashed.groupBy("key", "range1", "range2").agg(F.sum("size").alias("words"))
    level1 = level2.groupBy("key", "range1").agg(F.sum("words").alias("words"))
    start1 = level1.select("key", "range1", (F.sum("words").over(wide) - F.col("words")).alias("start1"))
    start2 = level2.withColumn("start2", F.sum("words").over(narrow) - F.col("words")).drop("words")
    starts = start2.join(start1, ["key", "range1"])
    return (
        hashed.withColumn("start3", F.sum("size").over(so_far) - F.col("size"))
        .join(starts, ["key", "range1", "range2"], "left")
        .withColumn("before", F.col("start1") + F.col("start2") + F.col("start3"))
        .drop("start1", "start2", "start3", "range1", "range2", "ticket")
    )


def plan_mix(
    sized: DataFrame,
    order: Sequence[str],
    weights: Sequence[float] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Per row of ``sized`` (source, size and the columns of ``order``): how often it is taken.

    Adds ``place``, ``source_size``, ``target``, ``epochs``, ``before``, ``start`` and
    ``copies``.  A source takes whole epochs while its target lasts, then documents
    in its order while they fit, then the one later document whose size comes
    nearest to what is still missing, if it brings the source nearer to its target.
    ``start`` is the first word of a document's copy in the last epoch.  ``ties`` order rows that
    are equal in ``order``.  What belongs to a source is broadcast where there are at
    most ``FEW_SOURCES``, so that a hot source stays in its rows' tasks.
    """
    size, rest = F.col("source_size"), F.col("target") - F.col("epochs") * F.col("source_size")
    known = (
        source_targets(sized, weights, most_epochs)
        .withColumn("epochs", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0))
        .withColumn("rest", rest)
        .withColumn("key", _key(F.col("source")))
        .drop("source")
    )
    known = written(known, "sources")
    few = known.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES

    def of_source(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if few else rows

    ordered = _ordered_sums(sized, order, ties).join(of_source(known), "key", "left")
    end, some = F.col("before") + F.col("size"), F.col("size") > 0
    fits = end <= F.col("rest")
    slim = ordered.select("key", "before", "size", "rest")
    filled = slim.groupBy("key").agg(F.coalesce(F.max(F.when(fits, end)), F.lit(0)).alias("filled"))
    off = F.abs(F.col("rest") - F.col("filled") - F.col("size"))
    closest = (
        slim.where(some & ~fits)
        .join(of_source(filled), "key")
        .where(off < F.col("rest") - F.col("filled"))
        .groupBy("key")
        .agg(F.min(F.struct(off.alias("off"), "before")).alias("one"))
        .select("key", F.col("one.before").alias("chosen"))
    )
    late = F.coalesce(F.col("before") == F.col("chosen"), F.lit(False))
    last = F.when(fits | late, 1).otherwise(0)
    return (
        ordered.join(of_source(filled.join(closest, "key", "left")), "key", "left")
        .withColumn("copies", F.least(F.lit(most_epochs), F.col("epochs") + last))
        .withColumn("copies", F.when(some, F.col("copies")).otherwise(0).cast("int"))
        .withColumn("start", F.when(late, F.col("filled")).otherwise(F.col("before")))
        .drop("key", "rest", "filled", "chosen")
    )


def first_word(epoch: Column) -> Column:
    """Words of its source that come before a document's copy in an epoch."""
    whole = F.col("before") + epoch * F.col("source_size")
    return F.when(epoch < F.col("epochs"), whole).otherwise(
        F.col("start") + F.col("epochs") * F.col("source_size")
    )


def training_order(planned: DataFrame, schedules=SCHEDULES) -> DataFrame:
    """One row per copy, with ``epoch`` and ``position`` (time 0 to 1), range-sorted by position.

    Rows with no copies disappear here, and only here.
    """
    demand = first_word(F.col("epoch")) / F.col("target")
    return (
        planned.where("copies > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        .withColumn("position", due_time(demand, F.col("place"), schedules))
        .repartitionByRange("position", "place", "before", "epoch")
        .sortWithinPartitions("position", "place", "before", "epoch")
    )


def mix(docs: DataFrame, schedules=SCHEDULES, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, one per copy, in training order.

    Adds ``epoch`` and ``position``, in place of columns of these names.  A null
    or empty text has no words and is not taken; a null source is a source of its
    own, the last.  Rows that share a doc_id, or have none, are rows of their own: those of
    one size stand in the order of a digest of their texts, and equal rows one behind the other.
    """
    text_size = word_count(F.col("text"))
    packed = docs.select(
        "doc_id", "source", text_size.alias("size"), F.md5("text").alias("mark"), F.struct("*").alias("row")
    )
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("epoch", "position")]
    planned = plan_mix(packed, ["doc_id", "size"], ties=["mark"], **options)
    return training_order(planned, schedules).select(*kept, "epoch", "position")


def digest(docs: DataFrame) -> DataFrame:
    """Words that the mix holds of each document, and the time its first copy is due (or null).

    Both are taken from the copies of the mix in training order; documents without a copy follow from the plan.
    """
    # Texts are read once; the plan and the mix are made of these narrow rows.
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    planned = written(plan_mix(sized, ["doc_id", "size"]), "plan")
    mixed = written(training_order(planned), "mix")
    # A document with words has a place among those of its source that no other row has.
    found = mixed.groupBy("place", "before", "doc_id", "size", "source_size", "target").agg(
        F.sum("size").alias("taken"), F.round(F.min("position"), 6).alias("position")
    )
    left = planned.where("copies = 0").withColumns(
        {"taken": F.lit(0).cast("long"), "position": F.lit(None).cast("double")}
    )
    columns = ["doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), "taken", "position"]
    return found.select(*columns).unionByName(left.select(*columns))


def op7_curriculum_mix(spark, folder: str) -> DataFrame:
    """Mix all documents: sizes, targets, words taken and the time they are due."""
    return digest(documents(spark, folder))


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0
              ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size
  FROM documents
), per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM per_source
), roomy AS (
  SELECT *, CAST(place % 3 + 1 AS DOUBLE) AS weight, source_size * 3.0::DOUBLE AS most,
         source_size * 3.0::DOUBLE / (place % 3 + 1) AS room
  FROM weighed
), shared AS (
  SELECT *, (sum(source_size) OVER () - sum(most) OVER by_room + most)
            / (sum(weight) OVER () - sum(weight) OVER by_room + weight) AS share
  FROM roomy WINDOW by_room AS (ORDER BY room, place)
), targets AS (
  SELECT source, place, source_size,
         CASE WHEN share > room THEN most
              ELSE (SELECT arg_min(share, (room, place)) FROM shared WHERE share <= room) * weight
         END AS target
  FROM shared
), ordered AS (
  SELECT d.doc_id, d.size, t.place, t.source_size, t.target,
         sum(d.size) OVER (PARTITION BY d.source
                           ORDER BY md5(concat_ws('|', d.doc_id, d.size)), d.doc_id, d.size
                           ROWS UNBOUNDED PRECEDING) - d.size AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), filled AS (
  SELECT *, target - epochs * source_size AS rest,
         coalesce(max(CASE WHEN before + size <= target - epochs * source_size
                           THEN before + size END) OVER (PARTITION BY place), 0) AS filled
  FROM ordered
), late AS (
  SELECT place, arg_min(before, (abs(rest - filled - size), before)) AS chosen
  FROM filled
  WHERE size > 0 AND before + size > rest AND abs(rest - filled - size) < rest - filled
  GROUP BY place
), counted AS (
  SELECT f.*, CASE WHEN size = 0 THEN 0
                   ELSE least(3, epochs + CASE WHEN before + size <= rest OR before = chosen
                                               THEN 1 ELSE 0 END) END AS copies,
         CASE WHEN epochs = 0 AND before = chosen THEN filled ELSE before END / target AS demand
  FROM filled f LEFT JOIN late l ON f.place = l.place
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(copies * size AS BIGINT) AS taken,
       CASE WHEN copies > 0 THEN round(least(1.0::DOUBLE, CASE place % 3
         WHEN 0 THEN 2 * demand / (1.5::DOUBLE + sqrt(greatest(0, 2.25::DOUBLE - 2 * demand)))
         WHEN 1 THEN demand
         ELSE CASE WHEN demand >= 0.25::DOUBLE / 0.875
              THEN 0.5 + 2 * (demand - 0.25::DOUBLE / 0.875)
                   / (0.5::DOUBLE / 0.875 + sqrt(greatest(0, power(0.5::DOUBLE / 0.875, 2)
                      + 2 * (3.0::DOUBLE / 0.875) * (demand - 0.25::DOUBLE / 0.875))))
              ELSE 2 * demand / (0.5::DOUBLE / 0.875 + 0.5::DOUBLE / 0.875) END
       END), 6) END AS position
FROM counted
"""
