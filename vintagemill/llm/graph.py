"""Connected components of links, and pairwise work inside groups of any size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written
from .worker import give_back


def _is_flat(edges: DataFrame) -> bool:
    """Whether every vertex hangs on one smaller vertex that hangs on none: stars, the end."""
    hangs = edges.select(F.col("hi").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    holds = edges.select(F.col("lo").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    per_vertex = hangs.unionAll(holds).groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per_vertex.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component_id`` (the smallest id reachable) of every id in ``links``.

    Large-star and small-star steps in turn: each vertex's larger neighbours, then
    its smaller ones, are hung on its smallest neighbour, until only stars are left.
    Minima are combined before they are shuffled, and the joins are plain, so that
    a hub with a large share of all links is split at run time.  Each round is a
    written table, so lost executors cost one round at most.
    """
    ordered = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")
    )
    edges = written(ordered.distinct(), "links")
    while not _is_flat(edges):
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = written(large.distinct(), "large")
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(smallest, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        kept = smallest.select("hi", F.col("m").alias("lo"))
        edges = written(moved.unionAll(kept).distinct(), "links")
    centres = edges.select(F.col("lo").alias("id"), F.col("lo").alias("component_id")).distinct()
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component_id")).unionAll(centres)


def in_blocks(rows: DataFrame, keys: Sequence[str], member: Column, block: int) -> DataFrame:
    """``rows`` dealt so that any two of a group meet in one bounded piece of it.

    A group of more than ``block`` rows is cut into parts by a hash of ``member``;
    a piece (``left_part``, ``right_part``) holds two of its parts, ``side`` 0 and 1, or one
    part with itself, ``side`` 0.  Pieces are contiguous within their partition.
    """
    keys = list(keys)
    counts = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = (
        rows.join(counts.where("parts > 1"), keys, "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.pmod(F.xxhash64(member), F.col("parts")).cast("int"))
        .withColumn("other", other)
        .withColumn("left_part", F.least("part", "other"))
        .withColumn("right_part", F.greatest("part", "other"))
        .withColumn("side", (F.col("part") > F.col("other")).cast("int"))
        .drop("parts", "part", "other")
    )
    piece = [*keys, "left_part", "right_part"]
    return dealt.repartition(*piece).sortWithinPartitions(*piece)


def across_blocks(left: DataFrame, right: DataFrame, keys: Sequence[str], member: Column, block: int) -> DataFrame:
    """``left`` (``side`` 0) and ``right`` (1) dealt so that any row of one meets any of the other in its group.

    Both are cut as by ``in_blocks``, each by its own size; a piece holds a part of each.
    """
    keys = list(keys)

    def parts(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(name))

    counts = parts(left, "lefts").join(parts(right, "rights"), keys)

    def dealt(rows: DataFrame, side: int) -> DataFrame:
        own, other = (("left_part", "lefts"), ("right_part", "rights"))[:: -1 if side else 1]
        return (
            rows.join(counts, keys)
            .withColumn(own[0], F.pmod(F.xxhash64(member), F.col(own[1])).cast("int"))
            .withColumn(other[0], F.explode(F.sequence(F.lit(0), F.col(other[1]) - 1)))
            .withColumn("side", F.lit(side))
            .drop("lefts", "rights")
        )

    piece = [*keys, "left_part", "right_part"]
    return dealt(left, 0).unionByName(dealt(right, 1)).repartition(*piece).sortWithinPartitions(*piece)


def by_piece(
    batches: Iterable[pa.RecordBatch],
    keys: Sequence[str],
    run: Callable[[pa.Table], pa.RecordBatch | None],
    least: int = 1,
) -> Iterator[pa.RecordBatch]:
    """Call ``run`` with the rows of each piece of ``in_blocks``, whatever batches they came in.

    Pieces of fewer than ``least`` rows are handed over whole, one after the other in a table of that many.
    """
    piece = [*keys, "left_part", "right_part"]
    held: list[pa.RecordBatch] = []
    current = None

    def done() -> Iterator[pa.RecordBatch]:
        if held:
            result = run(pa.Table.from_batches(held))
            if result is not None and result.num_rows:
                yield result
            held.clear()

    for batch in batches:
        marks = list(zip(*(batch.column(name).to_pylist() for name in piece), strict=True))
        start = 0
        while start < len(marks):
            end = start + 1
            while end < len(marks) and marks[end] == marks[start]:
                end += 1
            if marks[start] != current:
                if sum(map(len, held)) >= least:
                    yield from done()
                current = marks[start]
            held.append(batch.slice(start, end - start))
            start = end
    yield from done()
    give_back()


class Union:
    """Sets of the numbers below ``n`` that grow together."""

    def __init__(self, n: int):
        self._parent = list(range(n))

    def root(self, x: int) -> int:
        parent = self._parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether two sets have become one by this."""
        x, y = self.root(x), self.root(y)
        self._parent[y] = x
        return x != y


def forest(n: int, i: np.ndarray, j: np.ndarray) -> list[int]:
    """Which of the links (i, j) to keep so that they connect as much as all of them do."""
    sets, kept = Union(n), []
    # Hanging every member on its first partner settles most links without a look at each.
    order = np.lexsort((i, j))
    lead = order[np.concatenate(([True], j[order][1:] != j[order][:-1]))] if len(order) else order
    for k in (*lead.tolist(), *order.tolist()):
        if len(kept) == n - 1:
            break
        if sets.join(int(i[k]), int(j[k])):
            kept.append(k)
    return kept
