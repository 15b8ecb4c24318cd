"""Operator 9: near-duplicate embeddings by random-hyperplane signs.

Each table hashes a vector to the signs of its products with some random
hyperplanes.  Vectors of one bucket are compared by cosine in double precision;
a pair that meets in several tables counts in the first of them only.  Equal
vectors are one while pairs are sought and counted by their number, so copies
are never expanded.  Buckets of any size are compared in bounded blocks.

A task returns, per vector, how many links it found there, and enough links to
connect what is connected: counts and a forest, not all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import by_piece, components, forest, in_blocks
from .tables import table, written


@dataclass(frozen=True)
class Settings:
    """``miss``: odds of missing a pair at the threshold; ``crowd``: unrelated vectors in a bucket.

    Bits follow from the number of vectors, so that a bucket holds about ``crowd``
    of them by chance, and tables from the bits and ``miss``.
    """

    threshold: float = 0.9
    miss: float = 1e-4
    crowd: int = 32
    least_bits: int = 8
    most_bits: int = 30
    block: int = 512
    seed: int = 20260409

    def bits(self, vectors: int) -> int:
        wanted = math.ceil(math.log2(max(2, vectors / self.crowd)))
        return min(self.most_bits, max(self.least_bits, wanted))

    def tables(self, bits: int) -> int:
        agree = 1 - math.acos(self.threshold) / math.pi
        return math.ceil(math.log(self.miss) / math.log(1 - agree**bits))


def usable(vector):
    """Null, empty, zero vectors and ones with null or non-finite components link with nothing."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square over- or underflows."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _signatures(vectors: np.ndarray, planes: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """One number per vector and table."""
    signs = (_unit(vectors) @ planes >= 0).reshape(len(vectors), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _bucketed(classes: DataFrame, size: int, settings: Settings, n: int) -> DataFrame:
    """A row per vector and table: ``tab``, ``bucket``, ``rep``, ``mark``."""
    bits = settings.bits(n)
    tables, seed = settings.tables(bits), settings.seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng((seed, size)).normal(size=(size, tables * bits))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                marks = _signatures(_matrix(part.column("vector"), size), planes, tables, bits)
                arrays = [
                    pa.array(np.tile(np.arange(tables, dtype=np.int32), len(marks))),
                    pa.array(marks.ravel()),
                    pa.array(np.repeat(part.column("rep").to_numpy(), tables)),
                    pa.array(np.repeat(part.column("mark").to_numpy(), tables)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["tab", "bucket", "rep", "mark"])

    schema = "tab int, bucket long, rep long, mark long"
    return classes.select("rep", "mark", "vector").mapInArrow(run, schema)


def _links(classes: DataFrame, size: int, settings: Settings, n: int) -> tuple[DataFrame, DataFrame]:
    """Links per vector (``rep``, ``mark``, ``n_links``), and a forest of links (``a``, ``b``)."""
    bits = settings.bits(n)
    tables, keys = settings.tables(bits), ["tab", "bucket"]
    rows = _bucketed(classes, size, settings, n)
    shared = rows.groupBy(*keys).agg(F.min("mark").alias("one"), F.max("mark").alias("two"))
    crowded = written(rows.join(shared.where("one <> two").select(*keys), keys), "buckets")
    crowded = crowded.join(classes.select("rep", "mark", "vector", "copies"), ["rep", "mark"])
    dealt = in_blocks(crowded, keys, F.col("mark"), settings.block)
    seed, threshold = settings.seed, settings.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng((seed, size)).normal(size=(size, tables * bits))

        def earlier(vectors: np.ndarray, tab: int) -> np.ndarray:
            return _signatures(vectors, planes[:, : tab * bits], tab, bits)

        def compare(piece: pa.Table) -> pa.RecordBatch | None:
            side, rep = piece["side"].to_numpy(), piece["rep"].to_numpy()
            copies, tab = piece["copies"].to_numpy(), piece["tab"][0].as_py()
            vectors = _matrix(piece["vector"], size)
            inner = piece["left_part"][0].as_py() == piece["right_part"][0].as_py()
            left = np.flatnonzero(side == 0)
            right = left if inner else np.flatnonzero(side == 1)
            units = _unit(vectors)
            near = units[left] @ units[right].T >= threshold
            if inner:
                near &= left[:, None] < right[None, :]
            at_left, at_right = np.nonzero(near)
            if not len(at_left):
                return None
            i, j = left[at_left], right[at_right]
            if tab:
                touched, place = np.unique(np.concatenate((i, j)), return_inverse=True)
                marks = earlier(vectors[touched], tab)
                fresh = np.ones(len(i), dtype=bool)
                for at in range(0, len(i), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    met = marks[place[: len(i)][part]] == marks[place[len(i) :][part]]
                    fresh[part] = ~met.any(1)
                i, j = i[fresh], j[fresh]
            counts = np.bincount(i, copies[j], len(rep)) + np.bincount(j, copies[i], len(rep))
            kept = forest(len(rep), i, j)
            a, b = rep[i[kept]], rep[j[kept]]
            some = np.flatnonzero(counts)
            count = np.arange(len(a) + len(some)) >= len(a)
            none, mark = np.zeros(len(a)), piece["mark"].to_numpy()
            arrays = [
                pa.array(np.concatenate((a, rep[some]))),
                pa.array(np.concatenate((b, mark[some]))),
                pa.array(np.concatenate((none, counts[some])).astype(np.int64)),
                pa.array(count),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["a", "b", "n_links", "is_count"])

        yield from by_piece(batches, keys, compare)

    found = written(dealt.mapInArrow(run, "a long, b long, n_links long, is_count boolean"), "found")
    counts = found.where("is_count").groupBy(F.col("a").alias("rep"), F.col("b").alias("mark"))
    return counts.agg(F.sum("n_links").alias("n_links")), found.where("not is_count").select("a", "b")


def near_duplicates(
    rows: DataFrame, settings: Settings | None = None, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row.

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing; vectors of different lengths link not with each other.  Equal
    vectors link.  Rows that share an id are vectors of their own with that id.
    Labels and other columns are not looked at.
    """
    settings = settings or Settings()
    vectors = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    good = usable(F.col("vector"))
    digest = F.sha2(F.concat_ws(",", F.transform("vector", lambda x: (x + 0.0).cast("string"))), 256)
    marked = written(vectors.withColumn("class_id", F.when(good, digest)), "vectors")
    classes = (
        marked.where("class_id is not null")
        .groupBy("class_id")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("vector").alias("vector"))
    )
    # Where rows share an id, classes may share their smallest: ``mark`` tells them apart.
    mark = F.xxhash64("class_id").alias("mark")
    classes = written(classes.select("*", mark, F.size("vector").alias("size")), "classes")
    names = classes.select("class_id", "rep", "mark", "copies")
    sizes = classes.groupBy("size").count().collect()  # one row per length of vector
    counts = links = None
    for row in sorted(sizes, key=lambda x: x["size"]):
        same = classes.where(F.col("size") == row["size"])
        own_counts, own_forest = _links(same, row["size"], settings, row["count"])
        counts = own_counts if counts is None else counts.unionAll(own_counts)
        links = own_forest if links is None else links.unionAll(own_forest)
    if counts is None:
        found = names.withColumn("n_links", F.lit(0).cast("long")).withColumn("component_id", F.col("rep"))
    else:
        parts = components(links).select(F.col("id").alias("rep"), "component_id")
        found = names.join(counts, ["rep", "mark"], "left").join(parts, "rep", "left")
    of_class = found.select(
        "class_id",
        (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"),
    )
    return (
        marked.select("vec_id", "class_id")
        .join(of_class, "class_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )


def op9_sign_hashing(spark, folder: str) -> DataFrame:
    """Near-duplicate components of all embeddings at a cosine of 0.9."""
    return near_duplicates(table(spark, folder, "embeddings"))


OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
         embedding IS NOT NULL AND len(embedding) > 0
         AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x <> 0)) > 0 AS good
  FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.good AND b.good AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach(id, other) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
), least AS (
  SELECT id, min(other) AS component_id FROM reach GROUP BY id
), counted AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, s.component_id, v.vec_id = s.component_id AS kept
FROM v JOIN least s ON v.vec_id = s.id LEFT JOIN counted c ON c.a = v.vec_id
"""
