"""Operator 1: near-duplicate documents by HyperMinHash.

A document's word shingles are dealt into buckets by hash.  A bucket's register
keeps its smallest hash as a count of leading zeros and a few mantissa bits; an
empty bucket borrows the register of another by a fixed order of its own.  Equal
bands of registers make candidates; agreeing registers, less the collisions that
short registers bring by chance, estimate the Jaccard similarity; what the
estimate cannot rule out is verified on the full shingle sets.

Only components are wanted, so not every pair is looked at.  Documents of the
same set are one.  In each band group every document is first compared with the
smallest one, the hub; the best hub of a document is verified and joins it.  What
is left are pairs across components: where groups hold members of several, their
estimates are taken in bounded blocks, which return enough likely pairs to connect
what they connect.  Each part that these connect is verified on full sets, again
in bounded blocks, pair by pair until nothing likely across components is left.  A
pair that shares a band is so either verified or connected already: none is lost.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import Union, by_piece, components, forest, in_blocks
from .tables import documents, written
from .textbytes import LOWER, Hashes, Piece, pieces, shingles, task_pieces, words


@dataclass(frozen=True)
class Settings:
    """160 registers in 32 bands of 5: a pair at similarity 0.8 is missed with odds of 3 in a million.

    ``slack`` is how far an estimate may lie below the threshold and still be
    verified: four standard errors of 160 registers.  ``block`` bounds the documents
    of a task's piece, twice.
    """

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    mantissa: int = 10
    slack: float = 0.13
    block: int = 512

    @property
    def registers(self) -> int:
        return self.bands * self.rows


@functools.lru_cache(maxsize=2)
def _borrow_order(registers: int) -> np.ndarray:
    """For each bucket, the order in which it asks the others for a register."""
    rng = np.random.default_rng(20260402)
    return np.array([rng.permutation(registers) for _ in range(registers)])


def shingle_sets(piece: Piece, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of the rows of a piece, end to end, and where each row's begin."""
    lowered = Piece(piece.rows, LOWER[piece.data], piece.offsets)
    found = words(lowered)
    hashes = Hashes(lowered.data).ranges(found.starts, found.ends)
    values, first = shingles(hashes, found, size)
    sets = [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    begin = np.cumsum([0, *map(len, sets)])
    return (np.concatenate(sets) if sets else values), begin


def sketch(values: np.ndarray, begin: np.ndarray, settings: Settings) -> np.ndarray:
    """HyperMinHash registers per row (uint16, zero only for an empty set)."""
    k, rows = settings.registers, len(begin) - 1
    row = np.repeat(np.arange(rows), np.diff(begin))
    spread = (values >> np.uint64(32)) * np.uint64(k)
    bucket = (spread >> np.uint64(32)).astype(np.int64)
    # Sets are sorted and buckets follow the order of the hashes: the first is the smallest.
    place = row * k + bucket
    smallest = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1]))) if len(place) else place
    rest = np.maximum((spread[smallest] & np.uint64(0xFFFFFFFF)).astype(np.int64), 1)
    zeros = 31 - np.floor(np.log2(rest)).astype(np.int64)
    fraction = ((rest << (zeros + 1)) & 0xFFFFFFFF) >> (32 - settings.mantissa)
    table = np.zeros(rows * k, dtype=np.uint16)
    table[place[smallest]] = ((zeros + 1) << settings.mantissa) | fraction
    table = table.reshape(rows, k)
    order, own = _borrow_order(k), table.copy()
    at_row, at = np.nonzero((own == 0) & (np.diff(begin) > 0)[:, None])
    for step in range(k):
        if not len(at):
            break
        lent = own[at_row, order[at, step]]
        table[at_row, at] = lent
        still = lent == 0
        at_row, at = at_row[still], at[still]
    return table


def chance_collisions(a: np.ndarray, b: np.ndarray, mantissa: int) -> np.ndarray:
    """Odds that registers of sets of sizes a and b with nothing in common agree.

    Within a power of two of the minimum, mantissas are uniform; how far sizes
    differ lowers the odds that the powers agree.  The constant is that of the
    published estimator.
    """
    ratio = a / np.maximum(b, 1)
    return 0.169919487159739 * 2.0**-mantissa * 4 * ratio / (1 + ratio) ** 2


def estimate(
    left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, settings: Settings
) -> np.ndarray:
    """Jaccard similarity from registers, corrected for collisions by chance."""
    agree = (left == right).mean(-1)
    chance = chance_collisions(n_left, n_right, settings.mantissa)
    return np.clip((agree - chance) / (1 - chance), 0, 1)


def likely(similarity, n_left, n_right, settings: Settings):
    """Whether a pair may reach the threshold: by its estimate, and by its sizes alone."""
    share = settings.percent / 100
    sizes = np.minimum(n_left, n_right) * 100 >= np.maximum(n_left, n_right) * settings.percent
    return sizes & (similarity >= share - settings.slack)


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_id`` (a digest of the set, null if empty) and ``sketch``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in task_pieces(batches):
            values, begin = shingle_sets(piece, settings.words)
            registers = sketch(values, begin, settings)
            ends = zip(begin[:-1], begin[1:], strict=True)
            digests = [
                hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if b > a else None
                for a, b in ends
            ]
            arrays = [
                piece.rows.column("doc_id"),
                pa.array(np.diff(begin), pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array([row.tobytes() for row in registers], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "set_id", "sketch"])

    schema = "doc_id long, n_shingles long, set_id binary, sketch binary"
    read = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return read.mapInArrow(run, schema)


def _registers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=np.uint16).reshape(len(values), -1)


def _estimated(pairs: DataFrame, reps: DataFrame, settings: Settings) -> DataFrame:
    """``pairs`` (a, b) that are likely, with ``similarity``."""
    left = reps.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    right = reps.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
                s_a, s_b = _registers(batch.column("s_a")), _registers(batch.column("s_b"))
                similarity = estimate(s_a, s_b, n_a, n_b, settings)
                keep = pa.array(likely(similarity, n_a, n_b, settings))
                out = [batch.column("a"), batch.column("b"), pa.array(similarity)]
                yield pa.RecordBatch.from_arrays(out, ["a", "b", "similarity"]).filter(keep)

    sized = pairs.join(left, "a").join(right, "b")
    return sized.mapInArrow(run, "a long, b long, similarity double")


def _sets(texts: pa.Array | pa.ChunkedArray, settings: Settings) -> Iterator[np.ndarray]:
    """The shingle set of each text, in order."""
    for chunk in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        for piece in pieces([pa.RecordBatch.from_arrays([chunk], ["text"])]):
            values, begin = shingle_sets(piece, settings.words)
            for start, end in zip(begin[:-1], begin[1:], strict=True):
                yield values[start:end]


def similar(one: np.ndarray, two: np.ndarray, settings: Settings) -> bool:
    """Whether two full sets reach the threshold."""
    shared = len(np.intersect1d(one, two, assume_unique=True))
    union = len(one) + len(two) - shared
    return union > 0 and 100 * shared >= settings.percent * union


def verified(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The ``pairs`` (a, b) whose full shingle sets reach the threshold; ``texts`` (rep, text)."""
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("t_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("t_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                both = zip(_sets(batch["t_a"], settings), _sets(batch["t_b"], settings), strict=True)
                keep = pa.array([similar(one, two, settings) for one, two in both], pa.bool_())
                yield batch.select(["a", "b"]).filter(keep)

    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def _sides(piece: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows of the two parts of a piece, and whether they are one and the same part."""
    side = piece["side"].to_numpy()
    inner = piece["left_part"][0].as_py() == piece["right_part"][0].as_py()
    left = np.flatnonzero(side == 0)
    return left, left if inner else np.flatnonzero(side == 1), inner


def _likely_pairs(piece: pa.Table, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Likely pairs of different components in a piece: rows i and j, and their similarity."""
    part, n, registers = piece["component"].to_numpy(), piece["n"].to_numpy(), _registers(piece["sketch"])
    left, right, inner = _sides(piece)
    found = []
    for i in left:
        other = right[right > i] if inner else right
        other = other[part[other] != part[i]]
        if len(other):
            similarity = estimate(registers[i], registers[other], n[i], n[other], settings)
            keep = likely(similarity, n[i], n[other], settings)
            found.append((np.full(keep.sum(), i), other[keep], similarity[keep]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    i, j, similarity = (np.concatenate(x) for x in zip(*found, strict=True))
    return i, j, similarity


def _pairs_of(rep: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    a, b = np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j])
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _across(rows: DataFrame, reps: DataFrame, settings: Settings) -> DataFrame:
    """Likely pairs (a, b) that connect what is likely across components in the groups of ``rows``."""
    keys = ["key"]
    dealt = in_blocks(rows.join(reps, "rep"), keys, F.col("rep"), settings.block)

    def pairs(piece: pa.Table) -> pa.RecordBatch:
        i, j, _ = _likely_pairs(piece, settings)
        kept = forest(piece.num_rows, i, j)
        return _pairs_of(piece["rep"].to_numpy(), i[kept], j[kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_piece(batches, keys, pairs)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _settled(rows: DataFrame, settings: Settings) -> DataFrame:
    """Verified links (a, b) that connect all that is similar inside the clusters of ``rows``.

    ``rows`` has cluster, rep, component, n, sketch and text.  The shingles of a piece
    are numbered once; marking those of one document counts what it shares with all
    others in one pass over their numbers.
    """
    keys = ["cluster"]
    dealt = in_blocks(rows, keys, F.col("rep"), settings.block)

    def links(piece: pa.Table) -> pa.RecordBatch:
        i, j, _ = _likely_pairs(piece, settings)
        _, component = np.unique(piece["component"].to_numpy(), return_inverse=True)
        wanted, place = np.unique(np.concatenate((i, j)), return_inverse=True)
        at_i, at_j = place[: len(i)], place[len(i) :]
        sets = list(_sets(piece["text"].take(pa.array(wanted)), settings))
        sizes = np.array([len(x) for x in sets], dtype=np.int64)
        begin = np.concatenate(([0], np.cumsum(sizes)))
        known, number = np.unique(np.concatenate(sets) if sets else np.empty(0), return_inverse=True)
        marked, joined, kept = np.zeros(len(known), dtype=bool), Union(len(component)), []
        # Likely pairs come grouped by i.
        for group in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i)) + 1):
            if not len(group):
                continue
            own = at_i[group[0]]
            root = joined.root(int(component[i[group[0]]]))
            open_pairs = [k for k in group.tolist() if joined.root(int(component[j[k]])) != root]
            if not open_pairs:
                continue
            marked[number[begin[own] : begin[own + 1]]] = True
            others = at_j[open_pairs]
            shared = np.array([np.count_nonzero(marked[number[begin[o] : begin[o + 1]]]) for o in others])
            marked[number[begin[own] : begin[own + 1]]] = False
            union = sizes[own] + sizes[others] - shared
            for k in np.array(open_pairs)[100 * shared >= settings.percent * union].tolist():
                if joined.join(int(component[i[k]]), int(component[j[k]])):
                    kept.append(k)
        return _pairs_of(piece["rep"].to_numpy(), i[kept], j[kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_piece(batches, keys, links)

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``.

    A null or empty text, or one without words, has an empty set and is a
    component of its own.  A text of fewer words than a shingle has its whole
    sequence as one.  Equal sets form a class, named by its smallest doc_id.  Where
    one doc_id names several classes, one sketch and one text are compared for all
    of them: near copies of its other texts are not linked, and rows of one doc_id
    with different texts may lie in different components.  A row without a doc_id
    links with nothing, has no component and is kept.  Other columns are not looked at.
    """
    settings = settings or Settings()
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    marked = written(sketches(docs, settings), "sketches")
    classes = marked.where("n_shingles > 0 and doc_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"),
        F.max("n_shingles").alias("n"),
        F.max("sketch").alias("sketch"),
    )
    classes = written(classes, "classes")
    reps = classes.select("rep", "n", "sketch").dropDuplicates(["rep"])
    width = 2 * settings.rows
    band = F.col("band")
    bands = (
        reps.select("rep", "sketch", F.explode(F.sequence(F.lit(0), F.lit(settings.bands - 1))).alias("band"))
        .select("rep", F.xxhash64(band, F.substring("sketch", band * width + 1, F.lit(width))).alias("key"))
    )
    hubs = (
        bands.groupBy("key")
        .agg(F.min("rep").alias("hub"), F.max("rep").alias("last"))
        .where("hub <> last")
        .select("key", "hub")
    )
    grouped = written(bands.join(hubs, "key"), "grouped")
    pairs = grouped.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    near = written(_estimated(pairs, reps, settings), "near")
    # The most similar hub of each document; the smallest of equal ones.
    best = near.groupBy("b").agg(F.max(F.struct("similarity", -F.col("a"))).alias("best"))
    first = written(best.select((-F.col("best.col2")).alias("a"), "b"), "first")
    # The ids grow with the data, so they are not broadcast, at no size.
    members = grouped.select("rep").distinct().hint("merge")
    texts = docs.withColumnRenamed("doc_id", "rep").join(members, "rep", "left_semi")
    texts = written(texts.groupBy("rep").agg(F.min("text").alias("text")), "texts")
    links = written(verified(first, texts, settings), "first_links")
    part = components(links).select(F.col("id").alias("rep"), "component_id")
    component = F.coalesce("component_id", "rep").alias("component")
    rows = written(grouped.join(part, "rep", "left").select("key", "rep", "hub", component), "labelled")
    torn = (
        rows.groupBy("key")
        .agg(F.min("component").alias("one"), F.max("component").alias("two"), F.count("rep").alias("size"))
        .where("one <> two and size > 2")
        .select("key")
    )
    across = _across(rows.join(torn, "key").where("rep <> hub").drop("hub"), reps, settings)
    labels = rows.select("rep", "component").distinct()
    left_over = (
        near.select("a", "b")
        .join(first, ["a", "b"], "left_anti")
        .join(labels.toDF("a", "part_a"), "a")
        .join(labels.toDF("b", "part_b"), "b")
        .where("part_a <> part_b")
        .select("a", "b")
    )
    open_parts = components(across.unionAll(left_over)).select(
        F.col("id").alias("rep"), F.col("component_id").alias("cluster")
    )
    open_rows = open_parts.join(labels, "rep").join(reps, "rep").join(texts, "rep")
    every = links.unionAll(_settled(open_rows, settings))
    found = components(every).select(F.col("id").alias("rep"), "component_id")
    of_set = classes.select("set_id", "rep").join(found, "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "rep", "doc_id"))
    return (
        marked.select("doc_id", "n_shingles", "set_id")
        .join(of_set, "set_id", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def keep_one(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest doc_id; same columns.

    Of rows that share a doc_id the one that sorts first stays, rows without one all stay.
    """
    columns = docs.columns
    found = near_duplicates(docs, settings).where("kept and doc_id is not null")
    ids = written(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")), "kept")
    once = docs.join(ids.where("rows = 1"), "doc_id", "left_semi")
    again = docs.join(ids.where("rows > 1"), "doc_id", "left_semi")
    smallest = F.min_by(F.struct("*"), F.coalesce("text", F.lit(""))).alias("row")
    packed = again.groupBy("doc_id").agg(smallest).select("row.*")
    without = docs.where("doc_id is null")
    return once.select(*columns).unionAll(packed.select(*columns)).unionAll(without.select(*columns))


def op1_hyperminhash(spark, folder: str) -> DataFrame:
    """Near-duplicate components of all documents on shingles of four words."""
    return near_duplicates(documents(spark, folder), Settings(words=4))


OP1_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN []
         WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    END) AS shingle
  FROM split
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), near AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
  WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)
), links AS (
  SELECT a, b FROM near UNION ALL SELECT b, a FROM near
), reach(id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
), least AS (
  SELECT id, min(other) AS component_id FROM reach GROUP BY id
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least l ON l.id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""
