"""Operator 13: periodic runs of words, by longest common extensions over a difference cover.

A run is a stretch of consecutive words with smallest period q, at least
max(6, 4q) long, that no neighbouring word extends.  Two equal words q apart lie in
a stretch of period q that reaches as far back and forth as the texts from these
two words agree, so runs come from longest common extensions (LCE) of pairs
(i, i + q).  A run of period q holds at least 3q such pairs in a row: looking at every
3q-th word finds it, which makes n/3 * (1 + 1/2 + 1/3 + ...) pairs in all, a harmonic grid.

An extension compares single words until both places are in a cover of the
residues modulo 13, which any two places reach together within 12 words.  Only the
suffixes that start in the cover are sorted, 4 of 13; what two of them share is the
minimum of the neighbours' shared lengths between them, from a sparse table.
Extensions backwards are those of the reversed words.

All of it runs on whole Arrow batches, a bounded piece of texts at a time; a text is
searched as a whole.  Words are compared as 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .tables import documents
from .textbytes import Hashes, Piece, task_pieces, words

MODULUS = 13
# Every difference modulo 13 occurs between two of these.
COVER = (0, 1, 3, 9)
LEAST_LENGTH = 6
LEAST_REPEATS = 4
# Pairs of the grid that are looked at together.
GRID_PAIRS = 1 << 21


def _shifts() -> np.ndarray:
    """For any two residues the least shift that brings both into the cover."""
    covered = np.zeros(MODULUS, dtype=bool)
    covered[list(COVER)] = True
    shifts = np.zeros((MODULUS, MODULUS), dtype=np.int64)
    for a in range(MODULUS):
        for b in range(MODULUS):
            shifts[a, b] = next(
                t for t in range(MODULUS) if covered[(a + t) % MODULUS] and covered[(b + t) % MODULUS]
            )
    return shifts


SHIFTS = _shifts()


class Extensions:
    """How far two suffixes of a sequence agree, for whole arrays of pairs.

    The sequence holds numbers from 0; its last one, and every one that ends a
    text, must occur once only, so that no extension passes it.
    """

    def __init__(self, sequence: np.ndarray):
        self._words, n = sequence, len(sequence)
        places = np.arange(n)
        self._samples = places[np.isin(places % MODULUS, COVER)]
        self._index = np.full(n + 1, len(self._samples), dtype=np.int64)
        self._index[self._samples] = np.arange(len(self._samples))
        names = self._names()
        order = np.argsort(names[-1], kind="stable")
        self._rank = np.empty(len(order), dtype=np.int64)
        self._rank[order] = np.arange(len(order))
        shared = self._adjacent(order, names)
        self._minima = [shared]
        width = 1
        while 2 * width <= len(shared):
            last = self._minima[-1]
            self._minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _names(self) -> list[np.ndarray]:
        """Order-keeping numbers of the first 13, 26, 52, ... words of the sampled suffixes.

        13 words on from a sample is a sample again, so each doubling reads samples only.
        A block that holds the last word of its text is unlike any other.
        """
        n, samples = len(self._words), self._samples
        padded = np.concatenate((self._words + 1, np.zeros(MODULUS, dtype=np.int64)))
        name = np.unique(padded[samples], return_inverse=True)[1]
        for t in range(1, MODULUS):
            name = _paired(name, padded[samples + t])
        names, width = [name], MODULUS
        while width < n and len(np.unique(name)) < len(name):
            ahead = self._index[np.minimum(samples + width, n)]
            name = _paired(name, np.append(name + 1, 0)[ahead])
            names.append(name)
            width *= 2
        return names

    def _adjacent(self, order: np.ndarray, names: list[np.ndarray]) -> np.ndarray:
        """Words that each sampled suffix shares with the one before it in order."""
        n, here, there = len(self._words), self._samples[order[:-1]], self._samples[order[1:]]
        shared = np.zeros(len(here), dtype=np.int64)
        for level in range(len(names) - 1, -1, -1):
            name = np.append(names[level], -1)
            a = name[self._index[np.minimum(here + shared, n)]]
            b = name[self._index[np.minimum(there + shared, n)]]
            shared[(a == b) & (a >= 0)] += MODULUS << level
        return shared + self._agree(here + shared, there + shared, np.full(len(here), MODULUS))

    def _agree(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Equal words from two places on, counted one by one up to a limit below 14."""
        counted = np.zeros(len(a), dtype=np.int64)
        open_ = np.flatnonzero(limit > 0)
        last = len(self._words) - 1
        while len(open_):
            at = counted[open_]
            x, y = a[open_] + at, b[open_] + at
            same = (np.maximum(x, y) <= last) & (
                self._words[np.minimum(x, last)] == self._words[np.minimum(y, last)]
            )
            open_ = open_[same]
            counted[open_] += 1
            open_ = open_[counted[open_] < limit[open_]]
        return counted

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The longest common extension of the suffixes at different places a and b."""
        shift = SHIFTS[a % MODULUS, b % MODULUS]
        counted = self._agree(a, b, shift)
        far = np.flatnonzero(counted == shift)
        n = len(self._words)
        x, y = a[far] + shift[far], b[far] + shift[far]
        inside = np.maximum(x, y) < n
        far, x, y = far[inside], x[inside], y[inside]
        left, right = self._rank[self._index[x]], self._rank[self._index[y]]
        left, right = np.minimum(left, right), np.maximum(left, right)
        level = np.frexp(right - left)[1] - 1  # the widest power of two that fits
        for k in np.unique(level).tolist():
            of = level == k
            row = self._minima[k]
            counted[far[of]] += np.minimum(row[left[of]], row[right[of] - (1 << k)])
        return counted


def _paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers that order pairs of numbers from 0."""
    return np.unique(first * (int(second.max(initial=0)) + 1) + second, return_inverse=True)[1]


@dataclass
class Runs:
    """Runs of several texts: the text, its first word in the run, length and period."""

    row: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray

    def __len__(self) -> int:
        return len(self.row)


def find_runs(ids: np.ndarray, first: np.ndarray) -> Runs:
    """The runs of texts whose word numbers are ``ids[first[r]:first[r + 1]]``, in order."""
    found = [np.empty((4, 0), dtype=np.int64)]
    for place, period in _grid(ids, first):
        kept = ids[place] == ids[place + period]
        place, period = place[kept], period[kept]
        if len(place):
            found.append(_stretches(ids, first, place, period))
    row, start, length, period = np.concatenate(found, axis=1)
    # Multiples of a period find the same stretch again: the smallest is its period.
    order = np.lexsort((period, length, start, row))
    row, start, length, period = (x[order] for x in (row, start, length, period))
    new = np.ones(len(row), dtype=bool)
    new[1:] = (np.diff(row) != 0) | (np.diff(start) != 0) | (np.diff(length) != 0)
    row, start, length, period = (x[new] for x in (row, start, length, period))
    order = np.lexsort((period, start, row))
    return Runs(*(x[order] for x in (row, start, length, period)))


def _grid(ids: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods: every 3q-th word of each text for each period q that fits in four times."""
    n = np.diff(first)
    # Six words at least; a run of four words of period 1 is none.
    most = np.where(n >= LEAST_LENGTH, n // LEAST_REPEATS, 0)
    row = np.repeat(np.arange(len(n)), most)
    period = np.arange(len(row)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = (LEAST_REPEATS - 1) * period
    count = (n[row] - period + step - 1) // step
    ends = np.cumsum(count)
    at = 0
    while at < len(row):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + GRID_PAIRS, side="right")))
        of = np.repeat(np.arange(at, to), count[at:to])
        number = np.arange(len(of)) - (ends[of] - count[of] - done)
        yield first[row[of]] + number * step[of], period[of]
        at = to


def _stretches(ids: np.ndarray, first: np.ndarray, place: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Stretches of a period around pairs of equal words that are long enough: row, start, length, period."""
    row = np.searchsorted(first, place, side="right") - 1
    used, which = np.unique(row, return_inverse=True)
    sizes = first[used + 1] - first[used]
    # The texts that are left, each followed by a number of its own.
    begin = np.cumsum(sizes + 1) - sizes - 1
    sequence = np.empty(int(sizes.sum()) + len(used), dtype=np.int64)
    inside = np.ones(len(sequence), dtype=bool)
    inside[begin + sizes] = False
    of = np.repeat(first[used] - (np.cumsum(sizes) - sizes), sizes)
    chosen = ids[of + np.arange(int(sizes.sum()))]
    sequence[inside] = np.unique(chosen, return_inverse=True)[1]
    sequence[~inside] = len(chosen) + np.arange(len(used))
    at = place - first[row] + begin[which]
    forth = Extensions(sequence).agree(at, at + period)
    # Reversed, the number that ends a text comes before it, and the sequence needs an end of its own.
    end = len(chosen) + len(used)
    backwards = np.concatenate((sequence[::-1], [end]))
    back = Extensions(backwards).agree(len(sequence) - at - period, len(sequence) - at)
    length = back + period + forth
    kept = length >= np.maximum(LEAST_LENGTH, LEAST_REPEATS * period)
    start = place - first[row] - back
    return np.stack([x[kept] for x in (row, start, length, period)]).astype(np.int64)


def planted_period(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where the query makes a document of ``n`` words periodic, and with which period; nothing for most."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    start = g % n
    return start, 1 + (n - start) // (3 + g % 8)


FIELDS = (
    "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)
FOUND = ArrayType(StructType([StructField(name, LongType()) for name in ("start", "length", "period")]))


def _most_repeated(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact exponent; ties by start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _piece_runs(piece: Piece, ids: list | None) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs of each row of a piece, after the planted periods where ids are given."""
    found = words(piece)
    hashes = Hashes(piece.data).ranges(found.starts, found.ends)
    numbers = np.unique(hashes, return_inverse=True)[1].astype(np.int64)
    planted = {}
    for row, doc_id in enumerate(ids or ()):
        n = int(found.first[row + 1] - found.first[row])
        plan = planted_period(doc_id, n)
        if plan is not None:
            start, period = plan
            source = np.arange(n)
            source[start:] = start + (source[start:] - start) % period
            planted[row] = source
            numbers[found.first[row] : found.first[row + 1]] = numbers[found.first[row] + source]
    runs = find_runs(numbers, found.first)
    bounds = np.searchsorted(runs.row, np.arange(len(piece) + 1))
    listed = list(zip(runs.start.tolist(), runs.length.tolist(), runs.period.tolist(), strict=True))
    for row in range(len(piece)):
        # The same words: bytes.split() cuts at exactly the six kinds of white space.
        text = piece.data[piece.offsets[row] : piece.offsets[row + 1]].tobytes().split()
        if row in planted:
            text = [text[i] for i in planted[row].tolist()]
        yield text, listed[bounds[row] : bounds[row + 1]]


def _kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when every run keeps its first period only."""
    depth = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:n]) == 0


def collapsed(text: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that stay, joined by one space."""
    if runs:
        text = [text[i] for i in np.flatnonzero(_kept(len(text), runs)).tolist()]
    return b" ".join(text)


def periodic_runs(docs: DataFrame, text: str = "text", into: str = "runs", shorter: str | None = None) -> DataFrame:
    """Documents with their runs (``into``) and, where asked for, the text without repeats (``shorter``).

    ``runs`` are structs of start (word number from 0), length and period, by start and period.
    All rows and all other columns are kept; columns named like the new ones are replaced.
    Null and empty texts, and texts of fewer than six words, have no runs.  Equal texts
    have equal results, repeated rows included; an empty table gives an empty one.  Very
    long texts are searched whole, in memory that grows with their words times their logarithm.
    """
    added = StructType([StructField(into, FOUND), *([StructField(shorter, StringType())] if shorter else [])])
    kept = [c for c in docs.columns if c not in (into, shorter)]
    rows = docs.select(F.col(text).alias("text"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("rest"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in task_pieces(batches):
            runs, short = [], []
            for of, listed in _piece_runs(piece, None):
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in listed])
                if shorter:
                    short.append(collapsed(of, listed).decode())
            number = pa.int64()
            kind = pa.list_(pa.struct([("start", number), ("length", number), ("period", number)]))
            columns = {"rest": piece.rows.column("rest"), into: pa.array(runs, kind)}
            if shorter:
                columns[shorter] = pa.array(short, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    schema = StructType([rows.schema["rest"], *added])
    return rows.mapInArrow(search, schema).select("rest.*", into, *([shorter] if shorter else []))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in task_pieces(batches):
        ids = piece.rows.column("doc_id")
        out: list[tuple] = []
        for text, runs in _piece_runs(piece, ids.to_pylist()):
            listing = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
            best = _most_repeated(runs)
            start, length, period = best or (None, None, None)
            out.append(
                (
                    len(runs),
                    start,
                    length,
                    period,
                    None if best is None else 1000 * length // period,
                    hashlib.sha256(listing.encode()).hexdigest(),
                    hashlib.sha256(collapsed(text, runs)).hexdigest(),
                )
            )
        names = [field.split()[0] for field in FIELDS.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", *names])


def run_digests(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with the digests of op13; a document without id is left as it is."""
    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    return narrow.mapInArrow(_digests, f"doc_id bigint, {FIELDS}")


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of all documents, a tenth of them made periodic first: see the contract of op13."""
    return run_digests(documents(spark, folder))
