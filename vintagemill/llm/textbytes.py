"""Words, lines and hashes of whole Arrow batches of texts, computed on their UTF-8 bytes.

Everything here works on the byte buffer of a text column, a bounded piece of a
batch at a time, so the cost per document is small and memory does not depend
on the batch size (a single text longer than the bound is one piece).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .worker import give_back

PIECE_BYTES = 1 << 20
U64 = np.uint64

# A word is a run of bytes other than space, tab, line feed, vertical tab, form feed, return.
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUE = np.random.default_rng(20260401).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = x.astype(U64)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, PIECE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, dtype=U64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=U64)
    return _powers["up"], _powers["down"]


class Hashes:
    """Hashes of any range of a piece's bytes (or of numbers), from one running sum."""

    def __init__(self, data: np.ndarray):
        up, self._down = _power_tables(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, dtype=U64)
        values = _BYTE_VALUE[data] if data.dtype == np.uint8 else mix(data)
        np.cumsum(values * up[: len(data)], out=self._sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mix(raw ^ ((ends - starts).astype(U64) << U64(40)))


@dataclass
class Piece:
    """Some rows of a batch: their bytes end to end, and where each text starts."""

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode()

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """The row that each byte position belongs to."""
        return np.searchsorted(self.offsets, positions, side="right") - 1


@dataclass
class Words:
    """Word boundaries of a piece; ``first[i]:first[i + 1]`` are the words of row i."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray


def pieces(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES
) -> Iterator[Piece]:
    """Cut batches into runs of rows with about ``limit`` bytes of text; null counts as empty."""
    for batch in batches:
        texts = batch.column(column).cast(pa.large_string()).fill_null("")
        if not len(texts):
            continue
        buffers = texts.buffers()
        offsets = np.frombuffer(buffers[1], dtype=np.int64)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
        body = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.empty(0, np.uint8)
        i = 0
        while i < len(texts):
            j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
            j = min(max(j, i + 1), len(texts))
            yield Piece(
                batch.slice(i, j - i), body[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            )
            i = j


def task_pieces(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[Piece]:
    """``pieces`` of all batches of a task; at their end freed memory goes back to the system."""
    yield from pieces(batches, column)
    give_back()


def words(piece: Piece) -> Words:
    """All words of a piece; a word never crosses from one text into the next."""
    inside = IS_WORD[piece.data]
    before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
    after = np.concatenate((inside[1:], [False])) if len(inside) else inside
    edges = piece.offsets[:-1][piece.offsets[:-1] < len(inside)]
    before[edges] = False
    after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, piece.offsets)
    row = np.repeat(np.arange(len(piece)), np.diff(first))
    return Words(starts, ends, row, first)


def shingles(hashes: np.ndarray, found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word n-grams of a piece, with ``first`` like that of the words.

    A text of fewer words, but at least one, has its whole sequence as its one shingle.
    """
    counts = np.diff(found.first)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(made)))
    row = np.repeat(np.arange(len(counts)), made)
    at = found.first[row] + (np.arange(first[-1]) - first[row])
    left = found.first[row + 1] - at
    # Unrelated odd factors: no two orders of the same words may add up to the same sum.
    factors = mix(np.arange(1, size + 1)) | U64(1)
    total = np.zeros(len(at), dtype=U64)
    padded = np.concatenate((hashes, np.zeros(size, dtype=U64)))
    for k in range(size):
        value = padded[at + k] * factors[k]
        total += np.where(left > k, value, U64(0)) if k else value
    return mix(total ^ np.minimum(left, size).astype(U64)), first


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of runs of values; an empty run sums to zero."""
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[first[1:]] - sums[first[:-1]]


class WordTable:
    """Numbers per distinct word, computed once and remembered up to a bound.

    ``compute`` takes a list of words and returns one value per word.  Only
    distinct words of a piece are looked up; a full table is emptied, which
    costs time and changes no result.
    """

    def __init__(self, compute: Callable[[list[str]], list], bound: int = 300_000):
        self._compute, self._bound, self._known = compute, bound, {}

    def values(self, piece: Piece, found: Words, hashes: np.ndarray) -> tuple[list, np.ndarray]:
        """The values of the distinct words of a piece, and which of them each word has."""
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self._known) > self._bound:
            self._known.clear()
        keys = distinct.tolist()
        new = [i for i, key in enumerate(keys) if key not in self._known]
        if new:
            body, where = piece.data, at[new]
            spans = zip(found.starts[where].tolist(), found.ends[where].tolist(), strict=True)
            fresh = [body[a:b].tobytes().decode() for a, b in spans]
            for i, value in zip(new, self._compute(fresh), strict=True):
                self._known[keys[i]] = value
        return [self._known[key] for key in keys], which
