"""Operator 3: count tokens of a unigram vocabulary without building them.

An Aho-Corasick automaton enumerates every vocabulary entry inside a word; the
Viterbi recurrence over end positions carries the best score and the number of
pieces on the best path, nothing else.

Rules, as in the public unigram tokenisers: white space becomes the word mark, a
mark is put before the text, and a new word starts at every mark.  A character
that is no entry of its own may be taken as unknown, at the lowest score less 10;
runs of unknown characters are one unknown piece, and with byte fallback an
unknown piece counts one token per UTF-8 byte.  Of equal scores the path found
first stays: starts from left to right, at a start shorter entries first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType

from .tables import documents
from .worker import kept_table

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 300_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores; ``byte_fallback``: unknown characters are counted in bytes."""

    scores: dict[str, float]
    byte_fallback: bool

    @property
    def unknown_score(self) -> float:
        return min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces of a sentencepiece file as a unigram vocabulary.

    A file of merges gives ranks, not probabilities: a piece of rank r has the
    log probability of Zipf's law, -log(r + 1) up to a constant.  A unigram file
    keeps its own scores.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.vocab_size())
    usable = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    given = [model.get_score(i) for i in usable]
    ranked = all(score <= 0 and score == int(score) for score in given)
    scores = {
        model.id_to_piece(i): -math.log(1 - score) if ranked else score
        for i, score in zip(usable, given, strict=True)
    }
    return Vocabulary(scores, any(model.is_byte(i) for i in ids))


class Counter:
    """Counts the tokens of words; remembers words in two generations."""

    def __init__(self, vocabulary: Vocabulary):
        self._vocabulary, self._unknown = vocabulary, vocabulary.unknown_score
        self._single = {piece for piece in vocabulary.scores if len(piece) == 1}
        self._matches = ahocorasick.Automaton()
        for piece, score in vocabulary.scores.items():
            self._matches.add_word(piece, (len(piece), score))
        self._matches.make_automaton()
        self._new: dict[str, int] = {}
        self._old: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Tokens of one word, mark included."""
        count = self._new.get(word)
        if count is None:
            count = self._old.get(word)
            if count is None:
                count = self._viterbi(word)
            if len(self._new) >= REMEMBERED:
                self._old, self._new = self._new, {}
            if len(word) <= 64:
                self._new[word] = count
        return count

    def _viterbi(self, word: str) -> int:
        size, lost = len(word), -math.inf
        best, pieces = [lost] * (size + 1), [0] * (size + 1)
        best[0] = 0.0
        # Whether the best path to a position ends in an unknown run; runs count once.
        open_run = [False] * (size + 1)
        fallback = self._vocabulary.byte_fallback
        unknown = [character not in self._single for character in word]
        ending: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        # An empty vocabulary has no automaton to run.
        for end, match in self._matches.iter(word) if len(self._matches) else ():
            ending[end].append(match)
        for end in range(1, size + 1):
            # Longest first is leftmost start first, the order in which ties are settled.
            for length, score in sorted(ending[end - 1], reverse=True):
                start = end - length
                total = best[start] + score
                if total > best[end]:
                    best[end], pieces[end], open_run[end] = total, pieces[start] + 1, False
            start = end - 1
            if unknown[start]:
                total = best[start] + self._unknown
                if total > best[end]:
                    cost = 0 if open_run[start] else 1
                    if fallback:
                        cost = len(word[start].encode())
                    best[end], pieces[end] = total, pieces[start] + cost
                    open_run[end] = True
        return pieces[size]

    def text(self, text: str) -> int:
        """Tokens of a whole text; an empty one has none."""
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        if not marked.startswith(MARK):
            marked = MARK + marked
        first, *rest = marked.split(MARK)
        known, count = self._new.get, 0
        for part in rest:
            word = MARK + part
            count += known(word) or self.word(word)
        return count + (self.word(first) if first else 0)


def counter(path: str) -> Counter:
    return kept_table(("unigram", path), lambda: Counter(read_vocabulary(path)))


def count_tokens(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_tokens`` and ``n_chars_counted`` (long).

    Null and empty texts have no tokens.  Columns of these names are replaced,
    all others kept.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    names = ["n_tokens", "n_chars_counted"]
    kept = [c for c in docs.columns if c != text and c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [value or "" for value in part.column(text).to_pylist()]
                tokens = pa.array([count.text(value) for value in texts], pa.int64())
                chars = pa.array(np.array([len(value) for value in texts], dtype=np.int64))
                columns = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, tokens, chars], [*kept, *names])

    schema = docs.select(*kept).schema
    for name in names:
        schema = schema.add(name, LongType())
    return docs.select(*kept, text).mapInArrow(run, schema)


def op3_viterbi_counts(spark, folder: str) -> DataFrame:
    """Count the tokens of every document."""
    return count_tokens(documents(spark, folder).select("doc_id", "text"))
