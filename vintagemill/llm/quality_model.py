"""Operator 8: a quality classifier of supervised subword embeddings.

A document is the average of learned vectors of its features: each word, the
character n-grams of the word, and the pair of the word with how far back it
last occurred (loops and repeated lines repeat closely).  Features are hashed
into a fixed number of rows.  A softmax over two classes reads the average.
Trained by numpy stochastic gradient descent on a bounded sample of labelled rows.

The softmax is linear in the average, so after training every feature counts
with one number, its pull towards class 1; a word's pulls are added once and
remembered, and scoring a text is adding up words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .tables import documents, table
from .textbytes import Hashes, Piece, WordTable, Words, mix, per_row, pieces, words

THRESHOLD = 0.3


@dataclass(frozen=True)
class Settings:
    """``most_rows`` bounds the training sample: rows of the smallest hash of doc_id and text."""

    rows: int = 1 << 16
    size: int = 8
    grams: tuple[int, ...] = (3, 4)
    backs: tuple[int, ...] = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 64)
    most_rows: int = 4000
    epochs: int = 8
    rate: float = 0.5
    seed: int = 7


def word_features(found: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Rows of words and of their character n-grams with marked ends, and where each word's begin."""
    points = np.frombuffer(f"<{'><'.join(found)}>".encode("utf-32-le"), dtype=np.uint32)
    lengths = np.array([len(word) + 2 for word in found])
    starts = np.cumsum(lengths) - lengths
    hashed = Hashes(points)
    counts = np.stack([np.ones_like(lengths), *(np.maximum(lengths - n + 1, 0) for n in settings.grams)])
    begin = np.concatenate(([0], np.cumsum(counts.sum(0))))
    rows = np.empty(begin[-1], dtype=np.int64)
    base = begin[:-1]
    rows[base] = hashed.ranges(starts, starts + lengths) % np.uint64(settings.rows)
    base = base + 1
    for n, made in zip(settings.grams, counts[1:], strict=True):
        step = np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made)
        at = np.repeat(starts, made) + step
        rows[np.repeat(base, made) + step] = hashed.ranges(at, at + n) % np.uint64(settings.rows)
        base = base + made
    return rows, begin


def back_features(hashes: np.ndarray, found: Words, settings: Settings) -> np.ndarray:
    """Per word, the row of its distance class to the last same word of its text."""
    n = len(hashes)
    key = mix(hashes ^ mix(found.row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    distance = np.full(n, 1 << 40, dtype=np.int64)
    distance[order[1:][same]] = (order[1:] - order[:-1])[same]
    step = np.searchsorted(np.array(settings.backs), distance)
    return mix(step + np.uint64(1 << 40)).astype(np.uint64) % np.uint64(settings.rows)


@dataclass(frozen=True)
class Model:
    """``pulls``: what each feature row adds towards class 1; ``bias``: where an empty text stands."""

    pulls: np.ndarray
    bias: float
    settings: Settings

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Scores pieces of texts; remembers the pull of words seen before."""

    def __init__(self, model: Model):
        self._model, settings = model, model.settings

        def compute(found: list[str]) -> list[tuple[float, int]]:
            rows, begin = word_features(found, settings)
            pulls = per_row(model.pulls[rows], begin)
            return list(zip(pulls.tolist(), np.diff(begin).tolist(), strict=True))

        self._words = WordTable(compute, bound=400_000)

    def scores(self, piece: Piece) -> np.ndarray:
        found = words(piece)
        hashes = Hashes(piece.data).ranges(found.starts, found.ends)
        if not len(hashes):
            return np.full(len(piece), 1 / (1 + np.exp(-self._model.bias)))
        known, which = self._words.values(piece, found, hashes)
        pull, count = np.array(known).T
        backs = back_features(hashes, found, self._model.settings)
        total = per_row(pull[which] + self._model.pulls[backs], found.first)
        n = per_row(count[which] + 1, found.first)
        return 1 / (1 + np.exp(-(self._model.bias + total / np.maximum(n, 1))))


def _bag(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The distinct feature rows of a whole text and their shares."""
    batch = pa.RecordBatch.from_arrays([pa.array([text], pa.string())], ["text"])
    rows: list[np.ndarray] = []
    for piece in pieces([batch]):
        found = words(piece)
        hashes = Hashes(piece.data).ranges(found.starts, found.ends)
        if len(hashes):
            rows.append(back_features(hashes, found, settings))
            spans = zip(found.starts.tolist(), found.ends.tolist(), strict=True)
            own = [piece.data[a:b].tobytes().decode() for a, b in spans]
            rows.append(word_features(own, settings)[0])
    if not rows:
        return np.empty(0, dtype=np.int64), np.empty(0)
    flat = np.concatenate([x.astype(np.int64) for x in rows])
    distinct, counts = np.unique(flat, return_counts=True)
    return distinct, counts / counts.sum()


def train(texts: list[str], labels: list[int], settings: Settings | None = None) -> Model:
    """Fit embeddings and softmax by stochastic gradient descent, one text a step.

    Steps are scaled per row by the gradients that it has had (Adagrad), since a
    rare feature sees few of them.  Without two classes the model is their share.
    """
    settings = settings or Settings()
    rng = np.random.default_rng(settings.seed)
    share = (sum(labels) + 1) / (len(labels) + 2)
    bias = np.array([0.0, np.log(share / (1 - share))])
    vectors = rng.normal(0, 1 / settings.size, (settings.rows, settings.size))
    weights = np.zeros((2, settings.size))
    if len(set(labels)) == 2:
        bags = [_bag(text, settings) for text in texts]
        seen_v, seen_w, seen_b = np.full(settings.rows, 1e-6), np.full((2, 1), 1e-2), np.full(2, 1e-1)
        weights = rng.normal(0, 1 / settings.size, (2, settings.size))
        for epoch in range(settings.epochs):
            rate = settings.rate * (1 - epoch / settings.epochs)
            for i in rng.permutation(len(bags)):
                rows, parts = bags[i]
                hidden = parts @ vectors[rows] if len(rows) else np.zeros(settings.size)
                logits = weights @ hidden + bias
                chance = np.exp(logits - logits.max())
                error = chance / chance.sum()
                error[labels[i]] -= 1
                back = error @ weights
                step = np.outer(error, hidden)
                seen_w += (step**2).mean(1, keepdims=True)
                weights -= rate * 0.2 * step / np.sqrt(seen_w)
                seen_b += error**2
                bias -= rate * 0.2 * error / np.sqrt(seen_b)
                if len(rows):
                    seen_v[rows] += (parts**2) * (back @ back) / settings.size
                    vectors[rows] -= (rate * parts / np.sqrt(seen_v[rows]))[:, None] * back
    pulls = vectors @ (weights[1] - weights[0])
    return Model(pulls.astype(np.float64), float(bias[1] - bias[0]), settings)


def held_out(doc_id):
    """Rows kept out of training: a fifth, by the checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[list[str], list[int]]:
    """A bounded sample of labelled rows to learn from; held-out rows never enter it."""
    chosen = (
        labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")
        .limit(settings.most_rows)
    )
    # At most ``most_rows`` ids, so they may be broadcast; texts are fetched once they are known.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "quality", F.coalesce("text", F.lit("")).alias("text"))
        .collect()
    )
    rows.sort(key=lambda row: (row.doc_id, row.text))
    return [row.text for row in rows], [row.quality for row in rows]


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without its text, and with ``score`` (0 to 1) in place of a column of that name.

    A null or empty text has the score of the bias alone.
    """
    kept = [c for c in docs.columns if c not in (text, "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for piece in pieces(batches, text):
            columns = [piece.rows.column(c) for c in kept]
            scores = pa.array(scorer.scores(piece))
            yield pa.RecordBatch.from_arrays([*columns, scores], [*kept, "score"])

    schema = docs.select(*kept).schema.add("score", DoubleType())
    return docs.select(*kept, text).mapInArrow(run, schema)


def op8_subword_quality(spark, folder: str) -> DataFrame:
    """Score every document with a model learned from labelled rows that are not held out."""
    docs, settings = documents(spark, folder), Settings()
    model = train(*sample(docs, table(spark, folder, "labels"), settings), settings)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
