from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintagemill.llm import periodic
from vintagemill.llm.periodic import Extensions, find_runs, op13_periodic_runs, periodic_runs, run_digests

from .conftest import DOCUMENTS, words_of


def brute(words: list) -> list[tuple[int, int, int]]:
    """Runs by every period in turn, compared word by word."""
    found: dict = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                found.setdefault((start, i - start + q), q)
            i += 1 if i == start else 0
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda run: (run[0], run[2]))


def test_agreements_equal_plain_comparison():
    rng = np.random.default_rng(2)
    for size, letters in ((1, 1), (5, 1), (40, 1), (60, 2), (200, 2), (333, 3)):
        word = np.concatenate((rng.integers(0, letters, size), [letters]))
        a, b = rng.integers(0, size, 300), rng.integers(0, size, 300)
        a, b = a[a != b], b[a != b]
        shared = []
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            n = 0
            while max(x, y) + n <= size and word[x + n] == word[y + n]:
                n += 1
            shared.append(n)
        assert Extensions(word).agree(a, b).tolist() == shared


@pytest.mark.parametrize("grid", [7, 1 << 21])
def test_runs_of_many_texts(grid, monkeypatch):
    monkeypatch.setattr(periodic, "GRID_PAIRS", grid)
    rng = random.Random(1)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 5)):
            n, letters = rng.randint(0, 60), rng.choice([1, 2, 3, 8])
            text = [rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < 0.5:
                a = rng.randrange(n)
                p = rng.randint(1, (n - a) // 3 + 1)
                text = [text[a + (i - a) % p] if i >= a else text[i] for i in range(n)]
            texts.append(text)
        first = np.cumsum([0, *map(len, texts)])
        runs = find_runs(np.array([w for t in texts for w in t], dtype=np.int64), first)
        found: list = [[] for _ in texts]
        for row, *run in zip(runs.row, runs.start, runs.length, runs.period, strict=True):
            found[row].append(tuple(int(x) for x in run))
        assert found == [brute(text) for text in texts]


def test_one_word_repeated():
    runs = find_runs(np.zeros(30_000, dtype=np.int64), np.array([0, 30_000]))
    assert (runs.start.tolist(), runs.length.tolist(), runs.period.tolist()) == ([0], [30_000], [1])


def contract(doc_id, text) -> tuple:
    """A row of op13, by brute force."""
    words, n = words_of(text), len(words_of(text))
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = brute(words)
    best = min(runs, key=lambda run: (-run[1] / run[2], run[0], run[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        best and 1000 * best[1] // best[2],
        hashlib.sha256(listing.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


def sorted_rows(rows):
    return sorted(map(tuple, rows), key=repr)


def test_query_equals_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    # The brute force takes the square of a text's words; the query's other texts are checked below.
    short = {row["doc_id"]: contract(*row) for row in docs.select("doc_id", "text").collect() if len(row["text"]) < 6000}
    found = {row["doc_id"]: tuple(row) for row in op13_periodic_runs(spark, sf_small).collect()}
    assert len(found) == docs.count() and len(short) > 150
    assert {k: found[k] for k in short} == short
    assert sum(row[1] > 0 for row in short.values()) > 5


def test_edges(spark, edge, clashing, nothing):
    plain = edge.where("length(text) < 2000 or text is null").select("doc_id", "text")
    expected = sorted_rows(contract(*row) for row in plain.collect())
    assert sorted_rows(run_digests(plain).collect()) == expected
    assert run_digests(clashing).count() == edge.count()
    assert run_digests(nothing).count() == 0 and periodic_runs(nothing).count() == 0


def test_general_operator(spark):
    loop = "a b " * 8 + "c"
    docs = spark.createDataFrame([(1, loop, "en", "s", 9), (2, None, None, None, None)], DOCUMENTS)
    docs = docs.withColumns({"runs": F.lit("old"), "odd name.": F.lit(1)})
    rows = {row["doc_id"]: row for row in periodic_runs(docs, shorter="short").collect()}
    assert [tuple(run) for run in rows[1]["runs"]] == [(0, 16, 2)] and rows[1]["short"] == "a b c"
    assert rows[2]["runs"] == [] and rows[2]["short"] == "" and rows[2]["odd name."] == 1


def test_white_space_is_six_characters(spark):
    text = "x \x1cy\x0b" * 6 + "\x85"
    (row,) = periodic_runs(spark.createDataFrame([(1, text, "", "", 0)], DOCUMENTS)).collect()
    assert [tuple(run) for run in row["runs"]] == [(0, 6, 1)]
