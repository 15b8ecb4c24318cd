from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from vintagemill.llm import versions
from vintagemill.llm.versions import CHECK, KEYS, PARAGRAPH, PARTS, PER_COPY, WIDTH, compare_versions, fingerprints

from .conftest import DOCUMENTS


def plain_keys(text: str | None) -> list[int]:
    counts: dict = {}
    for p in re.findall(PARAGRAPH, text or ""):
        digest = int(hashlib.md5(p.encode()).hexdigest()[:15], 16)
        counts[digest] = counts.get(digest, 0) + 1
    return [(digest + PER_COPY * (n - 1)) % KEYS for digest, n in counts.items()]


def plain_fingerprint(text: str | None) -> str:
    cells: dict = {}
    for key in plain_keys(text):
        for part in range(PARTS):
            cell = (key >> 20 * part) % (1 << 20) % WIDTH + part * WIDTH
            n, keys, checks = cells.get(cell, (0, 0, 0))
            cells[cell] = n + 1, keys ^ key, checks ^ key % CHECK
    return ",".join(f"{c}:{n}:{k:x}:{x:x}" for c, (n, k, x) in sorted(cells.items()))


def plain_likeness(a: str | None, b: str | None) -> float:
    a, b = set(plain_keys(a)), set(plain_keys(b))
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(docs: list[tuple]) -> list[tuple]:
    rows = sorted(
        ((i, t or "") for i, t in docs),
        key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()),
    )
    out = []
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append(
            (
                doc_id,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                plain_fingerprint(text),
                plain_fingerprint(edited),
                plain_likeness(text, edited),
                plain_likeness(text, after),
            )
        )
    return sorted(out, key=repr)


def found(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)


def text_of(rng: random.Random, lines: int) -> str:
    return "\n".join(f"line {rng.randrange(lines * 3 + 1)} é🙂" + " and more" * rng.randrange(60) for _ in range(lines))


def test_equals_brute_force(spark):
    rng = random.Random(4)
    docs = [(rng.randrange(60), text_of(rng, rng.choice([0, 1, 2, 5, 20, 80]))) for _ in range(120)]
    docs += [(7, "same\ntext"), (7, "same\ntext"), (7, "same\ntext"), (None, None), (None, ""), (None, "x"), (61, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCUMENTS).repartition(4)
    assert found(fingerprints(df)) == brute(docs)


def test_edges(spark, edge, clashing, nothing):
    docs = [(row["doc_id"], row["text"]) for row in edge.collect()]
    assert found(fingerprints(edge)) == brute(docs)
    assert found(fingerprints(clashing)) == brute(docs)
    assert fingerprints(nothing).count() == 0
    (one,) = fingerprints(edge.where("doc_id = 6")).collect()
    assert one["near_next"] == 1.0


def test_many_copies_stay_rows(spark, monkeypatch):
    monkeypatch.setattr(versions, "COPIES", 4)
    docs = [(1, "a\nb")] * 23 + [(2, "a\nc")]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in docs], DOCUMENTS)
    assert found(fingerprints(df)) == brute(docs)


@pytest.mark.parametrize("changed", [0, 1, 3, 10, 60, 400])
def test_differing_keys_are_recovered(spark, changed):
    old = [f"line {i}." for i in range(500)]
    new = [f"new {i}." if i < changed else line for i, line in enumerate(old)]
    rows = [("\n".join(old), "\n".join(new), "kept"), ("\n".join(new), None, "kept")]
    df = spark.createDataFrame(rows, "old string, new string, changes string").withColumn("a", F.lit(1))
    first, second = [
        row["changes"]
        for row in compare_versions(df, "old", "new").orderBy(F.col("new").isNull()).collect()
    ]
    a, b = set(plain_keys(rows[0][0])), set(plain_keys(rows[0][1]))
    assert (set(first["only_old"]), set(first["only_new"])) == (a - b, b - a)
    assert len(first["only_old"]) == len(first["only_new"]) == changed
    assert first["likeness"] == (500 - changed) / (500 + changed)
    assert set(second["only_old"]) == b and second["only_new"] == [] and second["likeness"] == 0.0


def test_peeling_alone_decides(spark):
    """No pair of this table is left to the plain comparison."""
    rng = random.Random(9)
    rows = [(text_of(rng, 30), text_of(rng, 30)) for _ in range(300)]
    df = spark.createDataFrame(rows, "old string, new string")
    keys = df.select(*[versions.paragraph_keys(F.col(c)).alias(n) for c, n in (("old", "a"), ("new", "b"))])
    left = keys.select(F.size(versions._larger(F.col("a"), F.col("b"))["cells"]).alias("left"))
    assert left.where("left > 0").count() == 0
