from __future__ import annotations

import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * i % 9973}" for i in range(40_000))
PROSE = " ".join(f"word{i * 7919 % 4001}" for i in range(120))


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "de", "b", 4),
        (4, "one", None, None, 3),
        (5, LONG, "en", "a", None),
        (6, PROSE, "en", "b", len(PROSE)),
        (7, PROSE, "en", None, len(PROSE)),
        (7, PROSE, "en", None, len(PROSE)),
        (8, "a\u00a0b 日本 🙂 \x1c\x85é", "xx", "c", 12),
        (None, "no id at all", "fr", "c", 12),
    ]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def prose(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


@pytest.fixture(scope="session")
def clashing(edge):
    """Extra columns of names that the operators use themselves."""
    names = ["row", "size", "key", "kept", "score", "spans", "token_ids", "n_words", "rep", "component_id"]
    return edge.select("*", *[F.lit(f"x{i}").alias(name) for i, name in enumerate(names)])


def words_of(text: str | None) -> list[str]:
    """Brute force: runs of characters other than the six of white space."""
    out, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out
