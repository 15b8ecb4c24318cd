"""A training-data pipeline of five stages, each one operator over all that the stage before kept.

A stage takes (spark, docs, folder) and returns a DataFrame, which is written and
read again as the next one's documents.  All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagemill.llm import bpe, hyperminhash, mixing, pii, quality_rules
from vintagemill.llm.tables import documents, written


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the rules and lie in the bands of their language."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return hyperminhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data in texts replaced by the name of its kind."""
    return pii.redact(docs, pii.learned(docs))


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """A row per copy that the mix takes, in training order."""
    return mixing.mix(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every copy, and the digest of the bytes that they decode to.

    Workers have served other stages before, so they remember fewer pieces here.
    """
    return bpe.round_trip(docs, remembered=120_000).select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_dedup),
    ("PII", mask_personal_data),
    ("mixing to target weights", mix),
    ("byte-level BPE", tokens),
]

# Token rates, sketches, a learned network and BPE are beyond SQL: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents table."""
    docs = documents(spark, folder)
    *first, (_, last) = STAGES
    for number, (_, stage) in enumerate(first):
        docs = written(stage(spark, docs, folder), f"stage{number}")
    return last(spark, docs, folder)
