"""Operator 5: judge page URLs by rules, and by boosted trees where no rule fits.

Rules name a host, which covers its subdomains, and a path prefix; the longest
fitting rule wins.  The URLs that a rule decides are the labelled ones: gradient
boosted trees learn from lexical features of these (length, depth, digit ratio,
entropy, parameters, statistics of host suffix and file ending) and judge the rest.
Everything is SQL functions and Spark's own distributed tree learner.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import table

ALLOW, BLOCK = "allow", "block"
# (verdict, host, path)
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(
        F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """A struct (rule, verdict) of the longest rule that fits, or null.

    A rule's length is that of its host and path together; of equal ones the
    earlier wins.  The rules are a fixed, short list, so they are one expression.
    """
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        best = F.when(fits, found).otherwise(best)
    return best


@dataclass(frozen=True)
class Settings:
    trees: int = 12
    depth: int = 3
    bins: int = 32
    step: float = 0.3
    threshold: float = 0.5
    seed: int = 11


def _entropy(text: Column) -> Column:
    """Bits per character of a string; an empty one has none."""
    n = F.length(text)
    counts = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: n - F.length(F.replace(text, c, F.lit(""))),
    )
    bits = F.aggregate(counts, F.lit(0.0), lambda a, c: a + F.when(c > 0, c * F.log2(c)).otherwise(0.0))
    return F.when(n > 0, F.log2(n) - bits / n).otherwise(0.0)


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of the string alone, and the two suffixes whose statistics are learned."""
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    digits = F.regexp_count(url, F.lit("[0-9]"))
    return {
        "url_length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.size(segments),
        "host_labels": F.size(F.split(host, r"\.")),
        "digit_ratio": digits / F.greatest(F.length(url), F.lit(1)),
        "host_digits": F.regexp_count(host, F.lit("[0-9]")),
        "url_entropy": _entropy(url),
        "host_entropy": _entropy(host),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda p: p != "")),
        "hyphens": F.regexp_count(url, F.lit("-")),
        "fragment": F.contains(url, F.lit("#")),
        "secure": F.startswith(url, F.lit("https://")),
    }


def suffixes(host: Column, path: Column) -> dict[str, Column]:
    return {
        "host_suffix": F.element_at(F.split(host, r"\."), -1),
        "file_suffix": F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1),
    }


def _with_suffix_rates(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Share of blocked URLs per suffix among the labelled ones, drawn to the share of all.

    A suffix without labelled URLs has the share of all.  Statistics cover every
    labelled row; Spark decides how to join them, by their size.
    """
    overall = labelled.agg(F.coalesce(F.avg("label"), F.lit(0.5)).alias("all_rate"))
    rows = rows.join(F.broadcast(overall))  # one row
    for name in ("host_suffix", "file_suffix"):
        rates = labelled.groupBy(name).agg(F.sum("label").alias("_bad"), F.count("label").alias("_n"))
        rows = (
            rows.join(rates, name, "left")
            .withColumn(
                name + "_rate",
                (F.coalesce("_bad", F.lit(0.0)) + 10 * F.col("all_rate"))
                / (F.coalesce("_n", F.lit(0)) + 10),
            )
            .drop("_bad", "_n")
        )
    return rows.drop("all_rate")


def judge(pages: DataFrame, rules=RULES, settings: Settings | None = None) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``block_score``.

    Columns of these names are replaced, all others kept.  ``rule`` is null where
    none fits; there the trees' score decides, or, without labelled URLs of both
    verdicts, the more frequent verdict (allow if there is none).
    """
    settings = settings or Settings()
    made = ("host", "path", "rule", "verdict", "block_score")
    row = F.struct(*[F.col(c) for c in pages.columns if c not in made]).alias("row")
    host, path = url_parts(F.col("url"))
    split = pages.select(row, F.col("url").alias("url"), host.alias("host"), path.alias("path"))
    rule = matched_rule(F.col("host"), F.col("path"), rules)
    features = lexical_features(F.col("url"), F.col("host"), F.col("path"))
    names = [*features, "host_suffix_rate", "file_suffix_rate"]
    known = split.withColumn("found", rule).select(
        "row",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.col("found.verdict").alias("by_rule"),
        F.when(F.col("found.verdict") == BLOCK, 1.0)
        .when(F.col("found.verdict") == ALLOW, 0.0)
        .alias("label"),
        *[value.cast("double").alias(name) for name, value in features.items()],
        *[value.alias(name) for name, value in suffixes(F.col("host"), F.col("path")).items()],
    )
    labelled = known.where(F.col("label").isNotNull()).drop("row")
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    learn = assembler.transform(_with_suffix_rates(labelled, labelled)).select("features", "label")
    share = labelled.agg(F.min("label"), F.max("label"), F.avg("label")).first()
    rated = assembler.transform(_with_suffix_rates(known, labelled))
    if share[0] is not None and share[0] != share[1]:
        trees = GBTRegressor(
            maxIter=settings.trees,
            maxDepth=settings.depth,
            maxBins=settings.bins,
            stepSize=settings.step,
            seed=settings.seed,
            predictionCol="block_score",
        )
        scored = trees.fit(learn).transform(rated)
    else:
        scored = rated.withColumn("block_score", F.lit(float(share[2] or 0.0)))
    by_trees = F.when(F.col("block_score") >= settings.threshold, BLOCK).otherwise(ALLOW)
    return scored.select(
        "row.*", "host", "path", "rule", F.coalesce("by_rule", by_trees).alias("verdict"), "block_score"
    )


def op5_url_trees(spark, folder: str) -> DataFrame:
    """Judge every page URL."""
    judged = judge(table(spark, folder, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_score")
