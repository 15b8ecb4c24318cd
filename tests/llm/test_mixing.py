"""Mixing against a plain version, and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vintagemill.llm import mixing, pii, queries

from .conftest import DOCUMENTS, words_of


def plain_targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Resharing the excess by weight until none is above."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weight = {name: i % 3 + 1 for i, name in enumerate(names)}
    left, free, target = float(sum(sizes.values())), list(names), {}
    while free:
        level = left / sum(weight[n] for n in free)
        over = [n for n in free if level * weight[n] > 3 * sizes[n]]
        if not over:
            target |= {n: level * weight[n] for n in free}
            break
        for n in over:
            target[n] = 3.0 * sizes[n]
            left -= target[n]
            free.remove(n)
    return target


def mixture(seed: int) -> list[tuple]:
    draw, rows = random.Random(seed), []
    names = [None, "", "é", "z", "Z", "aÿ", "src1", "🙂"]
    for i in range(400):
        name = draw.choices(names, [5, 1, 30, 2, 1, 4, 200, 3])[0]
        text = " ".join("w" * draw.randint(1, 5) for _ in range(draw.choice([0, 1, 5, 40, 300])))
        rows.append((i, draw.choice([text, text, text, None]), "en", name, len(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_words_taken(spark, seed):
    rows = mixture(seed)
    got = {r.doc_id: r for r in mixing.digest(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    again = {r.doc_id: r for r in mixing.digest(spark.createDataFrame(rows[::-1], DOCUMENTS).repartition(5)).collect()}
    assert got == again
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, text, _, source, _ in rows:
        size = len(words_of(text))
        assert got[i].size == size
        assert got[i].taken % max(size, 1) == 0
        assert got[i].taken <= 3 * size
        assert (got[i].position is None) == (got[i].taken == 0)
        sizes[source] += size
        taken[source] += got[i].taken
        largest[source] = max(largest[source], size)
    for source, target in plain_targets(sizes).items():
        row = next(got[i] for i, *_, name, _ in rows if name == source)
        assert row.source_size == sizes[source]
        assert row.target == pytest.approx(target)
        assert abs(taken[source] - target) <= largest[source] / 2 + 1


def test_due_time_inverts_the_schedules(spark):
    for place, knots in enumerate(mixing.SCHEDULES):
        demand = [i / 20 for i in range(21)]
        frame = spark.createDataFrame([(d,) for d in demand], "d double")
        from pyspark.sql import functions as F

        times = [r[0] for r in frame.select(mixing.due_time(F.col("d"), F.lit(place))).collect()]
        assert times == sorted(times)

        def area(t, knots=knots):
            total = 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
                end = min(max(t, t0), t1)
                w = w0 + (w1 - w0) * (end - t0) / (t1 - t0)
                total += (w0 + w) / 2 * (end - t0)
            return total

        for d, t in zip(demand, times, strict=True):
            assert area(t) / area(1.0) == pytest.approx(d, abs=1e-9)


def test_mix_rows(spark, edge, clashing, nothing):
    rows = spark.createDataFrame(mixture(4), DOCUMENTS)
    mixed = mixing.mix(rows).collect()
    taken = {r.doc_id: r.taken // max(1, r.size) for r in mixing.digest(rows).collect()}
    counts = defaultdict(int)
    for row in mixed:
        counts[row.doc_id] += 1
    assert all(counts[i] == n for i, n in taken.items())
    assert [r.position for r in mixed] == sorted(r.position for r in mixed)
    assert {c for c in mixing.mix(clashing).columns} == {*clashing.columns, "epoch", "position"}
    assert mixing.mix(nothing).count() == 0
    assert mixing.digest(nothing).count() == 0
    assert mixing.digest(edge).count() == edge.count()
    empty = edge.where("doc_id in (1, 2, 3)")
    assert [(r.target, r.taken) for r in mixing.digest(empty).collect()] == [(0.0, 0)] * 3


@pytest.mark.parametrize(("ids", "words", "texts"), [(1, 10, 1), (None, 10, 1), (1, 10, 7), (None, 3, 300)])
def test_rows_of_one_id(spark, ids, words, texts):
    """Rows equal in id and size are taken one by one, up to the target."""
    rows = [(ids, " ".join(f"w{i % texts}x{k}" for k in range(words)), "en", "a", 0) for i in range(300)]
    rows += [(i + 2, "v " * words, "en", "b", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    planned = mixing.digest(docs).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    for row in planned:
        assert abs(row.taken - row.target) <= words / 2
    runs = [
        sorted((r.text, r.source, r.epoch, r.position) for r in mixing.mix(docs.repartition(n)).collect()) for n in (3, 4)
    ]
    assert runs[0] == runs[1]
    assert len(runs[0]) == sum(r.taken for r in planned) / words


def test_rows_of_one_id_against_sql(spark, sf_small):
    """The SQL twin over a table in which ids repeat or are missing."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, 7).when(F.col("doc_id") % 3 == 1, F.col("doc_id")))
    docs = docs.withColumn("text", F.when(F.col("doc_id") == 7, F.substring("text", 1, 40)).otherwise(F.col("text")))
    con = duckdb.connect()
    given = docs.toPandas()  # noqa: F841 - the table that the SQL reads
    con.sql("CREATE TABLE documents AS SELECT * REPLACE (CAST(doc_id AS BIGINT) AS doc_id) FROM given")
    expected = con.sql(mixing.OP7_SQL)
    columns = sorted(expected.columns)
    index = [expected.columns.index(c) for c in columns]
    found = mixing.digest(docs)
    assert sorted(tuple(str(r[c]) for c in columns) for r in found.collect()) == sorted(
        tuple(str(row[i]) for i in index) for row in expected.fetchall()
    )


def test_bad_schedules():
    for knots in (((0.0, 1.0), (0.5, 1.0)), ((0.0, 0.0), (1.0, 0.0)), ((0.0, -1.0), (1.0, 5.0))):
        with pytest.raises(ValueError, match="schedule"):
            mixing._cumulative(knots)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_against_sql(spark, sf_check, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_check}/{table}.parquet'")
    expected = con.sql(queries.ORACLE_SQL[name])
    columns = sorted(expected.columns)
    got = queries.QUERIES[name](spark, sf_check)
    assert sorted(got.columns) == columns
    rows = sorted(tuple(str(row[c]) for c in columns) for row in got.collect())
    index = [expected.columns.index(c) for c in columns]
    assert rows == sorted(tuple(str(row[i]) for i in index) for row in expected.fetchall())


def test_pipeline_stages(spark, sf_small, prose):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "MinHash near-dedup", "PII", "mixing to target weights", "byte-level BPE",
    ]
    from vintagemill.llm import bpe, hyperminhash, quality_rules

    stages = dict(corpus_pipeline.STAGES)
    docs = prose
    judged = quality_rules.judge(quality_rules.measure(docs)).where("kept")
    good = stages["quality rules"](spark, docs, sf_small)
    assert good.columns == docs.columns
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in judged.collect())
    one = stages["MinHash near-dedup"](spark, good, sf_small)
    kept = hyperminhash.near_duplicates(good).where("kept")
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in one.collect()) == sorted(r.doc_id for r in kept.collect())
    masked = stages["PII"](spark, one, sf_small)
    before = {r.doc_id: r for r in one.collect()}
    for row in masked.collect():
        assert not pii.base_spans(row.text)
        assert row.n_chars == len(row.text)
        if not pii.base_spans(before[row.doc_id].text):
            assert row.text == before[row.doc_id].text
    mixed = stages["mixing to target weights"](spark, masked, sf_small)
    assert mixed.columns == docs.columns
    last = stages["byte-level BPE"](spark, mixed, sf_small)
    texts = defaultdict(list)
    for row in mixed.collect():
        texts[row.doc_id].append(hashlib.sha256(row.text.encode()).hexdigest())
    for row in last.collect():
        assert row.decoded_sha256 in texts[row.doc_id]
        assert row.n_tokens == len(row.token_ids)
    whole = corpus_pipeline.run(spark, sf_small)
    assert whole.count() == mixed.count()
    assert bpe.encode(mixed).count() == mixed.count()


def test_pipeline_on_edges(spark, edge, nothing, tmp_path):
    for docs in (nothing, edge):
        folder = str(tmp_path / str(docs.count()))
        docs.write.parquet(f"{folder}/documents.parquet")
        frame = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, folder)
        assert frame.count() <= docs.count() * 3


def test_digest_is_of_the_training_order(spark, monkeypatch):
    """Words taken and positions are those of the copies in the mix, not of the plan."""
    docs = spark.createDataFrame(
        [(i, "a " * (i % 7), "xyz"[i % 3]) for i in range(60)] + [(None, "b b", None), (None, "b b", None)],
        "doc_id long, text string, source string",
    )
    whole = {tuple(r) for r in mixing.digest(docs).select("doc_id", "size", "taken", "position").collect()}
    assert len(mixing.digest(docs).collect()) == 62 and any(taken > size for _, size, taken, _ in whole)
    order = mixing.training_order
    monkeypatch.setattr(mixing, "training_order", lambda planned: order(planned).where("epoch = 0"))
    once = mixing.digest(docs).collect()
    assert len(once) == 62 and all(r.taken in (0, r.size) for r in once)
