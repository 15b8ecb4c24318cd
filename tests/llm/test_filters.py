"""Quality rules, quality model, personal data and URL filter against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vintagemill.llm import pii, pii_model, quality_model, quality_rules, url_filter

from .conftest import words_of


def plain_counts(text: str | None) -> tuple[int, ...]:
    words, text = words_of(text), text or ""
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        repeated += bool(words_of(line)) and line in seen
        seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, repeated, len(covered)


def test_base_counts(spark, edge, prose):
    extra = [(90, "a b a b a b c\na b\na b\n\n\n|<>\n#x\n#x"), (91, "x " * 70), (92, "same\n" * 60)]
    made = spark.createDataFrame(extra, "doc_id long, text string").withColumn("lang", F.lit("en"))
    for docs in (edge, prose, made):
        rows = quality_rules.measure(docs, keep_text=True).collect()
        for row in rows:
            assert tuple(row[c] for c in quality_rules.BASE_COUNTS) == plain_counts(row.text)


def test_rates_by_the_public_model():
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path(quality_rules.VOCABULARY)
    )
    texts = ["the cat sat on the mat", "日本 🙂 🙂", ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    (piece,) = quality_rules.pieces([batch])
    found = quality_rules.words(piece)
    hashes = quality_rules.Hashes(piece.data).ranges(found.starts, found.ends)
    chars = quality_rules.base_counts(piece, quality_rules.Hashes(piece.data), found, hashes)[1]
    rates = quality_rules.fertility(piece, found, hashes, chars, public_tokenizers.path(quality_rules.VOCABULARY))
    for i, text in enumerate(texts):
        ids = [x for word in words_of(text) for x in model.encode(word)]
        assert rates[0][i] == pytest.approx(sum(map(len, words_of(text))) / max(1, len(ids)))
        assert rates[1][i] == pytest.approx(sum(map(model.is_byte, ids)) / max(1, len(ids)))


def test_verdict_keeps_prose_and_drops_junk(spark, sf_check):
    docs = spark.read.parquet(f"{sf_check}/documents.parquet")
    labels = spark.read.parquet(f"{sf_check}/labels.parquet")
    judged = quality_rules.judge(quality_rules.measure(docs)).join(labels, "doc_id").collect()
    good = [row for row in judged if row.quality == 1 and not row.base_failed]
    bad = [row for row in judged if row.quality == 0]
    assert sum(row.kept for row in good) >= 0.995 * len(good)
    assert sum(row.kept for row in bad) <= 0.3 * len(bad)
    assert not any(row.kept for row in judged if row.base_failed)


def test_quality_edges(edge, clashing, nothing):
    kept = quality_rules.keep_good(clashing)
    assert kept.columns == clashing.columns
    assert {row.doc_id for row in kept.collect()} <= {5, 6, 7}
    assert quality_rules.keep_good(nothing).count() == 0
    assert quality_rules.judge(quality_rules.measure(edge)).where("kept is null").count() == 0


def test_quality_model_on_held_out_rows(spark, sf_check):
    docs = spark.read.parquet(f"{sf_check}/documents.parquet")
    labels = spark.read.parquet(f"{sf_check}/labels.parquet")
    scored = quality_model.op8_subword_quality(spark, sf_check).join(labels, "doc_id").collect()
    held = [row for row in scored if row.held_out]
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in scored)
    pairs = [(a.score, b.score) for a in held for b in held if a.quality > b.quality]
    assert sum(x > y for x, y in pairs) >= 0.95 * len(pairs)
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in scored)
    texts, _ = quality_model.sample(docs, labels, quality_model.Settings(most_rows=20))
    assert len(texts) <= 20


def test_quality_model_edges(edge, clashing, nothing):
    model = quality_model.train(["good text here", "bad bad bad", ""], [1, 0, 0])
    rows = {row.doc_id: row.score for row in quality_model.score(edge, model).collect()}
    assert rows[1] == rows[2] == rows[3]
    assert all(0 <= score <= 1 for score in rows.values())
    assert quality_model.score(clashing, model).columns.count("score") == 1
    assert quality_model.score(nothing, model).count() == 0
    alone = quality_model.train([], [])
    assert quality_model.score(edge, alone).where("score <> 0.5").count() == 0
    one_class = quality_model.train(["a", "b"], [1, 1])
    assert one_class.bias > 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            fits = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(part) <= 255 for part in m[0].split(".")),
                "card": lambda d=digits, t=twice: 16 <= len(d) <= 19 and sum(x // 10 + x % 10 for x in t) % 10 == 0,
                "phone": lambda d=digits: 8 <= len(d) <= 15,
            }[kind]
            if fits():
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_plain_patterns(prose):
    draw = random.Random(1)
    texts = [row.text for row in prose.collect()]
    for letters, n in (("a1_.@-+ ()%2é0", 30), ("12.", 40), ("0123456789 -+(", 60)):
        texts += ["".join(draw.choice(letters) for _ in range(draw.randint(0, n))) for _ in range(4000)]
    for text in texts:
        assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_of_long_runs_are_linear():
    assert pii.base_spans("1" * 300_000 + "a" * 300_000 + "@" + "." * 100_000) == []


def test_crf_gradient_matches_differences():
    import numpy as np

    network = pii_model.Network(pii_model.Settings(window=5, embedding=3, hidden=3))
    rng = np.random.default_rng(0)
    windows, tags = rng.integers(0, 90, (3, 5)), np.array([[0, 1, 2, 2, 0], [0] * 5, [3, 4, 0, 1, 2]])
    _, grads = network._loss_gradient(windows, tags)
    for name in ("fore", "back", "out", "moves", "embed"):
        value = network.weights[name]
        for _ in range(3):
            at = tuple(rng.integers(0, n) for n in value.shape)
            if name == "embed":
                at = (windows[0, 0], at[1])
            kept, ends = value[at], []
            for step in (1e-5, -1e-5):
                value[at] = kept + step
                ends.append(network._loss_gradient(windows, tags)[0])
            value[at] = kept
            assert grads[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-5)


def test_network_finds_other_notations(spark):
    draw, texts = random.Random(2), []
    for i in range(160):
        a, b, c = draw.randint(200, 999), draw.randint(200, 999), draw.randint(1000, 9999)
        data = [f"+1 ({a}) {b}-{c}", f"me{a}.x@mail{b % 9}.example.com", f"10.{a % 256}.{b % 256}.7"][i % 3]
        texts.append((i, f"some words before {data} and some more words {c} after, year 2024"))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    network = pii.learned(docs)
    finder = pii.Finder(network)
    text = "call (487) 555-7209 now, some words and some more"
    (spans,) = finder.spans([text])
    assert [(kind, text[a:b], base) for kind, a, b, base in spans] == [("phone", "(487) 555-7209", False)]
    (clean,) = finder.spans(["in 2024 there were 1200 words and 3 more, 15.5 percent"])
    assert clean == []


def test_pii_edges(spark, edge, clashing, nothing):
    found = pii.digest(pii.find(edge, None)).collect()
    assert len(found) == edge.count()
    assert all(row.spans == "" for row in found)
    docs = spark.createDataFrame(
        [(1, "é a@b.co x 1.2.3.4", 9), (2, None, None)], "doc_id long, text string, n_chars long"
    )
    row, null = pii.digest(pii.find(docs, None)).orderBy("doc_id").collect()
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 0, 0)
    assert row.spans == "email:2:8,ip:11:18"
    assert (null.n_email, null.spans) == (0, "")
    masked = pii.redact(docs, None).orderBy("doc_id").collect()
    assert [tuple(r) for r in masked] == [(1, "é <EMAIL> x <IP>", 16), (2, None, None)]
    assert pii.redact(clashing, None).columns == clashing.columns
    assert pii.redact(nothing, None).count() == 0
    assert pii.learned(nothing) is None


def plain_rule(url: str | None) -> tuple:
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), h + p, verdict)
        for verdict, h, p in url_filter.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *max(fits)[1:]) if fits else (host, path, None, None)


URLS = [
    None, "", "no scheme", "://", "http://", "https://A.Example.ORG/en/12?x=1#y", "http://org/", "http://xorg/",
    "http://a.com/fr/?q://z", "http://a.com?x/de/", "http://É.com/de/\n2", "a://b.example.org/es/",
    "http://net/a.html", "http://" + "a" * 5000 + ".net/" + "b/" * 5000, "http://a.com#frag",
]


def test_urls_against_plain_rules(spark, sf_check):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    pages = pages.unionByName(spark.read.parquet(f"{sf_check}/pages.parquet").select("page_id", "url"))
    rows = url_filter.judge(pages.withColumn("rule", F.lit(1))).collect()
    assert len(rows) == pages.count()
    for row in rows:
        host, path, rule, verdict = plain_rule(row.url)
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict in ("allow", "block")
        assert verdict is None or row.verdict == verdict


def test_urls_without_labels(spark):
    pages = spark.createDataFrame(list(enumerate(URLS[:4])), "page_id long, url string")
    assert {row.verdict for row in url_filter.judge(pages).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_trees_learn_from_labelled_urls(spark):
    rows = [(i, f"http://s{i}.com/de/{i}") for i in range(60)]
    rows += [(100 + i, f"http://s{i}.org/a/b/c/d?x=1&y=2&z=3") for i in range(60)]
    rows += [(300, "http://q.net/de/77"), (301, "http://q.net/a/b/c/d?x=1&y=2&z=3")]
    judged = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"))
    by_id = {row.page_id: row for row in judged.collect()}
    assert by_id[300].verdict == "block"
    assert by_id[301].verdict == "allow"
    assert by_id[300].rule is None
