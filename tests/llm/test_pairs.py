"""Near-duplicate documents, vectors and passages against brute force over all pairs."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintagemill.llm import cosine, hyperminhash, passages
from vintagemill.llm.graph import by_piece, components, in_blocks

from .conftest import words_of


def reachable(ids, links) -> dict[int, int]:
    """The smallest id that each can reach."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("shape", ["path", "star", "random", "empty"])
def test_components(spark, shape):
    draw = random.Random(3)
    links = {
        "path": [(i, i + 1) for i in range(0, 60)],
        "star": [(7, i) for i in range(100, 160)] + [(3, 100)],
        "random": [(draw.randrange(200), draw.randrange(200)) for _ in range(120)],
        "empty": [],
    }[shape]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = reachable({x for a, b in links if a != b for x in (a, b)}, links)
    assert {row.id: row.component_id for row in got} == expected
    assert len(got) == len(expected)


def test_blocks_bring_every_pair_together_once(spark):
    rows = spark.createDataFrame([(k, i) for k in (1, 2) for i in range(70 * k)], "k int, m long")

    def pairs(batches):
        import pyarrow as pa

        def of(piece):
            side, m = piece["side"].to_pylist(), piece["m"].to_pylist()
            inner = piece["left_part"][0].as_py() == piece["right_part"][0].as_py()
            left = [x for x, s in zip(m, side, strict=True) if s == 0]
            right = left if inner else [x for x, s in zip(m, side, strict=True) if s == 1]
            found = [(a, b) for i, a in enumerate(left) for b in (right[i + 1 :] if inner else right)]
            assert len(m) < 70
            columns = zip(*found, strict=True) if found else ([], [])
            arrays = [pa.array(list(c), pa.int64()) for c in columns]
            return pa.RecordBatch.from_arrays([pa.array([piece["k"][0].as_py()] * len(found), pa.int32()), *arrays], ["k", "a", "b"])

        yield from by_piece(batches, ["k"], of)

    dealt = in_blocks(rows, ["k"], F.col("m"), 16)
    got = [(r.k, *sorted((r.a, r.b))) for r in dealt.mapInArrow(pairs, "k int, a long, b long").collect()]
    expected = [(k, a, b) for k in (1, 2) for a in range(70 * k) for b in range(a + 1, 70 * k)]
    assert sorted(got) == expected


def plain_sets(texts: dict[int, str | None], size: int) -> dict[int, frozenset]:
    sets = {}
    for i, text in texts.items():
        words = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        if len(words) >= size:
            sets[i] = frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
        else:
            sets[i] = frozenset([tuple(words)] if words else [])
    return sets


def plain_links(sets: dict[int, frozenset]) -> list[tuple[int, int]]:
    found, holders = [], defaultdict(list)
    for i in sorted(sets):
        seen = set()
        for x in sets[i]:
            seen.update(holders[x])
            holders[x].append(i)
        found += [(j, i) for j in seen if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    return found


def check_documents(rows, texts: dict[int, str | None], size: int):
    sets = plain_sets(texts, size)
    component = reachable(sets, plain_links(sets))
    for row in rows:
        assert row.n_shingles == len(sets[row.doc_id])
        assert row.component_id == component[row.doc_id]
        assert row.kept == (row.doc_id == component[row.doc_id])


def test_near_duplicates_of_the_test_documents(spark, sf_check):
    docs = spark.read.parquet(f"{sf_check}/documents.parquet")
    texts = {row.doc_id: row.text for row in docs.collect()}
    check_documents(hyperminhash.op1_hyperminhash(spark, sf_check).collect(), texts, 4)


def near_copies(n: int, seed: int) -> dict[int, str]:
    """A chain-like group of edited copies around the threshold, and unrelated texts."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(3000)}" for _ in range(150)]
    texts, words = {}, list(base)
    for i in range(n):
        if i % 7 == 0:
            words = list(base)
        for _ in range(draw.randint(0, 6)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        texts[i] = " ".join(words)
        texts[1000 + i] = " ".join(f"u{draw.randrange(10**6)}" for _ in range(draw.randint(1, 60)))
    return texts


@pytest.mark.parametrize("size", [4, 5])
def test_groups_around_the_threshold(spark, size):
    texts = near_copies(120, size)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    small = hyperminhash.Settings(words=size, block=16)
    check_documents(hyperminhash.near_duplicates(docs, small).collect(), texts, size)


def test_registers_estimate_similarity():
    settings, rng = hyperminhash.Settings(), np.random.default_rng(0)
    off = []
    for size in (20, 200, 3000):
        for share in (0.0, 0.5, 0.8):
            common = rng.integers(0, 2**63, int(size * 2 * share / (1 + share)), dtype=np.uint64)
            sets = [
                np.unique(np.concatenate((common, rng.integers(0, 2**63, size - len(common), dtype=np.uint64))))
                for _ in range(2)
            ]
            # The registers expect hashes over the whole range.
            sets = [np.unique(hyperminhash_mix(x)) for x in sets]
            begin = np.cumsum([0, *map(len, sets)])
            one, two = hyperminhash.sketch(np.concatenate(sets), begin, settings)
            true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
            n = np.array([len(sets[0])]), np.array([len(sets[1])])
            off.append(hyperminhash.estimate(one, two[None], *n, settings)[0] - true)
    assert max(map(abs, off)) < 0.15


def hyperminhash_mix(x):
    from vintagemill.llm.textbytes import mix

    return mix(x)


def test_document_edges(spark, edge, clashing, nothing):
    rows = {(r.doc_id, r.n_shingles): r for r in hyperminhash.near_duplicates(edge).collect()}
    assert rows[1, 0].component_id == 1
    assert rows[2, 0].kept
    assert rows[3, 0].kept
    assert rows[4, 1].kept
    assert rows[7, 116].component_id == 6
    null = rows[None, 1]
    assert (null.component_id, null.kept) == (None, True)
    kept = hyperminhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 8]
    assert hyperminhash.near_duplicates(nothing).count() == 0
    assert hyperminhash.keep_one(nothing).count() == 0


def plain_cosine(vectors: dict[int, list | None], threshold: float):
    good = {}
    for i, v in vectors.items():
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            scaled = np.array(v, dtype=float) / max(map(abs, v))
            good[i] = scaled / np.linalg.norm(scaled)
    links = [
        (i, j)
        for i in good
        for j in good
        if i < j and len(good[i]) == len(good[j]) and good[i] @ good[j] >= threshold
    ]
    return links


def check_vectors(rows, vectors, threshold=0.9):
    links = plain_cosine(vectors, threshold)
    component, degree = reachable(vectors, links), defaultdict(int)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    assert len(rows) == len(vectors)
    for row in rows:
        assert (row.n_links, row.component_id) == (degree[row.vec_id], component[row.vec_id])
        assert row.kept == (row.vec_id == row.component_id)


@pytest.mark.parametrize("block", [8, 512])
def test_vectors_against_all_pairs(spark, block):
    rng = np.random.default_rng(2)
    vectors: dict[int, list | None] = {}
    for i in range(20):
        centre = rng.normal(size=24)
        for j in range(15):
            vectors[i * 15 + j] = (centre + rng.normal(size=24) * rng.choice([0.0, 0.1, 0.35])).tolist()
    odd = [None, [], [0.0] * 24, [math.nan] * 24, [math.inf] + [1.0] * 23, [None] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0], [1e308] * 24, [1e-300] * 24]
    vectors |= dict(enumerate(odd, start=1000))
    rows = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    settings = cosine.Settings(block=block, miss=1e-6)
    check_vectors(cosine.near_duplicates(rows, settings).collect(), vectors)


def test_vectors_of_the_test_table(spark, sf_check):
    rows = spark.read.parquet(f"{sf_check}/embeddings.parquet").collect()
    check_vectors(cosine.op9_sign_hashing(spark, sf_check).collect(), {r.vec_id: r.embedding for r in rows})


def test_vector_edges(spark):
    schema = "vec_id long, embedding array<float>, rep int, size int"
    assert cosine.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    bad = spark.createDataFrame([(1, None, 0, 0), (2, [0.0], 0, 0)], schema)
    assert [tuple(r) for r in cosine.near_duplicates(bad).orderBy("vec_id").collect()] == [
        (1, 0, 1, True),
        (2, 0, 2, True),
    ]
    same_id = [(5, [1.0, 0.0], 0, 0), (5, [1.0, 0.05], 0, 0), (6, [1.0, 0.05], 0, 0), (7, [0.0, 1.0], 0, 0)]
    got = cosine.near_duplicates(spark.createDataFrame(same_id, schema)).orderBy("vec_id", "n_links").collect()
    assert [(r.vec_id, r.n_links, r.component_id) for r in got] == [(5, 2, 5), (5, 2, 5), (6, 2, 5), (7, 0, 7)]


def exact_passages(texts: dict[int, str | None], least: int) -> dict[int, set[int]]:
    """Words of each document that lie in a window of ``least`` words that another document has."""
    words = {i: words_of((t or "").lower()) for i, t in texts.items()}
    holders = defaultdict(set)
    for i, own in words.items():
        for k in range(len(own) - least + 1):
            holders[tuple(own[k : k + least])].add(i)
    covered = defaultdict(set)
    for i, own in words.items():
        for k in range(len(own) - least + 1):
            if len(holders[tuple(own[k : k + least])]) > 1:
                covered[i] |= set(range(k, k + least))
    return covered


def test_passages_cover_all_exact_repeats(spark, sf_check):
    docs = spark.read.parquet(f"{sf_check}/documents.parquet")
    expected = exact_passages({r.doc_id: r.text for r in docs.collect()}, 50)
    got = defaultdict(set)
    for row in passages.op10_compact_windows(spark, sf_check).collect():
        assert row.n_words == row.to_word - row.from_word >= 50
        assert row.other_doc_id != row.doc_id
        got[row.doc_id] |= set(range(row.from_word, row.to_word))
    assert all(expected[i] <= got[i] for i in expected)


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_planted_passages_and_clean_documents(spark, rounds):
    draw = random.Random(9)

    def fresh(n):
        return [f"w{draw.randrange(10**7)}" for _ in range(n)]

    shared, line = [fresh(n) for n in (50, 55, 80, 130)], fresh(14)
    texts, planted, edited = {}, set(), set()
    for i in range(60):
        # Every document holds the common line, which is too short to count.
        body = fresh(draw.randint(60, 200)) + line + fresh(30)
        if i % 3 == 0:
            body += shared[i // 3 % 4] + fresh(40)
            planted.add(i)
        if i in (1, 4):
            copy = list(shared[3])
            copy[60] = f"edit{i}"
            body += copy + fresh(20)
            edited.add(i)
        texts[i] = " ".join(body)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    settings = passages.Settings(rounds=max(1, rounds), block=16)
    if rounds == 0:
        found = passages._blocks(open_groups(rows, settings), rows.toDF("doc", "text"), settings)
        assert {r.of for r in found.collect()} >= planted
        return
    got = {r.doc_id for r in passages.repeated_passages(rows, settings).collect()}
    assert got == planted | edited


def open_groups(rows, settings):
    signed = passages._signed(rows.toDF("doc", "text"), settings)
    groups = signed.groupBy("key").agg(F.min("doc").alias("a"), F.max("doc").alias("b"))
    return signed.join(groups.where("a <> b").select("key"), "key")


def test_passage_edges(spark, edge, clashing, nothing):
    got = [tuple(r) for r in passages.repeated_passages(clashing).orderBy("doc_id").collect()]
    assert got == [(6, 0, 120, 120, 7), (7, 0, 120, 120, 6)]
    assert passages.repeated_passages(nothing).count() == 0
    alone = edge.where("doc_id = 7")
    assert passages.repeated_passages(alone).count() == 0


def test_sliding_minima():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 50, 300).astype(np.uint64) << np.uint64(40)
    for length in (1, 2, 3, 46, 64, 100):
        got = passages._smallest(values, length)
        expected = [k + int(values[k : k + length].argmin()) for k in range(300 - length + 1)]
        assert got.tolist() == expected


def near_rows(texts: dict[int, str], settings) -> set[tuple[int, int]]:
    """Pairs (i, j) of documents that share a signature and of which i has a near copy of a passage of j."""
    import pyarrow as pa

    from vintagemill.llm.textbytes import pieces

    values, holders = {}, defaultdict(set)
    for i, text in texts.items():
        [piece] = pieces([pa.RecordBatch.from_arrays([pa.array([text])], ["text"])])
        values[i], first = passages.sequences(piece, settings.words)
        for key in passages.stretches(values[i], first, settings)[0].tolist():
            holders[key].add(i)
    pairs = {(i, j) for group in holders.values() for i in group for j in group if i != j}
    return {(i, j) for i, j in pairs if passages.near_windows(values[i], values[j], settings).any()}


def test_chains_of_edited_copies(spark):
    draw = random.Random(21)

    def fresh(n):
        return [f"w{draw.randrange(10**7)}" for _ in range(n)]

    texts = {}
    for trial in range(60):
        original = fresh(55)
        for k, at in ((1, None), (0, draw.randrange(55)), (2, draw.randrange(55))):
            copy = list(original)
            if at is not None:
                copy[at] = f"edit{trial}x{k}"
            texts[10 * trial + k] = " ".join(fresh(30) + copy + fresh(30))
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    settings = passages.Settings()
    got = {r.doc_id for r in passages.repeated_passages(rows, settings).collect()}
    assert got >= {i for i, _ in near_rows(texts, settings)}


def views(texts: list[np.ndarray], places: list[int], settings) -> np.ndarray:
    reach = settings.length + settings.spare
    padded = [np.concatenate((np.zeros(reach - 1), x, np.zeros(reach - 1))).astype(np.uint32) for x in texts]
    return np.array([x[p : p + 2 * reach - 1] for x, p in zip(padded, places, strict=True)])


def test_blocks_count_shingles_wherever_they_stand():
    draw, settings = random.Random(8), passages.Settings()
    lost = 0
    for trial in range(300):
        base = [draw.randrange(1, 10**9) for _ in range(60)]
        other, at = list(base), draw.randrange(60)
        edit = trial % 3
        if edit == 0:
            other.insert(at, draw.randrange(1, 10**9))
        elif edit == 1:
            del other[at]
        else:
            other[at] = draw.randrange(1, 10**9)
        both = []
        for body in (base, other):
            body = [draw.randrange(1, 10**9) for _ in range(20)] + body + [draw.randrange(1, 10**9) for _ in range(20)]
            grams = [tuple(body[k : k + settings.words]) for k in range(len(body) - settings.words + 1)]
            both.append(np.array([hash(g) % (2**32 - 1) + 1 for g in grams], dtype=np.uint32))
        same = [x for x in both[0].tolist() if x in set(both[1].tolist())]
        shared = same[draw.randrange(len(same))]
        places = [int(np.flatnonzero(x == shared)[0]) for x in both]
        args = np.array([1, 2]), np.array(places), np.array([0, 1]), np.array([0, 1]), np.array([True, True])
        got = {row[2] for row in passages.compared(views(both, places, settings), *args, settings)}
        for i, (own, rest) in enumerate((both, both[::-1])):
            close = np.flatnonzero(passages.near_windows(own, rest, settings))
            # Only windows that hold the shared minimum are the block's to find.
            held = close[(close <= places[i]) & (places[i] < close + settings.length)]
            assert len(held) == 0 or i + 1 in got
            lost += len(held) > 0
    assert lost > 300


def test_each_row_of_a_block_gets_its_own_words():
    settings = passages.Settings()
    base, fresh = list(range(1, 71)), iter(range(1000, 10**6))
    # Row 0 holds 70 shingles, rows 1 and 2 its first and its last 50, row 3 none.
    first = [next(fresh) for _ in range(20)] + base[:50] + [next(fresh) for _ in range(20)]
    last = [next(fresh) for _ in range(30)] + base[20:] + [next(fresh) for _ in range(20)]
    texts = [np.array(x) for x in (base, first, last, [next(fresh) for _ in range(90)])]
    places = [35, 55, 45, 40]
    args = np.array([1, 2, 3, 4]), np.array(places), np.arange(4), np.arange(4)
    rows = passages.compared(views(texts, places, settings), *args, np.ones(4, dtype=bool), settings)
    words = {row[2]: (row[1], *row[3:]) for row in rows}
    # A window may hold five foreign shingles of 46, on either side.
    assert len(rows) == 3
    assert words[1] == (2, 0, 74)
    assert words[2] == (1, 15, 79)
    assert words[3] == (1, 25, 89)


def brute_words(view, doc, group, place, left, is_open, settings) -> dict[int, set[int]]:
    """Words in close windows of the rows that may get some: open rows of any other, settled ones of open rows."""
    length, spare, found = settings.length, settings.spare, defaultdict(set)
    for i in range(len(doc)):
        own = view[i][spare : len(view[i]) - spare]
        for j in range(len(doc)):
            if group[i] != group[j] or doc[i] == doc[j] or not (is_open[i] or is_open[j]):
                continue
            shared = np.isin(own, view[j][view[j] != 0])
            for k in range(length):
                if own[k : k + length].all() and shared[k : k + length].sum() >= settings.matches:
                    start = place[i] + k - length + 1
                    found[int(doc[i])] |= set(range(start, start + length + settings.words - 1))
    return found


@pytest.mark.parametrize("few", [0, 256])
def test_groups_of_a_block_and_repeated_lines(monkeypatch, few):
    monkeypatch.setattr(passages, "_FEW", few)
    settings, rng = passages.Settings(), np.random.default_rng(11)
    texts, group, base = [], [], rng.integers(1, 10**9, 200)
    for g in range(6):
        line = rng.integers(1, 10**9, 9)
        for k in range(7):
            if k < 3:
                # Repeated lines, each turned by some words and some with an edit.
                text = np.tile(np.roll(line, k), 22)
                text[rng.integers(0, len(text), k)] = rng.integers(1, 10**9, k)
            else:
                text = np.concatenate((rng.integers(1, 10**9, 40), base[k * 10 : k * 10 + 90], line))
                text[rng.integers(0, len(text), 2)] = rng.integers(1, 10**9, 2)
            texts.append(text)
            group.append(g)
    group = np.repeat(group, 3)
    place = np.concatenate([rng.integers(0, len(x), 3) for x in texts])
    # The documents of a group are those of the others too.
    doc = np.tile(np.repeat(np.arange(7), 3), 6) + 100 * (group > 3)
    view = views([texts[i // 3] for i in range(len(place))], place.tolist(), settings)
    is_open = rng.random(len(doc)) < 0.5
    left = np.flatnonzero(is_open)
    got = defaultdict(set)
    args = doc, place, left, np.arange(len(doc)), is_open, settings, group
    for _, hub, of, start, end in passages.compared(view, *args):
        assert hub != of
        got[of] |= set(range(start, end))
    assert got == brute_words(view, doc, group, place, left, is_open, settings)
    assert got


def test_rows_that_share_a_short_line_alone_are_not_compared(monkeypatch):
    settings, rng, asked = passages.Settings(), np.random.default_rng(12), []

    def counted(ids, group, rank, rows, others, settings):
        asked.append(len(rows))
        return iter(())

    monkeypatch.setattr(passages, "_nearest", counted)
    width = 2 * (settings.length + settings.spare) - 1
    view = rng.integers(1, 2**32, (3000, width)).astype(np.uint32)
    view[:, width // 2 - 5 : width // 2 + 5] = np.arange(1, 11)
    # Rows of one document share all they have with each other.
    view[:1000] = view[0]
    doc = np.concatenate((np.zeros(1000, dtype=np.int64), np.arange(1, 2001)))
    rows = np.arange(3000)
    is_open = np.ones(3000, dtype=bool)
    assert passages.compared(view, doc, np.full(3000, 200), rows, rows, is_open, settings) == []
    assert sum(asked) == 0


@pytest.mark.parametrize("edit", ["changed", "inserted"])
def test_short_near_copies_share_a_signature(edit):
    settings, rng, trials = passages.Settings(), np.random.default_rng(5), 2000

    def grams(words):
        total = np.zeros(len(words) - settings.words + 1, dtype=np.uint64)
        for k in range(settings.words):
            total = hyperminhash_mix(total * np.uint64(31) + words[k : k + len(total)])
        return total

    def fresh(n):
        return rng.integers(1, 2**62, n).astype(np.uint64)

    rows, missed = [], 0
    for _ in range(trials):
        base = fresh(settings.least)
        other = np.insert(base, 25, fresh(1)) if edit == "inserted" else np.where(np.arange(50) == 25, fresh(1), base)
        rows += [grams(np.concatenate((fresh(40), x, fresh(40)))) for x in (base, other)]
    first = np.cumsum([0, *map(len, rows)])
    key, row, _ = passages.stretches(np.concatenate(rows), first, settings)
    keys = [set() for _ in rows]
    for k, r in zip(key.tolist(), row.tolist(), strict=True):
        keys[r].add(k)
    missed = sum(not keys[2 * t] & keys[2 * t + 1] for t in range(trials))
    assert missed <= trials // 1000
