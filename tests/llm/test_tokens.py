"""Byte-level BPE against a public library, and unigram counts against another."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from vintagemill.llm import bpe, unigram

from .conftest import edge_rows

VOCABULARIES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")


def public_bpe(name: str) -> tiktoken.Encoding:
    ranks = bpe.read_ranks(public_tokenizers.path(name))
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def odd_texts(n: int, seed: int) -> list[str]:
    draw = random.Random(seed)
    letters = "theanding EROS!!$$$### ñçß\n\t  aabb12||日本🙂's\u2028\x1c\x85\xa0"
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("name", VOCABULARIES)
def test_transducer_equals_the_public_encoder(name):
    path = public_tokenizers.path(name)
    known, public = bpe._Pieces(bpe.Transducer(bpe.read_ranks(path), states=500)), public_bpe(name)
    for text in odd_texts(3000, 1):
        ids = [i for ids in bpe._encoded([text], known) for i in ids.tolist()]
        assert ids == public.encode_ordinary(text)


def test_whole_texts_as_one_piece():
    machine = bpe.Transducer(bpe.read_ranks(public_tokenizers.path(VOCABULARIES[0])))
    public = public_bpe(VOCABULARIES[0])
    for text in odd_texts(1500, 2):
        if text:
            assert machine.encode(text.encode()) == public._encode_single_piece(text.encode())
            assert machine._with_past(text.encode()) == public._encode_single_piece(text.encode())


def test_a_long_piece_is_linear():
    machine = bpe.Transducer(bpe.read_ranks(public_tokenizers.path(VOCABULARIES[0])))
    text = b"abcdefghij" * 20_000
    assert b"".join(machine._bytes[i] for i in machine.encode(text)) == text


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60), st.lists(st.integers(1, 7), max_size=30))
def test_streaming_utf8_equals_decoding_at_once(data, cuts):
    stream, out, at = bpe.Utf8Stream(), [], 0
    for cut in cuts:
        out.append(stream.feed(data[at : at + cut]))
        at += cut
    out += [stream.feed(data[at:]), stream.end()]
    assert "".join(out) == data.decode("utf-8", "replace")


def test_encode_decode_and_digests(spark, edge, prose):
    public, path = public_bpe(VOCABULARIES[0]), public_tokenizers.path(VOCABULARIES[0])
    for docs in (edge, prose):
        texts = [row.text or "" for row in docs.collect()]
        decoded = bpe.decode(bpe.encode(docs.select("doc_id", "text"), path)).collect()
        assert [row.decoded_text for row in decoded] == texts
        assert [bytes(row.decoded) for row in decoded] == [text.encode() for text in texts]
        assert [list(row.token_ids) for row in decoded] == [public.encode_ordinary(t) for t in texts]
        for row, text in zip(bpe.digest(bpe.round_trip(docs)).collect(), texts, strict=True):
            ids = public.encode_ordinary(text)
            assert row.n_tokens == len(ids)
            assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_keeps_other_columns(clashing, nothing):
    assert bpe.encode(clashing).columns == [
        *[c for c in clashing.columns if c not in ("text", "token_ids")],
        "token_ids",
    ]
    assert bpe.round_trip(clashing).count() == clashing.count()
    assert bpe.digest(bpe.round_trip(nothing)).count() == 0


def public_unigram(scores: dict[str, float], byte_fallback: bool) -> Tokenizer:
    items = [("<unk>", min(scores.values())), *scores.items()]
    if byte_fallback:
        items += [(f"<0x{i:02X}>", min(scores.values())) for i in range(256)]
    made = Tokenizer(models.Unigram(items, 0, byte_fallback))
    made.pre_tokenizer = pre_tokenizers.Metaspace(
        replacement=unigram.MARK, prepend_scheme="always", split=True
    )
    return made


def test_counts_equal_the_public_unigram_model(prose):
    vocabulary = unigram.read_vocabulary(public_tokenizers.path(unigram.VOCABULARY))
    counter, public = unigram.Counter(vocabulary), public_unigram(vocabulary.scores, True)
    texts = [row.text for row in prose.collect()] + odd_texts(800, 3)
    for text in texts:
        assert counter.text(text) == len(public.encode(text, add_special_tokens=False).ids)


def test_ties_and_unknowns_in_small_vocabularies():
    draw = random.Random(4)
    for _ in range(100):
        entries = ["".join(draw.choice("abc▁") for _ in range(draw.randint(1, 4))) for _ in range(12)]
        scores = {entry: float(-draw.randint(1, 4)) for entry in entries}
        public = public_unigram(scores, False)
        counter = unigram.Counter(unigram.Vocabulary(scores, False))
        for _ in range(15):
            text = "".join(draw.choice("abcdé  ") for _ in range(draw.randint(0, 14)))
            assert counter.text(text) == len(public.encode(text, add_special_tokens=False).ids)


def test_count_edges(edge, clashing, nothing):
    counted = {row.doc_id: row for row in unigram.count_tokens(edge).collect()}
    assert counted[1].n_tokens == counted[2].n_tokens == 0
    assert counted[5].n_chars_counted == len(edge_rows()[4][1])
    assert unigram.count_tokens(clashing).count() == clashing.count()
    assert unigram.count_tokens(nothing).count() == 0
