"""Encoding and decoding against the library that made the model."""

from __future__ import annotations

import random
import struct

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridelake.llm import piecebpe
from ridelake.llm.queries import QUERIES
from tests.llm import brute

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoder():
    return piecebpe.encoder_of(open(MODEL, "rb").read())


def ids(encoder, text):
    data = encoder.encode(text)
    return list(struct.unpack(f"<{len(data) // 4}i", data))


def assert_same(library, encoder, text):
    expected = library.encode(text)
    assert ids(encoder, text) == expected, text[:200]
    assert encoder.decode(expected) == library.decode(expected), text[:200]


ODD = [
    "", " ", "  ", "\n", "a", " a", "a ", "  a  b ", "▁", "▁a ▁", "a\x00b", "\t\ttabs\r\n", "<s></s><unk><0x0A>",
    "�", "é", "é", "你好 \U0001f600\U0001f600", "aaaaaaaaaaaaaaaaaaaaaaaa", "a" * 5000, " " * 100, "=" * 333,
    "-" * 65 + " " + "-" * 64, "ab" * 3000, " x　y", "don't WON'T", "1234567890" * 50, "hello" + "\n" * 40 + "world",
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(library, encoder, text):
    assert_same(library, encoder, text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert_same(library, piecebpe.encoder_of(open(MODEL, "rb").read()), text.encode("utf-8", "ignore").decode())


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abeinrst ▁.=\n", max_size=80))
def test_texts_of_few_characters(text):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert_same(library, piecebpe.encoder_of(open(MODEL, "rb").read()), text)


def test_pieces_in_a_row(library, encoder):
    """Texts glued from pieces, where many ways to cut them compete."""
    random.seed(12)
    names = [library.id_to_piece(k) for k in range(259, library.get_piece_size())]
    for _ in range(3000):
        assert_same(library, encoder, "".join(random.choices(names, k=random.randrange(1, 9))).replace("▁", " "))


def test_last_token_of_every_prefix(library, encoder):
    part = "▁unbelievablyé你x"
    last = encoder.last_tokens(part)
    for end in range(2, len(part) + 1):
        expected = library.encode(part[1:end], out_type=str)
        assert last[end] == expected[-1] or (last[end] is None and expected[-1].startswith("<0x"))


def test_any_ids_decode_as_in_the_library(library, encoder):
    random.seed(3)
    for _ in range(2000):
        some = [random.choice([random.randrange(32_000), random.randrange(3, 259), random.randrange(3)]) for _ in range(random.randrange(8))]
        assert encoder.decode(some) == library.decode(some), some


def test_bounds_of_what_is_remembered_do_not_show(library, encoder, monkeypatch):
    monkeypatch.setattr(piecebpe, "PARTS", 3)
    monkeypatch.setattr(piecebpe, "PAIRS", 3)
    for text in ["the quick brown fox jumps over the lazy dog and away " * 3, "one two three four five six"]:
        assert_same(library, encoder, text)


def test_other_models_are_refused():
    data = open(MODEL, "rb").read()
    with pytest.raises(ValueError):
        piecebpe.Model.parsed(data + bytes([0x12, 2, 0x18, 1]))  # a trainer's part that says unigram


def expected_row(library, doc_id, text):
    encoded = library.encode(text or "")
    return (doc_id, len(encoded), brute.sha(",".join(map(str, encoded))), brute.sha(library.decode(encoded)))


def test_stored_and_odd_documents(spark, corpus, rows, none, library):
    del spark
    df = piecebpe.round_trip(corpus, MODEL)
    done = df.select("doc_id", F.size("ids"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256), F.sha2("decoded", 256))
    found = sorted((tuple(r) for r in done.collect()), key=repr)
    assert found == sorted((expected_row(library, *row) for row in rows), key=repr)
    assert piecebpe.round_trip(none, MODEL).count() == 0


def test_query(spark, folder, library):
    found = sorted(tuple(r) for r in QUERIES["op12_sentencepiece"](spark, folder).collect())
    stored = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert found == sorted(expected_row(library, *row) for row in stored)


def test_encode_then_decode(spark, corpus, rows, library):
    del spark
    encoded = piecebpe.encode(corpus, MODEL)
    assert sorted((repr(r.doc_id), list(r.ids)) for r in encoded.collect()) == sorted((repr(k), library.encode(t or "")) for k, t in rows)
    text = {(repr(r.doc_id), r.text) for r in piecebpe.decode(encoded, MODEL).collect()}
    assert text == {(repr(k), library.decode(library.encode(t or ""))) for k, t in rows}
