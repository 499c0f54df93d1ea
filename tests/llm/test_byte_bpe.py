"""Ids against the public tokenizer library, and the round trip."""

import base64
import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from shelfcast.llm import byte_bpe

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def known():
    with open(VOCABULARY, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def codec():
    tokens = byte_bpe.read_ranks(VOCABULARY)
    return byte_bpe.Codec(byte_bpe.model_bytes(tokens), tokens, public_tokenizers.PATTERN)


CASES = [
    "", " ", "\n\n  x", "it's  we'll\t\t\ttabs", "<unk> <s> </s> <|endoftext|>", "▁ ▁a",
    "Ā\x00\x1c\x1d\x1e\x1f\x85\xa0  é 日本語 🤖👩‍👩‍👧", "a" * 3000, " " * 500 + "b", "\r\n\r\n\x0b\x0c",
    "123456 7½ ٣٤", "ſ K ß İ", "Öüßäé ñ ç",
]


@pytest.mark.parametrize("text", CASES)
def test_edge_texts(codec, known, text):
    ids = codec.encode(text)
    assert ids == known.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_random_texts(codec, known):
    rng = random.Random(3)
    alphabet = list("abcdeT '\n\t .,!?019éßñ") + ["the", "ing", "　", "\x1c", "語", "🤖", "'s", "  "]
    for _ in range(400):
        text = "".join(rng.choices(alphabet, k=rng.randrange(1, 120)))
        ids = codec.encode(text)
        assert ids == known.encode_ordinary(text) and codec.decode(ids) == text.encode()


def test_what_is_remembered_is_bounded(codec, known, monkeypatch):
    """By characters, so that few long pre-tokens are forgotten as soon as many short ones."""
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 1000)
    for i in range(60):
        text = chr(97 + i % 26) * 400 + f" {i} and so on"
        assert codec.encode(text) == known.encode_ordinary(text)
        held = sum(map(len, codec.known))
        assert held == codec.remembered <= 1000 + len(text)
    assert codec.encode("") == []


def test_digests_of_rows(spark, known):
    rows = [(1, "Hello  world", 7), (None, "Hello  world", 8), (2, None, None), (2, "", 1),
            (3, "word " * 40_000, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = byte_bpe.encode_documents(docs, VOCABULARY, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    for row in got:
        ids = known.encode_ordinary(row.text or "")
        assert row.n_tokens == len(ids) and row.ids == ids
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.encode_documents(docs, VOCABULARY, public_tokenizers.PATTERN).collect() == []
