"""Byte-level BPE by a sentencepiece model that is written straight from a rank vocabulary."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Sequence

import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfcast.llm.shared import map_texts

#: Byte b is the character with this code plus b; none of them is special to the library.
FIRST_CHAR = 0x100
#: Characters of the pre-tokens whose ids a task remembers, besides those of the text at hand.
REMEMBERED = 1_500_000
#: Field numbers and enum values of the public model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
UNKNOWN_TYPE = 2
MODEL_TYPE, VOCAB_SIZE, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 3, 4, 40, 41, 42, 43
BPE = 2
NORM_NAME, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 1, 3, 4, 5


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of rank; the ranks have to run from 0 without a gap."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks have gaps")
    return [tokens[i] for i in range(len(tokens))]


def _varint(value: int) -> bytes:
    out = bytearray()
    value &= (1 << 64) - 1
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def mapped(data: bytes) -> str:
    return data.decode("latin-1").translate(_MAP)


_MAP = {b: FIRST_CHAR + b for b in range(256)}


def model_bytes(tokens: list[bytes]) -> bytes:
    """A serialised model whose piece i is token i, scored -i; the unknown piece comes last."""
    out = []
    for rank, token in enumerate(tokens):
        piece = _bytes(PIECE_TEXT, mapped(token).encode()) + _varint(PIECE_SCORE << 3 | 5)
        out.append(_bytes(PIECES, piece + struct.pack("<f", -float(rank))))
    unknown = _bytes(PIECE_TEXT, b"<unk>") + _number(PIECE_TYPE, UNKNOWN_TYPE)
    out.append(_bytes(PIECES, unknown))
    trainer = (
        _number(MODEL_TYPE, BPE) + _number(VOCAB_SIZE, len(tokens) + 1)
        + _number(UNK_ID, len(tokens)) + _number(BOS_ID, -1) + _number(EOS_ID, -1)
        + _number(PAD_ID, -1)
    )
    identity = (
        _bytes(NORM_NAME, b"identity") + _number(DUMMY_PREFIX, 0) + _number(EXTRA_SPACES, 0)
        + _number(ESCAPE_SPACES, 0)
    )
    return b"".join(out) + _bytes(TRAINER, trainer) + _bytes(NORMALIZER, identity)


class Codec:
    """Encodes and decodes with one loaded model."""

    def __init__(self, model: bytes, tokens: list[bytes], pattern: str):
        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens = tokens
        self.split = regex.compile(pattern)
        self.known: dict[str, list[int]] = {}
        self.remembered = 0

    def encode(self, text: str) -> list[int]:
        parts = self.split.findall(text)
        known = self.known
        new = [p for p in dict.fromkeys(parts) if p not in known]
        if new:
            if self.remembered > REMEMBERED:
                known.clear()
                self.remembered = 0
                new = list(dict.fromkeys(parts))
            self.remembered += sum(map(len, new))
            spelled = [mapped(p.encode()) for p in new]
            known.update(zip(new, self.encoder.encode(spelled, out_type=int, num_threads=1)))
        return [i for p in parts for i in known[p]]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


#: What can be asked for per document.
OUTPUTS = {
    "ids": T.ArrayType(T.IntegerType()),
    "n_tokens": T.LongType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def encode_documents(
    docs: DataFrame, vocabulary: str, pattern: str, outputs: Sequence[str] = tuple(OUTPUTS)
) -> DataFrame:
    """Adds ``outputs`` to the columns of ``docs``, replacing columns of such names.

    ids are the token ids, n_tokens their number, ids_sha256 the digest of the ids as little-endian
    unsigned 32-bit integers. decoded_sha256 is the digest of the bytes that the inverse mapping
    makes of the ids. NULL and empty texts have no ids and the digests of no bytes. Repeated rows
    are encoded alike, and an empty table gives no rows.

    Vocabulary and model are read on the driver and broadcast; their size is that of the file.
    """
    tokens = read_ranks(vocabulary)
    shipped = docs.sparkSession.sparkContext.broadcast((model_bytes(tokens), tokens))

    def start():
        codec = Codec(*shipped.value, pattern)
        packed = lambda ids: struct.pack(f"<{len(ids)}I", *ids)
        make = {
            "ids": lambda ids: ids,
            "n_tokens": len,
            "ids_sha256": lambda ids: hashlib.sha256(packed(ids)).hexdigest(),
            "decoded_sha256": lambda ids: hashlib.sha256(codec.decode(ids)).hexdigest(),
        }
        makers = [make[name] for name in outputs]

        def one(text):
            ids = codec.encode(text or "")
            return tuple([m(ids) for m in makers])

        return lambda texts: [one(t) for t in texts]

    return map_texts(docs, start, [T.StructField(n, OUTPUTS[n]) for n in outputs])
