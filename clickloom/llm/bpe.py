"""Byte-level BPE encoding and decoding by a sentencepiece model made from a rank file.

The rank file's vocabulary is written as a sentencepiece ``ModelProto``: each byte
of a piece becomes one character, a piece's score is its negative rank, and the
normaliser is the identity. Merging by the best score is then merging by the lowest
rank. Pre-tokens are encoded one by one; ids map back to pieces and to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import sys
from array import array

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from clickloom.llm.common import map_rows, whole_text
from clickloom.llm.pretokens import CachedIds, worker_local

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A byte's character: one code point for each byte, none of them white space.
_FIRST = 0x100
_TO_CHARS = {b: chr(_FIRST + b) for b in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """Pieces of a rank file, by rank. Ranks must run from 0 without a gap."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    pieces = {int(rank): base64.b64decode(piece) for piece, rank in pairs}
    if sorted(pieces) != list(range(len(pieces))):
        raise ValueError(f"{path}: the ranks have gaps")
    return [pieces[i] for i in range(len(pieces))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def sentencepiece_model(pieces: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose ids are the ranks.

    Field numbers and enumeration values below are those of the public
    ``sentencepiece_model.proto``. The unknown piece that the format demands comes
    last, so it moves no id.
    """
    normal, unknown, bpe = 1, 2, 2
    out = []
    for rank, piece in enumerate(pieces):
        text = "".join(map(_TO_CHARS.__getitem__, piece)).encode()
        score = _varint(2 << 3 | 5) + struct.pack("<f", -float(rank))
        out.append(_field(1, _field(1, text) + score + _field(3, normal)))
    out.append(_field(1, _field(1, b"<unk>") + _field(3, unknown)))
    trainer = (
        _field(3, bpe)
        + _field(4, len(pieces) + 1)
        + _field(40, len(pieces))  # the unknown piece; no piece marks begin, end or padding
        + b"".join(_varint(n << 3) + b"\xff" * 9 + b"\x01" for n in (41, 42, 43))
    )
    normalizer = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(out) + _field(2, trainer) + _field(3, normalizer)


class ByteBpe:
    """Encode texts to ids and ids to bytes."""

    def __init__(self, pieces: list[bytes], pattern: str):
        model = SentencePieceProcessor(model_proto=sentencepiece_model(pieces))
        known = {piece: rank for rank, piece in enumerate(pieces)}

        def encode(pretoken: str) -> list[int]:
            raw = pretoken.encode()
            rank = known.get(raw)
            if rank is not None:
                return [rank]
            return model.encode("".join(map(_TO_CHARS.__getitem__, raw)))

        self.encode = CachedIds(encode, pattern)
        self._bytes = [
            bytes(ord(c) - _FIRST for c in model.id_to_piece(i)) for i in range(len(pieces))
        ]

    def decode(self, ids: bytes) -> bytes:
        numbers = array("I", ids)
        if sys.byteorder == "big":
            numbers.byteswap()
        return b"".join(map(self._bytes.__getitem__, numbers))


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids", pa.binary()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
)


def encode_documents(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """Ids of every whole text, and digests of the ids and of the bytes they decode to.

    One row per input row, in one pass without a shuffle: ``doc_id``, ``n_tokens``,
    ``ids`` (binary, little-endian unsigned 32-bit; left out unless ``keep_ids``),
    ``ids_sha256`` and ``decoded_sha256``. ``vocabulary`` is a rank file on the
    driver; its pieces (fixed size) travel with the function. Null and empty texts
    have no ids and the digest of nothing; repeated rows repeat their result; other
    columns are ignored; an empty table gives an empty result.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    schema = _SCHEMA if keep_ids else pa.schema([f for f in _SCHEMA if f.name != "ids"])

    def rows(incoming):
        bpe = worker_local(
            ("bpe", vocabulary, len(pieces.value), pattern), lambda: ByteBpe(pieces.value, pattern)
        )
        for row in incoming:
            ids = bpe.encode(row["text"])
            yield {
                "doc_id": row["doc_id"],
                "n_tokens": len(ids) // 4,
                "ids": ids,
                "ids_sha256": hashlib.sha256(ids).hexdigest(),
                "decoded_sha256": hashlib.sha256(bpe.decode(ids)).hexdigest(),
            }

    ddl = ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)
    return whole_text(docs, id_col, text_col).mapInArrow(map_rows(schema, rows), ddl)


_DDL = {pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
