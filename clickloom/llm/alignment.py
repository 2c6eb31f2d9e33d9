"""Which tokens of two tokenizers end together, and how often each pair does.

Every text is encoded twice; byte offsets at which a token of either side ends cut both
token sequences into groups, and the two tokens that end there are linked. Pairs are
counted by an inverted index: per pair one compressed bitmap of documents for each bit of
the pair's multiplicity in a document (a plane). The planes' union has one bit per
document that holds the pair; plane p counts 2 ** p links for each bit. Scores go back to
the documents through the same postings.
"""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from clickloom.llm.common import whole_text
from clickloom.llm.packing import byte_characters
from clickloom.llm.pretokens import worker_local
from clickloom.operators.joins import lookup_join
from clickloom.workspace import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Distinct pairs of documents that a task holds before it writes their bitmaps.
BLOCK_POSTINGS = 1 << 20
#: Most documents of a block: a bitmap's positions are 16-bit numbers.
BLOCK_DOCUMENTS = 1 << 16
#: Entries of each half of a worker's cache of words; longer words aren't kept.
CACHED_WORDS, LONGEST_WORD = 300_000, 40

#: Cuts that neither tokenizer's tokens cross: before a blank or a line's end between other marks.
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_SPACE_MARK = "▁"
#: Marks that the first tokenizer's pattern keeps apart from letters before them.
_MARKS = frozenset(".,;:!?")


class Aligner:
    """Both tokenizers, and the alignment of a text word by word.

    A word goes from one cut to the next. The first tokenizer's pattern ends a token at
    every cut; the second has no piece with a blank or a line's end behind another
    character, which is checked when the vocabulary is read.
    """

    def __init__(self, spec: bytes, model: bytes):
        self._first = Tokenizer.from_buffer(spec)
        self._first.encode_special_tokens = True
        self._second = SentencePieceProcessor(model_proto=model)
        self._tokenize, self._characters = self._first.model.tokenize, byte_characters()
        self._ascii = {b: c for b, c in self._characters.items() if b < 128}
        to_byte = {c: b for b, c in self._characters.items()}
        vocabulary = self._first.get_vocab(with_added_tokens=False)
        # every byte is a token, so the tokens' bytes are always the text's: lengths will do
        assert all(c in vocabulary for c in to_byte)
        lengths = {i: sum(c in to_byte for c in piece) for piece, i in vocabulary.items()}
        self._first_length = lengths.__getitem__
        second, self._second_bytes = self._second, []
        self._cuts_hold = True
        for i in range(second.get_piece_size()):
            piece = second.id_to_piece(i)
            if second.is_byte(i):
                self._second_bytes.append(bytes([int(piece[1:-1], 16)]))
                continue
            self._second_bytes.append(piece.replace(_SPACE_MARK, " ").encode())
            if "\n" in piece or re.search(f"[^{_SPACE_MARK}]{_SPACE_MARK}", piece):
                self._cuts_hold = False
        self._blank = second.piece_to_id(_SPACE_MARK)
        self._second_length = [len(b) for b in self._second_bytes].__getitem__
        # two halves: what was used since the last turn, and what before
        self._kept: dict[str, tuple | None] = {}
        self._older: dict[str, tuple | None] = {}

    def _pretoken(self, text: str) -> list[int]:
        if text.isascii():
            return [t.id for t in self._tokenize(text.translate(self._ascii))]
        return [t.id for t in self._tokenize("".join(map(self._characters.__getitem__, text.encode())))]

    def _first_ids(self, word: str) -> list[int]:
        # letters, and letters with one mark behind them, need no search for pre-tokens
        if word[0] == " ":
            if word[1:].isalpha():
                return self._pretoken(word)
            if word[-1] in _MARKS and word[1:-1].isalpha():
                return self._pretoken(word[:-1]) + self._pretoken(word[-1])
        return self._first.encode(word, add_special_tokens=False).ids

    def _align(self, word: str, second: list[int]) -> tuple:
        """Numbers of tokens, the groups as text, and the linked pairs; nothing if the tokens'
        bytes aren't the word's. ``second`` has the blank that the model puts before a text."""
        if word[0] != " ":
            if second[0] != self._blank:
                return ()
            second = second[1:]
        if b"".join(map(self._second_bytes.__getitem__, second)) != word.encode():
            return ()
        first = self._first_ids(word)
        if len(first) == len(second) == 1:
            return 1, 1, f"{first[0]}|{second[0]}", (first[0] << 32 | second[0],)
        ends_b = dict(zip(accumulate(map(self._second_length, second)), range(1, len(second) + 1)))
        groups, links, i0, j0 = [], [], 0, 0
        for i, end in enumerate(accumulate(map(self._first_length, first)), 1):
            if end in ends_b:
                j = ends_b[end]
                a, b = first[i - 1], second[j - 1]
                if i - i0 == j - j0 == 1:
                    groups.append(f"{a}|{b}")
                else:
                    groups.append(f"{','.join(map(str, first[i0:i]))}|{','.join(map(str, second[j0:j]))}")
                links.append(a << 32 | b)
                i0, j0 = i, j
        return len(first), len(second), ";".join(groups), tuple(links)

    def _look_up(self, words: set[str]) -> dict[str, tuple]:
        """``_align`` of words that aren't in the newer half of the cache."""
        found = {w: self._older[w] for w in words if w in self._older}
        fresh = list(words.difference(found))
        for k in range(0, len(fresh), 4096):
            some = fresh[k : k + 4096]
            texts = [w[1:] if w[0] == " " else w for w in some]
            for w, second in zip(some, self._second.encode(texts, num_threads=1), strict=True):
                found[w] = self._align(w, second)
        if len(self._kept) + len(found) > CACHED_WORDS:
            self._older, self._kept = self._kept, {}
        if len(found) <= CACHED_WORDS:
            self._kept.update(x for x in found.items() if len(x[0]) <= LONGEST_WORD)
        return found

    def __call__(self, text: str):
        """(n_a, n_b, groups as text, multiplicity by pair), or None for a text without tokens."""
        if not text:
            return None
        whole = " " + text
        words = _CUT.split(whole) if self._cuts_hold else [whole]
        aligned = list(map(self._kept.get, words))
        if None in aligned:
            found = self._look_up({w for w, known in zip(words, aligned) if known is None})
            aligned = [found[w] if known is None else known for w, known in zip(words, aligned)]
        if () in aligned:
            return None
        a, b, groups, links = zip(*aligned)
        return sum(a), sum(b), ";".join(groups), Counter(chain.from_iterable(links))


# -- bitmaps ---------------------------------------------------------------------


def pack_bitmap(positions: np.ndarray, documents: int) -> bytes:
    """Sorted positions below ``documents`` as 16-bit numbers, or as bits where that is shorter."""
    if 2 * len(positions) <= (documents + 7) // 8:
        return b"\0" + positions.astype("<u2").tobytes()
    bits = np.zeros(documents, bool)
    bits[positions] = True
    return b"\1" + np.packbits(bits, bitorder="little").tobytes()


def unpack_bitmap(bitmap: bytes) -> np.ndarray:
    """The positions of a bitmap, ascending."""
    if bitmap[0] == 0:
        return np.frombuffer(bitmap, "<u2", offset=1)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8, offset=1), bitorder="little"))


def count_bitmaps(planes: list[bytes]) -> tuple[int, int]:
    """Documents (bits of the planes' union) and links (bits weighed by their plane)."""
    if len(planes) == 1:
        ones = len(unpack_bitmap(planes[0]))
        return ones, ones
    places = [unpack_bitmap(p) for p in planes]
    union = np.zeros(1 + max(int(p[-1]) for p in places if len(p)), bool)
    for p in places:
        union[p] = True
    return int(np.count_nonzero(union)), sum(len(p) << k for k, p in enumerate(places))


def planes_of(positions: np.ndarray, times: np.ndarray, documents: int) -> list[bytes]:
    """One bitmap for each bit of the multiplicities ``times``."""
    most = int(times.max())
    if most == 1:
        return [pack_bitmap(positions, documents)]
    return [
        pack_bitmap(positions[(times >> k & 1).astype(bool)], documents)
        for k in range(most.bit_length())
    ]


# -- tasks -----------------------------------------------------------------------

_ROWS = [
    ("block", pa.int64(), "long"),
    ("position", pa.int32(), "int"),
    ("doc_id", pa.int64(), "long"),
    ("n_a", pa.int64(), "long"),
    ("n_b", pa.int64(), "long"),
    ("n_links", pa.int64(), "long"),
    ("groups", pa.string(), "string"),
    ("groups_sha256", pa.string(), "string"),
    ("pair", pa.int64(), "long"),
    ("planes", pa.list_(pa.binary()), "array<binary>"),
    ("kind", pa.string(), "string"),
]
_SCHEMA = pa.schema([f[:2] for f in _ROWS])
_DDL = ", ".join(f"{name} {kind}" for name, _, kind in _ROWS)


class _Block:
    """Documents of a task that share their bitmaps."""

    def __init__(self, number: int):
        self.number = number
        self.documents = 0
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.postings = 0

    def add(self, pairs: dict[int, int]) -> int:
        n = len(pairs)
        self.pairs.append(np.fromiter(pairs.keys(), np.int64, n))
        self.times.append(np.fromiter(pairs.values(), np.int64, n))
        self.sizes.append(n)
        self.postings += n
        self.documents += 1
        return self.documents - 1

    def full(self) -> bool:
        return self.postings >= BLOCK_POSTINGS or self.documents >= BLOCK_DOCUMENTS

    def rows(self):
        if not self.postings:
            return
        pairs = np.concatenate(self.pairs)
        order = np.argsort(pairs, kind="stable")
        pairs = pairs[order]
        times = np.concatenate(self.times)[order]
        positions = np.repeat(np.arange(self.documents), self.sizes)[order]
        first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        for start, end in zip(first.tolist(), [*first[1:].tolist(), len(pairs)], strict=True):
            yield int(pairs[start]), planes_of(positions[start:end], times[start:end], self.documents)


def _posting_batches(block: _Block, size: int = 20_000):
    pairs, planes = [], []

    def batch():
        n = len(pairs)
        columns = {
            "block": pa.array([block.number] * n, pa.int64()),
            "pair": pa.array(pairs, pa.int64()),
            "planes": pa.array(planes, pa.list_(pa.binary())),
            "kind": pa.array(["posting"] * n),
        }
        return pa.RecordBatch.from_arrays(
            [columns.get(f.name, pa.nulls(n, f.type)) for f in _SCHEMA], schema=_SCHEMA
        )

    for pair, found in block.rows():
        pairs.append(pair)
        planes.append(found)
        if len(pairs) >= size:
            yield batch()
            pairs, planes = [], []
    if pairs:
        yield batch()


def _index(spec, model, keep_groups: bool):
    def run(batches):
        key = ("alignment", zlib.crc32(spec.value), zlib.crc32(model.value))
        align = worker_local(key, lambda: Aligner(spec.value, model.value))
        base = TaskContext.get().partitionId() << 32
        block = _Block(base)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            out = []
            for k in range(batch.num_rows):
                found = align(texts[k].as_py())
                n_a, n_b, groups, pairs = found or (0, 0, "", {})
                row = {
                    "block": block.number,
                    "position": block.add(pairs),
                    "doc_id": ids[k].as_py(),
                    "n_a": n_a,
                    "n_b": n_b,
                    "n_links": sum(pairs.values()),
                    "groups_sha256": hashlib.sha256(groups.encode()).hexdigest() if found else "",
                    "kind": "document",
                }
                out.append(row | {"groups": groups} if keep_groups else row)
                if block.full():
                    yield from _posting_batches(block)
                    block = _Block(block.number + 1)
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_pylist(out, _SCHEMA)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, _SCHEMA)
        yield from _posting_batches(block)

    return run


def _count(batches):
    for batch in batches:
        counted = [count_bitmaps(planes.as_py()) for planes in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([c[0] for c in counted], pa.int64()),
                pa.array([c[1] for c in counted], pa.int64()),
            ],
            ["pair", "n_documents", "n_links"],
        )


def _scatter(batches):
    """Sums per document from postings with scores, sorted by block."""
    number, best, total = None, None, None

    def done():
        places = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(places), number, np.int64)),
                pa.array(places.astype(np.int32)),
                pa.array(best[places]),
                pa.array(total[places]),
            ],
            ["block", "position", "n_best", "count_sum"],
        )

    for batch in batches:
        blocks, counts, is_best = (batch.column(k).to_pylist() for k in (0, 2, 3))
        for block, planes, count, top in zip(blocks, batch.column(1), counts, is_best, strict=True):
            if block != number:
                if number is not None:
                    yield done()
                number = block
                best, total = (np.zeros(BLOCK_DOCUMENTS, np.int64) for _ in range(2))
            for k, plane in enumerate(planes.as_py()):
                places = unpack_bitmap(plane)
                total[places] += count << k
                if top:
                    best[places] += 1 << k
    if number is not None:
        yield done()


@dataclass
class Alignment:
    """``documents``: a row per input row. ``pairs``: ``a``, ``b``, ``n_documents``, ``n_links``,
    ``is_best`` (no other first id has more links with ``b``)."""

    documents: DataFrame
    pairs: DataFrame


def align_documents(
    docs: DataFrame,
    first: str,
    second: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_groups: bool = True,
) -> Alignment:
    """Align the tokens of a byte-level BPE file with those of a sentencepiece model.

    Both files are read on the driver (fixed size). The first encodes a blank and the
    text, the second the text (it puts the blank there itself), special tokens' strings
    as plain text. Per input row: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best`` (links of a pair that is its second id's most frequent, ties included),
    ``count_sum`` (over links, the pair's count in all documents), ``groups``
    (``a1,a2|b1;a3|b2``; left out unless ``keep_groups``) and ``groups_sha256``.

    Null and empty texts, and those whose tokens' bytes aren't the text's (``\u2581`` in
    it), have no tokens: zeros and empty texts. Repeated rows are documents each, ties
    are all best, other columns are ignored, an empty table gives an empty result.

    Texts are read once. A task packs the pairs of at most ``BLOCK_POSTINGS`` postings
    into bitmaps before anything is shuffled; a pair's counts are summed from one row per
    block, and a block's documents get their scores in one task, whose arrays hold 65 536
    numbers. A pair that most blocks hold is salted by ``lookup_join``.
    """
    spark = docs.sparkSession
    with open(first, "rb") as file:
        spec = spark.sparkContext.broadcast(file.read())
    with open(second, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())
    rows = whole_text(docs, id_col, text_col).mapInArrow(_index(spec, model, keep_groups), _DDL)
    written = materialise(rows, "alignment", "kind")
    documents = written.where("kind = 'document'")
    postings = written.where("kind = 'posting'").select("block", "pair", "planes")

    counts = postings.select("pair", "planes").mapInArrow(
        _count, "pair long, n_documents long, n_links long"
    )
    pairs = materialise(
        counts.groupBy("pair").agg(F.sum("n_documents").alias("n_documents"), F.sum("n_links").alias("n_links")),
        "alignment-pairs",
    )
    second_id = F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int")
    # a row per piece of the second vocabulary: at most its size
    most = pairs.groupBy(second_id.alias("b")).agg(F.max("n_links").alias("most"))
    pairs = (
        pairs.withColumn("b", second_id)
        .join(F.broadcast(most), "b")
        .select(
            "pair",
            F.shiftright("pair", 32).cast("int").alias("a"),
            "b",
            "n_documents",
            "n_links",
            (F.col("n_links") == F.col("most")).alias("is_best"),
        )
    )
    scored = lookup_join(postings, pairs.select("pair", "n_links", "is_best"), ["pair"])
    sums = (
        scored.select("block", "planes", "n_links", "is_best")
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_scatter, "block long, position int, n_best long, count_sum long")
    )
    result = documents.join(sums, ["block", "position"], "left").select(
        "doc_id",
        "n_a",
        "n_b",
        F.col("n_links").alias("n_groups"),
        "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        *(["groups"] if keep_groups else []),
        "groups_sha256",
    )
    return Alignment(result, pairs.drop("pair"))
