"""Token alignment against whole-text encodings and dictionaries of counts."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from clickloom.llm import alignment
from clickloom.llm.alignment import align_documents, count_bitmaps, planes_of, unpack_bitmap
from clickloom.llm.packing import byte_characters

FIRST = public_tokenizers.path("byte_bpe_50k.json")
SECOND = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "The cat sat on the mat, didn't it?\nNext line  here.\n\n end ",
    "  two blanks first",
    "\nline first",
    "<|endoftext|> <s> </s> <unk> <0x0A>",
    "Straße naïve 東京 都 \U0001f600  x\x1cy \t z",
    "▁ marks",
    " ",
    "x",
    "a\x00b",
    "the the the the the the the",
    None,
    "",
    "word " * 30_000,
    "unbroken" * 3_000,
]


def brute_force(texts):
    a = Tokenizer.from_file(FIRST)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=SECOND)
    to_byte = {c: x for x, c in byte_characters().items()}
    rows, links_of = [], []
    for text in texts:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)])
            if b.is_byte(i)
            else b.id_to_piece(i).replace("▁", " ").encode()
            for i in ids_b
        ]
        raw = (" " + text).encode() if text else b""
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw or not raw:
            rows.append((0, 0, 0, ""))
            links_of.append([])
            continue
        ends = [[sum(map(len, side[: k + 1])) for k in range(len(side))] if len(side) < 3000 else None
                for side in (bytes_a, bytes_b)]
        for k, side in enumerate((bytes_a, bytes_b)):
            if ends[k] is None:
                total, ends[k] = 0, []
                for token in side:
                    total += len(token)
                    ends[k].append(total)
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, before = [], 0
        for end in common:
            sides = [
                ",".join(str(i) for i, e in zip(ids, ends[k]) if before < e <= end) if len(common) < 3000 else ""
                for k, ids in enumerate((ids_a, ids_b))
            ]
            groups.append("|".join(sides))
            before = end
        where = [dict(zip(e, ids)) for e, ids in zip(ends, (ids_a, ids_b))]
        links_of.append([(where[0][e], where[1][e]) for e in common])
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if len(common) < 3000 else None
        rows.append((len(ids_a), len(ids_b), len(common), digest))
    counts = Counter(p for links in links_of for p in links)
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    documents = Counter(p for links in links_of for p in set(links))
    scored = [
        (*row[:3], sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), row[3])
        for row, links in zip(rows, links_of)
    ]
    return scored, counts, documents


@pytest.mark.parametrize("block_postings", [1 << 20, 20])
def test_alignment_matches_brute_force(spark, monkeypatch, block_postings):
    monkeypatch.setattr(alignment, "BLOCK_POSTINGS", block_postings)
    texts = TEXTS + TEXTS[:3]  # repeated rows count each
    docs = spark.createDataFrame(
        [(k % 14, t, "x", k) for k, t in enumerate(texts)], "doc_id long, text string, block string, pair int"
    ).repartition(3)
    result = align_documents(docs, FIRST, SECOND)
    expected, counts, documents = brute_force(texts)
    found = sorted((r.doc_id, r.n_a, r.n_b, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in result.documents.collect())
    wanted = sorted((k % 14, *row) for k, row in enumerate(expected))
    for mine, theirs in zip(found, wanted, strict=True):
        assert mine[:6] == theirs[:6]
        assert theirs[6] in (None, mine[6])
    pairs = {(r.a, r.b): (r.n_documents, r.n_links) for r in result.pairs.collect()}
    assert pairs == {p: (documents[p], n) for p, n in counts.items()}


def test_groups_are_their_digest(spark):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    row = align_documents(docs, FIRST, SECOND).documents.first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    assert row.groups.count(";") + 1 == row.n_groups == row.n_links


def test_no_documents_and_no_tokens(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align_documents(empty, FIRST, SECOND).documents.count() == 0
    nothing = spark.createDataFrame([(None, None), (2, "▁")], "doc_id long, text string")
    rows = align_documents(nothing, FIRST, SECOND).documents.collect()
    assert {(r.doc_id, r.n_a, r.n_b, r.n_links, r.count_sum, r.groups_sha256) for r in rows} == {
        (None, 0, 0, 0, 0, ""),
        (2, 0, 0, 0, 0, ""),
    }


def test_planes_hold_multiplicities():
    import numpy as np

    positions = np.array([0, 3, 9, 1000])
    times = np.array([1, 2, 7, 4])
    planes = planes_of(positions, times, 1001)
    assert [unpack_bitmap(p).tolist() for p in planes] == [[0, 9], [3, 9], [9, 1000]]
    assert count_bitmaps(planes) == (4, 14)
    dense = planes_of(np.arange(900), np.ones(900, int), 1000)
    assert len(dense[0]) == 126 and count_bitmaps(dense) == (900, 900)
