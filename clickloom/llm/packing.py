"""Pack documents into token windows by order-preserving dynamic programming.

Tokens are laid end to end in the order in which the rows are read. A window ends
at a document's end (free), at a sentence's end (small penalty) or inside a sentence
(larger penalty); a window that isn't full pays for its padding. The best cuts of a
block of tokens come from one pass with a monotone queue: among the cuts within
reach, the one with the least (cost so far + position) wins, and a cut that is
beaten by a later one never comes back. Windows whose length is a power of two need
no padding and are twelve more transitions.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from clickloom.llm.common import map_rows, whole_text
from clickloom.llm.pretokens import CachedIds, worker_local

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cost of a cut, in padding tokens: at a sentence's end, inside a sentence, for any window.
SENTENCE_CUT, INNER_CUT, ANY_WINDOW = 2.0, 24.0, 4.0
#: Distance of the cuts allowed inside a long sentence.
INNER_STEP = 64
#: Shortest unpadded window before a block's last ones.
SHORTEST = 32
#: Tokens that are laid out together. Bounds a task's memory; costs one short window each.
BLOCK_TOKENS = 1 << 21


def _sorted_places(total: int, *places) -> np.ndarray:
    """The distinct numbers of 0 to ``total`` in some arrays, ascending."""
    marked = np.zeros(total + 1, bool)
    for p in places:
        marked[p] = True
    return np.flatnonzero(marked)


def cut_positions(
    total: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """Where windows may end, and what that costs. Includes 0 and ``total``.

    Stretches without a natural cut get one every ``INNER_STEP`` tokens; the last
    window's stretch gets all of them, so that a block's rest splits into powers of two.
    """
    natural = _sorted_places(total, [0], doc_ends, sentence_ends, [total])
    gaps = np.diff(natural)
    long = np.flatnonzero(gaps > INNER_STEP)
    counts = (gaps[long] - 1) // INNER_STEP
    steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + 1
    inner = np.repeat(natural[long], counts) + steps * INNER_STEP
    tail = np.arange(max(0, total - window), total)
    positions = _sorted_places(total, natural, inner, tail)
    cost = np.full(len(positions), INNER_CUT)
    cost[np.searchsorted(positions, sentence_ends)] = SENTENCE_CUT
    cost[np.searchsorted(positions, doc_ends)] = 0.0
    cost[[0, -1]] = 0.0
    return positions, cost + ANY_WINDOW


def best_cuts(positions: np.ndarray, cost: np.ndarray, window: int) -> list[int]:
    """Indices of the positions that end a window, at least cost, ascending from 0's."""
    m = len(positions)
    # (position, where a window of a power of two before it starts); short ones only near
    # the end, where they split the rest
    ends, starts = [], []
    for k in range(window.bit_length()):
        late = 0 if 1 << k >= SHORTEST else int(np.searchsorted(positions, positions[-1] - window))
        wanted = positions[late:] - (1 << k)
        at = np.searchsorted(positions, wanted)
        hits = np.flatnonzero(positions[at] == wanted)
        ends.append(hits + late)
        starts.append(at[hits])
    end, start = np.concatenate(ends), np.concatenate(starts)
    exact = start[np.argsort(end, kind="stable")].tolist()
    first = np.concatenate([[0], np.cumsum(np.bincount(end, minlength=m))]).tolist()
    places, costs = positions.tolist(), cost.tolist()
    best, previous = [0.0] * m, [0] * m
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, m):
        here = places[j]
        while places[queue[0][1]] < here - window:
            queue.popleft()
        least, source = queue[0]
        least += window - here
        for i in exact[first[j] : first[j + 1]]:
            if best[i] < least:
                least, source = best[i], i
        least += costs[j]
        best[j], previous[j] = least, source
        key = least + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts = [m - 1]
    while cuts[-1]:
        cuts.append(previous[cuts[-1]])
    return cuts[::-1]


def _lay_out(parts, sentence_end, window, sequence, keep_ids):
    """Rows of a block's pieces, and the next sequence number."""
    ids = np.concatenate([p[3] for p in parts])
    lengths = np.array([len(p[3]) for p in parts])
    ends = np.cumsum(lengths)
    starts = ends - lengths
    sentences = np.flatnonzero(sentence_end[ids]) + 1
    positions, cost = cut_positions(len(ids), ends, sentences, window)
    windows = positions[best_cuts(positions, cost, window)]
    bounds = _sorted_places(len(ids), starts, windows)
    of_part = np.searchsorted(ends, bounds[:-1], "right").tolist()
    of_window = np.searchsorted(windows, bounds[:-1], "right") - 1
    offsets = (bounds[:-1] - windows[of_window]).tolist()
    raw, bounds = memoryview(ids.tobytes()), bounds.tolist()
    rows = []
    for k, (p, w) in enumerate(zip(of_part, of_window.tolist(), strict=True)):
        doc_id, doc_tokens, doc_start, _ = parts[p]
        begin, end = bounds[k], bounds[k + 1]
        piece = raw[4 * begin : 4 * end]
        row = {
            "doc_id": doc_id,
            "start": doc_start + begin - int(starts[p]),
            "length": end - begin,
            "ids_crc32": zlib.crc32(piece),
            "doc_tokens": doc_tokens,
            "sequence_id": sequence + w,
            "offset": offsets[k],
        }
        rows.append(row | {"ids": bytes(piece)} if keep_ids else row)
    return rows, sequence + len(windows) - 1


def sentence_ending(tokenizer: Tokenizer, end_id: int) -> np.ndarray:
    """Which ids end a sentence: a full stop or its kind before any closing mark, or a line's end."""
    size = max(tokenizer.get_vocab_size(), end_id + 1)
    ends = np.zeros(size, bool)
    for i in range(tokenizer.get_vocab_size()):
        text = tokenizer.decode([i], skip_special_tokens=False)
        ends[i] = "\n" in text or text.rstrip("\"')]»”’ ").endswith((".", "!", "?", "…", "。"))
    ends[end_id] = True
    return ends


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printing characters of Latin-1 stand for themselves, the other bytes in their order
    for the code points from 256 on.
    """
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printing]
    return {b: chr(b) for b in printing} | {b: chr(256 + k) for k, b in enumerate(others)}


class _Packer:
    """The tokenizer with its caches, and which ids end a sentence."""

    def __init__(self, spec: bytes, pattern: str, end_id: int):
        model = Tokenizer.from_buffer(spec)
        tokenize, characters = model.model.tokenize, byte_characters()
        ascii_characters = {b: c for b, c in characters.items() if b < 128}

        def encode(pretoken: str) -> list[int]:
            if pretoken.isascii():
                return [t.id for t in tokenize(pretoken.translate(ascii_characters))]
            return [t.id for t in tokenize("".join(map(characters.__getitem__, pretoken.encode())))]

        self._encode = CachedIds(encode, pattern)
        # tokens added to the vocabulary stand for their whole string, before the pattern counts
        added = {t["content"]: t for t in json.loads(spec)["added_tokens"]}
        if any(t[flag] for t in added.values() for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens with conditions on their surroundings")
        self._added = {c: t["id"].to_bytes(4, "little") for c, t in added.items()}
        longest_first = sorted(map(re.escape, added), key=len, reverse=True)
        self._split = re.compile(f"({'|'.join(longest_first)})").split if added else None
        self.sentence_end = sentence_ending(model, end_id)


    def encode(self, text: str) -> bytes:
        if self._split is None or not any(c in text for c in self._added):
            return self._encode(text)
        return b"".join([self._added.get(t) or self._encode(t) for t in self._split(text) if t])


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    pattern: str,
    window: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = True,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Pieces of documents placed in windows of ``window`` (a power of two) tokens.

    A document's ids are those of the byte-level BPE ``tokenizer`` file (read on the
    driver, fixed size) for each match of ``pattern``, and ``end_id``; strings of tokens that
    the file adds to its vocabulary become those tokens, as in the tokenizer as loaded. One row per piece: ``doc_id``, ``start`` (ids
    of its document before it), ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset`` (in its sequence, gapless from 0) and ``ids`` (binary,
    little-endian unsigned 32-bit; left out unless ``keep_ids``).

    One pass without a shuffle: each task lays out its own rows in their order, so a
    sequence never spans tasks; its number holds the task's. Null and empty texts have
    only ``end_id``; repeated rows are packed each; other columns are ignored; texts
    longer than a block go on in the next one; an empty table gives no piece. Among
    equally good cuts the earliest found stays, so results repeat.
    """
    if window & (window - 1) or window < 1:
        raise ValueError("window must be a power of two")
    with open(tokenizer, "rb") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    fields = [
        ("doc_id", pa.int64(), "long"),
        ("start", pa.int64(), "long"),
        ("length", pa.int64(), "long"),
        ("ids_crc32", pa.int64(), "long"),
        ("doc_tokens", pa.int64(), "long"),
        ("sequence_id", pa.int64(), "long"),
        ("offset", pa.int64(), "long"),
        ("ids", pa.binary(), "binary"),
    ][: 8 if keep_ids else 7]

    def rows(incoming):
        packer = worker_local(
            ("packing", zlib.crc32(spec.value), pattern, end_id),
            lambda: _Packer(spec.value, pattern, end_id),
        )
        encode, sentence_end = packer.encode, packer.sentence_end
        end = end_id.to_bytes(4, "little")
        sequence = TaskContext.get().partitionId() << 40
        parts, waiting = [], 0
        for row in incoming:
            ids = np.frombuffer(encode(row["text"]) + end, "<u4")
            for k in range(0, len(ids), block_tokens):
                part = ids[k : k + block_tokens]
                parts.append((row["doc_id"], len(ids), k, part))
                waiting += len(part)
                if waiting >= block_tokens:
                    done, sequence = _lay_out(parts, sentence_end, window, sequence, keep_ids)
                    parts, waiting = [], 0
                    yield from done
        if parts:
            yield from _lay_out(parts, sentence_end, window, sequence, keep_ids)[0]

    schema = pa.schema([(name, kind) for name, kind, _ in fields])
    ddl = ", ".join(f"`{name}` {kind}" for name, _, kind in fields)
    return whole_text(docs, id_col, text_col).mapInArrow(map_rows(schema, rows), ddl)
