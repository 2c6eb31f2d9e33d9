"""Line deduplication by an exact set-similarity join.

A line is the set of its words. Two lines with Jaccard similarity of at least s share a
token among the rarest of each: of n tokens in one global order, the first
n - ceil(s n) + 1 (prefix filter). The order is by rarity, counted over all documents
in a sketch of fixed size; any global order is exact, a good one keeps groups small.
The shorter line of a pair (either of equals) shares one even among its first
n - ceil(2 s n / (1 + s)) + 1, so a token that lines hold only further back finds
nothing. Lines that share a prefix token are candidates if their sizes allow the
similarity (length filter), if enough tokens can still follow (positional filter) and
if their parity bitmaps don't differ in more bits than their sets may in tokens. What
is left is verified on the words themselves.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fresh_name, whole_text
from clickloom.llm.pretokens import release_worker
from clickloom.workspace import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Buckets of the rarity counts and of the filter of wanted lines. Fixed, whatever the input.
COUNT_BITS, LINE_BITS = 18, 23
#: Bytes of text that are hashed at once in a task.
CHUNK = 1 << 18
#: Earlier candidates of a line and token that go to the first verification.
FIRST_WITNESSES = 3
#: The bitmaps tell little about lines of so many words; more of their candidates go there.
LONG_LINE, LONG_WITNESSES = 200, 64
#: Lines of a token that are compared with one another at once.
BLOCK = 512
#: A token that more distinct lines hold among their rarest is compared in several tasks.
HOT_ROWS = 1024

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# A fixed random value for each byte, nothing for white space, and an odd base for the positions' powers.
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[_SPACE] = 0
_BASE = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** 0, 1, ..., n - 1 modulo 2 ** 64, and their inverses; the longest are kept."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(max(n, 2 * CHUNK), base, np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors)
    return _powers[0][:n], _powers[1][:n]


def hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word in UTF-8 bytes; words end at ASCII white space.

    A word's hash is a polynomial of its bytes. Powers run over the whole text and each
    word's sum is brought down to its own start by the inverse power.
    """
    space = np.concatenate([[True], _SPACE[data], [True]])
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts = edges[::2]
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    up, down = powers(len(data))
    values = _BYTE[data]
    values *= up
    return starts, _mix(np.add.reduceat(values, starts) * down[starts])


def _texts(batch: pa.RecordBatch):
    """(ids, bytes, ends of documents) in chunks of about ``CHUNK`` bytes, documents whole."""
    ids, texts = batch.column(0), batch.column(1)
    rows, held = [], 0
    for k in range(batch.num_rows):
        raw = texts[k].as_buffer() if hasattr(texts[k], "as_buffer") else texts[k].as_py().encode()
        rows.append((ids[k].as_py(), raw))
        held += len(raw)
        if held >= CHUNK:
            yield rows
            rows, held = [], 0
    if rows:
        yield rows


def _joined(rows) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of documents, each followed by a line's end, and where they start."""
    data = np.frombuffer(b"\n".join([*(bytes(r[1]) for r in rows), b""]), np.uint8)
    lengths = np.array([len(r[1]) + 1 for r in rows])
    return data, np.cumsum(lengths) - lengths


def _count_tokens(batches):
    release_worker()
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    held = []
    for batch in batches:
        for rows in _texts(batch):
            hashes = hash_words(_joined(rows)[0])[1]
            held.append((hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64))
            if sum(map(len, held)) > 1 << 20:
                counts += np.bincount(np.concatenate(held), minlength=len(counts))
                held = []
    if held:
        counts += np.bincount(np.concatenate(held), minlength=len(counts))
    used = np.flatnonzero(counts)
    for k in range(0, len(used), 1 << 16):
        at = used[k : k + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(counts[at])], ["bucket", "n"]
        )


def rarity(docs: DataFrame) -> np.ndarray:
    """How often the tokens of each hash bucket occur in all documents, as a rank class.

    At most 2 ** ``COUNT_BITS`` sums come to the driver, and as many from a task, so there
    are but a few tasks for each core.
    """
    sums = (
        docs.coalesce(2 * docs.sparkSession.sparkContext.defaultParallelism)
        .mapInArrow(_count_tokens, "bucket int, n long").groupBy("bucket").agg(F.sum("n"))
    ).toArrow()
    counts = np.zeros(1 << COUNT_BITS, np.float64)
    counts[sums.column(0).to_numpy()] = sums.column(1).to_numpy()
    # 16 classes for each doubling, so that they fit ten bits up to any count
    return np.minimum(np.round(16 * np.log2(counts + 1)), 1023).astype(np.uint16)


_LINES = "doc_id long, line int, set long, set2 long, n int, even long, odd long, prefix array<long>"


def index_length(n: np.ndarray, threshold: float) -> np.ndarray:
    """Of n tokens in order, how many may hold the one shared with a line at least as long."""
    return n - np.ceil(2 * threshold / (1 + threshold) * n - 1e-9).astype(np.int64) + 1


def _line_sets(classes, threshold: float):
    def run(batches):
        for batch in batches:
            for rows in _texts(batch):
                yield from _sets_of(rows, classes.value, threshold)

    return run


def _sets_of(rows, classes: np.ndarray, threshold: float):
    data, doc_starts = _joined(rows)
    starts, hashes = hash_words(data)
    if not len(starts):
        return
    breaks = np.flatnonzero(data == 10)
    line = np.searchsorted(breaks, starts)
    rank = classes[(hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
    order = np.lexsort((hashes, rank, line)) if len(breaks) >= 1 << 22 else _order(line, rank, hashes)
    line, hashes, rank_of = line[order], hashes[order], rank[order]
    fresh = np.ones(len(line), bool)
    fresh[1:] = (line[1:] != line[:-1]) | (hashes[1:] != hashes[:-1])
    line, hashes, rank_of = line[fresh], hashes[fresh], rank_of[fresh]
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    n = np.diff(np.append(first, len(line)))
    # two sums: of 64 bits alone some of 10 ** 11 lines would agree by chance
    sets, sets2 = (
        _mix(np.add.reduceat(_mix(hashes * odd + np.uint64(_BASE)), first)).view(np.int64)
        for odd in (np.uint64(1), np.uint64(0xD6E8FEB86659FD93))
    )
    parity = [
        np.bitwise_xor.reduceat(
            (hashes >> np.uint64(6) & np.uint64(1) == half)
            * (np.uint64(1) << (hashes & np.uint64(63))),
            first,
        ).view(np.int64)
        for half in (0, 1)
    ]
    length = n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
    numbers = line[first]
    doc = np.searchsorted(doc_starts, np.concatenate([[0], breaks + 1])[numbers], "right") - 1
    lines_before = np.searchsorted(breaks, doc_starts)
    at = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(length.sum())
    # the lower half of the hash names a prefix token; a clash only adds candidates. Above it
    # stands how often its bucket was counted, as a rank class
    prefix = (hashes[at] & np.uint64(0xFFFFFFFF)) | rank_of[at].astype(np.uint64) << np.uint64(32)
    prefix = prefix.view(np.int64)
    ids = pa.array([r[0] for r in rows], pa.int64()).take(pa.array(doc))
    yield pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array((numbers - lines_before[doc]).astype(np.int32)),
            pa.array(sets),
            pa.array(sets2),
            pa.array(n.astype(np.int32)),
            pa.array(parity[0]),
            pa.array(parity[1]),
            pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(prefix)
            ),
        ],
        ["doc_id", "line", "set", "set2", "n", "even", "odd", "prefix"],
    )


def _order(line: np.ndarray, rank: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Order by line, rarity, hash: one sort of packed keys, mended where their bits run out."""
    key = (line.astype(np.uint64) << np.uint64(42)) | (rank.astype(np.uint64) << np.uint64(32))
    key |= hashes >> np.uint64(32)
    order = np.argsort(key)
    same = np.flatnonzero((key[order][1:] == key[order][:-1]) & (hashes[order][1:] != hashes[order][:-1]))
    if len(same):
        return np.lexsort((hashes, rank, line))
    return order


def _similar(n_a, n_b, differing, threshold: float):
    """Whether sets may be similar, from their sizes and the bits in which they differ."""
    total = n_a + n_b
    # J >= s holds iff the symmetric difference is at most (1 - s) / (1 + s) of the sizes' sum
    return differing <= (1 - threshold) / (1 + threshold) * total + 1e-9


_CANDIDATES = "doc_id long, line int, other_id long, other_line int, more boolean, most int"


def _limits(n: np.ndarray, most: int | None) -> np.ndarray:
    """How many witnesses each line asks for at first."""
    if most is None:
        return np.full(len(n), (1 << 31) - 1)
    return np.where(n >= LONG_LINE, max(most, LONG_WITNESSES), most)


def _possible(a, b, n, pos, part, parity, threshold: float) -> np.ndarray:
    """Which pairs of rows (index arrays that fit together) the filters leave."""
    na, nb, pa_, pb = n[a], n[b], pos[a], pos[b]
    total = na + nb
    ok = np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9
    # the shorter line's token must be among its first few; equally long ones' both
    ok &= (na > nb) | (pa_ < index_length(na, threshold))
    ok &= (nb > na) | (pb < index_length(nb, threshold))
    ok &= np.minimum(na - pa_, nb - pb) + np.minimum(pa_, pb) >= (
        threshold / (1 + threshold) * total - 1e-9
    )
    # rows of two parts that were dealt out together meet, a part's own elsewhere
    ok &= (part[a] == 0) | (part[a] != part[b])
    return ok & _similar(na, nb, sum(np.bitwise_count(p[a] ^ p[b]) for p in parity), threshold)


def _candidates(threshold: float, most: int | None):
    """Earlier lines that may be similar, from rows sorted by key.

    Rows: key, ``doc_id``, line and part (0: whole group) in one number, size, position and
    whether the line asks in another, and the two parity bitmaps.

    For each line that asks, the ``most`` earliest (all, if None) and whether there are
    more. Groups are compared block by block.
    """

    def compare(group):
        """Block of lines against earlier block; one row of a pair has its token far in front."""
        _, ids, lines, asks, n, pos, part, *parity = group
        in_front = pos < index_length(n, threshold)
        front, back = np.flatnonzero(in_front), np.flatnonzero(~in_front)
        for b0 in range(0, len(ids), BLOCK):
            mine = b0 + np.flatnonzero(asks[b0 : b0 + BLOCK])
            found, limit = np.zeros(len(mine), np.int64), _limits(n[mine], most)
            for others, all_mine in ((front, True), (back, False)):
                others = others[: np.searchsorted(others, b0 + BLOCK)]
                for a0 in range(0, len(others), BLOCK):
                    theirs = others[a0 : a0 + BLOCK]
                    use = np.flatnonzero((found < limit) & (all_mine | in_front[mine]))
                    if not len(use):
                        break
                    b = mine[use]
                    ok = theirs[None, :] < b[:, None]
                    ok &= _possible(theirs[None, :], b[:, None], n, pos, part, parity, threshold)
                    i, j = np.nonzero(ok)
                    if len(i):
                        at = use[i]
                        place = np.arange(len(i)) - np.searchsorted(i, i) + found[at]
                        keep = place < limit[at]
                        more = np.zeros(len(mine), bool)
                        more[at[place >= limit[at] - 1]] = True
                        found += np.bincount(at, minlength=len(mine))
                        left, right = mine[at[keep]], theirs[j[keep]]
                        yield ids[left], lines[left], ids[right], lines[right], more[at[keep]], limit[at[keep]]

    def run(batches):
        held = []
        for batch in batches:
            key, ids, spot, meta, even, odd = (
                batch.column(k).to_numpy(zero_copy_only=False) for k in range(6)
            )
            columns = [
                key,
                ids,
                (spot >> 32).astype(np.int32),
                (meta & 1).astype(bool),
                meta >> 32,
                meta >> 1 & 0x7FFFFFFF,
                (spot & 0xFFFFFFFF).astype(np.int32),
                even.view(np.uint64),
                odd.view(np.uint64),
            ]
            last = int(np.searchsorted(columns[0], columns[0][-1]))
            if last and held:
                yield from emit([*held, [c[:last] for c in columns]])
                held = []
            elif last:
                yield from emit([[c[:last] for c in columns]])
            elif held and held[-1][0][-1] != columns[0][0]:
                yield from emit(held)
                held = []
            held.append([c[last:] for c in columns])
        if held:
            yield from emit(held)

    def emit(parts):
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        tokens = columns[0]
        edges = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1], [True]]))
        # a token of one line finds nothing; the others' lines are put in order
        shared = np.flatnonzero(np.repeat(np.diff(edges) > 1, np.diff(edges)))
        order = shared[np.lexsort((columns[2][shared], columns[1][shared], tokens[shared]))]
        columns = [c[order] for c in columns]
        tokens = columns[0]
        if not len(tokens):
            return
        edges = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1], [True]]))
        sizes = np.diff(edges)
        out = [[] for _ in range(6)]
        # small groups together: every row against the one k places before it
        small = np.flatnonzero((sizes > 1) & (sizes <= 64))
        if len(small):
            yield from _small(columns, edges, sizes, small, threshold, most)
        for g in np.flatnonzero(sizes > 64):
            for part in compare([c[edges[g] : edges[g + 1]] for c in columns]):
                for o, p in zip(out, part, strict=True):
                    o.append(p)
                if sum(map(len, out[0])) > 1 << 16:
                    yield _batch(out)
                    out = [[] for _ in range(6)]
        if out[0]:
            yield _batch(out)

    return run


def _small(columns, edges, sizes, chosen, threshold: float, most: int | None):
    """Candidates within small groups, for all of them at once, nearest to the first row first.

    The filters go one after the other, each on what the one before it left.
    """
    _, ids, lines, asks, n, pos, part, *parity = columns
    size = sizes[chosen]
    first = np.repeat(edges[chosen], size)
    at = first + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    front = pos < index_length(n, threshold)
    asks, some_parts = asks[at], part.any()
    found, limit = np.zeros(len(at), np.int64), _limits(n[at], most)
    out = [[] for _ in range(6)]
    left = np.arange(len(at))
    for k in range(int(size.max()) - 1):
        # rows that have earlier ones left, and ask for more
        left = left[(first[left] + k < at[left]) & asks[left] & (found[left] < limit[left])]
        a, b = first[left] + k, at[left]
        na, nb = n[a], n[b]
        ok = (front[a] | (na > nb)) & (front[b] | (nb > na))
        ok &= np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9
        use, a, b = left[ok], a[ok], b[ok]
        na, nb, pa_, pb = n[a], n[b], pos[a], pos[b]
        ok = np.minimum(na - pa_, nb - pb) + np.minimum(pa_, pb) >= (
            threshold / (1 + threshold) * (na + nb) - 1e-9
        )
        if some_parts:
            ok &= (part[a] == 0) | (part[a] != part[b])
        ok &= _similar(na, nb, sum(np.bitwise_count(p[a] ^ p[b]) for p in parity), threshold)
        use, a, b = use[ok], a[ok], b[ok]
        found[use] += 1
        for o, values in zip(out, (ids[b], lines[b], ids[a], lines[a]), strict=False):
            o.append(values)
        out[4].append(found[use] >= limit[use])
        out[5].append(limit[use])
    if sum(map(len, out[0])):
        yield _batch(out)


def _batch(out) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(o)) for o in out[:5]] + [pa.array(np.concatenate(out[5]).astype(np.int32))],
        ["doc_id", "line", "other_id", "other_line", "more", "most"],
    )


def _verify(threshold: float):
    """Places of lines whose words reach the similarity with the other line's."""

    def run(batches):
        for batch in batches:
            columns = [batch.column(k) for k in (2, 3)]
            keep = []
            for one, other in zip(*columns, strict=True):
                a, b = (set(x.as_py().encode().split()) for x in (one, other))
                keep.append(len(a & b) * (1 + threshold) >= threshold * (len(a) + len(b)) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _among(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """``rows`` but for most of those whose key isn't wanted, without a shuffle of them.

    A filter of 2 ** ``LINE_BITS`` bits is broadcast, whatever the number of keys.
    """
    place = lambda c: F.pmod(c, F.lit(1 << LINE_BITS)).cast("int")
    bits = (
        wanted.select(place(wanted_key).alias("p"))
        .groupBy(F.expr("p div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, p % 64)")).alias("mask"))
    )
    return (
        rows.withColumn("p", place(key))
        .withColumn("word", F.expr("p div 64"))
        .join(F.broadcast(bits), "word")
        .filter(F.expr("shiftright(mask, p % 64) & 1 = 1"))
        .drop("p", "word", "mask")
    )


_PLACE = ["doc_id", "line"]
_OTHER = ["other_id", "other_line"]


def _line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``content`` of the wanted lines (doc_id, line)."""
    key = F.xxhash64(*_PLACE)
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    return _among(lines, key, wanted, key).join(wanted, _PLACE)


def _verified(docs: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The lines of the pairs whose words reach the similarity with the other's."""
    others = [F.col(o).alias(p) for o, p in zip(_OTHER, _PLACE, strict=True)]
    wanted = pairs.select(*_PLACE).unionByName(pairs.select(*others)).distinct()
    texts = materialise(_line_texts(docs, wanted).dropDuplicates(_PLACE), "line_texts")
    other = texts.select(
        *[F.col(p).alias(o) for o, p in zip(_OTHER, _PLACE, strict=True)],
        F.col("content").alias("other"),
    )
    return (
        pairs.join(texts, _PLACE)
        .join(other, _OTHER)
        .select(*_PLACE, "content", "other")
        .mapInArrow(_verify(threshold), "doc_id long, line int")
        .distinct()
    )


def _hot_tokens(sets: DataFrame) -> DataFrame:
    """Tokens that more than ``HOT_ROWS`` distinct lines hold in their prefix, and how many.

    Counted are only tokens that come so often at all.
    """
    least = int(16 * np.log2(HOT_ROWS))
    often = sets.select(
        F.explode(F.filter("prefix", lambda t: F.shiftright(t, 32) >= least)).alias("ranked")
    )
    return (
        often.groupBy(_token(F.col("ranked")).alias("token"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > HOT_ROWS)
    )


def _token(ranked: Column) -> Column:
    return ranked.bitwiseAND(0xFFFFFFFF)


def _dealt(rows: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Rows with the ``key`` under which they meet, and their ``part`` there (0: no parts).

    The lines of a hot token fall into parts by their place; every two parts meet under a
    key of their own, and each part once alone. Parts grow with the square root of the
    token's lines, so that both a task's rows and a line's copies stay few.
    """
    if hot is None:
        return rows.withColumn("key", F.col("token")).withColumn("part", F.lit(0).cast("long"))
    parts = F.ceil(F.sqrt("rows") / 11)
    own = F.pmod(F.xxhash64(*_PLACE), parts)
    met = F.when(F.col("rows").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), parts - 1)
    )
    met_rows = rows.join(hot, "token", "left").withColumn("own", own).withColumn("other", F.explode(met))
    alone = F.col("other") == -1
    key = F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other"))
    part = F.when(alone | (F.col("own") == F.col("other")), 0).otherwise(F.col("own") + 1)
    return met_rows.withColumn("key", F.when(alone, F.col("token")).otherwise(key)).withColumn(
        "part", part.cast("long")
    )


def removed_lines(
    docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id`` and ``line`` (from 0) of every line that matches an earlier one.

    Lines are cut at ``\\n``; a line is the set of its words (white space apart), earlier
    is by ``doc_id``, then line. A line goes if any earlier line, itself removed or not,
    has a Jaccard similarity of at least ``threshold`` with it; of equal sets the first
    stays, unless it matches another. Lines without a word match nothing. Null and empty
    texts have no lines; repeated rows of a document are one document; rows without
    ``doc_id`` take no part; other columns are ignored; an empty table removes nothing.

    Equal sets collapse before the join, by two 64-bit sums over their words' hashes, so a
    line that a third of all documents share costs one row per task. Of each line's
    candidates the earliest few are verified first; only lines that none of these removes
    are compared with all the rest. Tokens of very many lines are dealt out (``_dealt``).
    """
    plain = whole_text(docs, id_col, text_col).filter("doc_id IS NOT NULL")
    classes = docs.sparkSession.sparkContext.broadcast(rarity(plain.select("doc_id", "text")))
    lines = materialise(plain.mapInArrow(_line_sets(classes, threshold), _LINES), "lines")
    firsts = materialise(
        lines.groupBy("set", "set2")
        .agg(F.min(F.struct("doc_id", "line", "n", "even", "odd", "prefix")).alias("f"))
        .select("set", "set2", "f.*"),
        "line_sets",
    )
    hot = materialise(_hot_tokens(firsts), "hot_tokens")
    hot = None if hot.isEmpty() else hot

    def candidates(most: int | None, asking: DataFrame | None = None) -> DataFrame:
        sets = firsts.withColumn("asks", F.lit(True))
        if asking is not None:
            sets = firsts.join(asking.withColumn("asks", F.lit(True)), _PLACE, "left").fillna(
                False, ["asks"]
            )
        rows = sets.select(
            F.posexplode("prefix").alias("pos", "ranked"), *_PLACE, "asks", "n", "even", "odd"
        ).withColumn("token", _token(F.col("ranked")))
        if asking is not None:
            tokens = firsts.join(asking, _PLACE, "left_semi").select(
                F.explode(F.transform("prefix", _token)).alias("t")
            )
            rows = _among(rows, F.xxhash64("token"), tokens, F.xxhash64("t"))
        long = lambda c: F.col(c).cast("long")
        spot = F.shiftleft(long("line"), 32).bitwiseOR(F.col("part"))
        meta = F.shiftleft(long("n"), 32).bitwiseOR(F.shiftleft(long("pos"), 1)).bitwiseOR(long("asks"))
        found = (
            _dealt(rows, hot)
            .select("key", "doc_id", spot.alias("spot"), meta.alias("meta"), "even", "odd")
            .repartition("key")
            .sortWithinPartitions("key")
            .mapInArrow(_candidates(threshold, most), _CANDIDATES)
        )
        if most is None:
            return found.select(*_PLACE, *_OTHER).distinct()
        # each token names its earliest; the earliest of all are kept
        others = F.array_sort(F.collect_set(F.struct(*_OTHER)))
        by_line = found.groupBy(*_PLACE).agg(
            others.alias("others"), F.max("more").alias("more"), F.max("most").alias("most")
        )
        return by_line.select(
            *_PLACE,
            F.explode(F.slice("others", F.lit(1), F.col("most"))).alias("other"),
            (F.col("more") | (F.size("others") > F.col("most"))).alias("more"),
        ).select(*_PLACE, "other.*", "more")

    pairs = materialise(candidates(FIRST_WITNESSES), "line_pairs")
    matched = materialise(_verified(plain, pairs, threshold), "matched")
    asking = pairs.filter("more").select(*_PLACE).distinct().join(matched, _PLACE, "left_anti")
    asking = materialise(asking, "asking")
    if not asking.isEmpty():
        rest = materialise(candidates(None, asking), "line_pairs")
        matched = matched.unionByName(_verified(plain, rest, threshold))
    # of each set all but the first line go, and the firsts that match another; one of the two
    # hashes tells apart the texts of a repeated id
    line = [*_PLACE, "set"]
    held = firsts.select(*line).join(matched, _PLACE, "left_anti")
    return lines.select(*line).join(held, line, "left_anti").select(*_PLACE).distinct()


def _without(text_at: int, count_at: int | None, names: list[str]):
    """Rows without the lines whose numbers stand in the last column."""

    def run(batches):
        for batch in batches:
            texts, gone = batch.column(text_at), batch.column(batch.num_columns - 1)
            new, keep = texts.to_pylist(), np.ones(batch.num_rows, bool)
            changed = np.flatnonzero(gone.is_valid().to_numpy(zero_copy_only=False)).tolist()
            for k in changed:
                numbers = set(gone[k].as_py())
                new[k] = "\n".join(x for i, x in enumerate(new[k].split("\n")) if i not in numbers)
                keep[k] = bool(new[k].strip(" \t\n\x0b\x0c\r"))
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            columns[text_at] = pa.array(new, texts.type)
            if count_at is not None:
                counts = columns[count_at].to_pylist()
                for k in changed:
                    counts[k] = len(new[k])
                columns[count_at] = pa.array(counts, columns[count_at].type)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    return run


def drop_removed_lines(docs: DataFrame, threshold: float = 0.8, text_col: str = "text") -> DataFrame:
    """``docs`` without the lines of ``removed_lines``; ``n_chars`` follows, if there.

    All columns stay, whatever their names. Each row is a document of its own, earlier is
    by place in ``docs``: rows that repeat an id, or have none, lose only their own lines,
    and of repeated rows the first keeps them. A document that loses every line with a
    word goes; one that had none stays as it is, null and empty texts included. An empty
    table stays empty. ``docs`` must be a scan or a narrow plan over one, so that a repeated
    task numbers its rows alike.
    """
    row, gone = fresh_name(docs, "_row"), fresh_name(docs, "_gone")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    found = (
        removed_lines(numbered, threshold, row, text_col)
        .groupBy(F.col("doc_id").alias(row))
        .agg(F.collect_list("line").alias(gone))
    )
    names = docs.columns
    count_at = names.index("n_chars") if "n_chars" in names else None
    return (
        numbered.join(found, row, "left")
        .select(*[f"`{c}`" for c in names], gone)
        .mapInArrow(_without(names.index(text_col), count_at, names), docs.schema)
    )
