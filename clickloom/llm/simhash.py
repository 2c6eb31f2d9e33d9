"""Near-duplicates by SimHash, joined through Golay-code fuzzy keys.

Two fingerprints that differ in at most k bits agree, cut into k + 1 or more segments
on a ring, in some segment fully while the next one differs in at most one bit: were
every equal segment followed by one with two or more differences, there would be more
than k in all. So a key is an equal segment with a fuzzy index of the next. The fuzzy
index comes from the perfect binary Golay code of length 23: every vector lies within
distance 3 of exactly one codeword. A vector at distance 3 also takes the five
codewords at distance 4, and then any two vectors that differ in one bit share one.
"""

from __future__ import annotations

import functools
import itertools
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fresh_name, map_rows, whole_text
from clickloom.llm.components import connected
from clickloom.llm.pretokens import release_worker
from clickloom.workspace import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Generator polynomial of the binary Golay code.
GENERATOR = 0b101011100011
#: Fingerprints of a key that are compared in pairs; larger keys go through shared neighbours.
PAIRWISE = 16


def fingerprint(text: str, shingle: int) -> int:
    """SimHash of a text's word shingles, hashed by XXH64 with seed 42."""
    words = text.encode().lower().split()
    if not words:
        return 0
    runs = zip(*(words[k:] for k in range(shingle)), strict=False)
    shingles = [b" ".join(words)] if len(words) < shingle else map(b" ".join, runs)
    hashes = np.fromiter(
        map(functools.partial(xxhash.xxh64_intdigest, seed=42), shingles), "<u8"
    )
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):  # bounded, for very long texts
        part = hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).nonzero()[0].tolist()
    return sum(1 << b for b in bits)


def syndromes(vectors: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit vectors modulo the generator."""
    rest = vectors.astype(np.uint64)
    for bit in range(22, 10, -1):
        hit = (rest >> np.uint64(bit) & np.uint64(1)).astype(bool)
        rest = np.where(hit, rest ^ np.uint64(GENERATOR << (bit - 11)), rest)
    return rest


def _nearby() -> np.ndarray:
    """For each syndrome six error patterns that lead to near codewords, the nearest first.

    Where the nearest is at distance 2 or less, it stands six times.
    """
    patterns = [
        np.array([sum(1 << b for b in c) for c in itertools.combinations(range(23), w)], np.uint64)
        for w in range(5)
    ]
    table = np.zeros((2048, 6), np.uint64)
    for weight in range(4):
        table[syndromes(patterns[weight]).astype(int)] = patterns[weight][:, None]
    fours = syndromes(patterns[4]).astype(int)
    order = np.argsort(fours, kind="stable")
    at = np.arange(len(order)) - np.searchsorted(fours[order], fours[order])
    is_three = np.zeros(2048, bool)
    is_three[syndromes(patterns[3]).astype(int)] = True
    keep = is_three[fours[order]]
    table[fours[order][keep], at[keep] + 1] = patterns[4][order][keep]
    return table


def fuzzy_keys(prints: np.ndarray, distance: int) -> np.ndarray:
    """Keys of each fingerprint (rows, with repeats): similar ones share at least one."""
    parts = max(3, distance + 1)
    bounds = [64 * k // parts for k in range(parts + 1)]
    segment = [
        prints >> np.uint64(a) & np.uint64((1 << (b - a)) - 1)
        for a, b in itertools.pairwise(bounds)
    ]
    table, keys = _nearby(), []
    for k in range(parts):
        near = segment[(k + 1) % parts]
        codewords = near[:, None] ^ table[syndromes(near).astype(int)]
        index = codewords >> np.uint64(11)  # the code is systematic: these bits tell it
        keys.append(
            (np.uint64(k) << np.uint64(40)) | (segment[k][:, None] << np.uint64(12)) | index
        )
    return np.concatenate(keys, axis=1)


def _keyed(distance: int):
    def run(batches):
        for batch in batches:
            prints = batch.column(0).to_numpy()
            keys = np.sort(fuzzy_keys(prints.view(np.uint64), distance), axis=1)
            fresh = np.ones(keys.shape, bool)
            fresh[:, 1:] = keys[:, 1:] != keys[:, :-1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[fresh].view(np.int64)),
                    pa.array(np.repeat(prints, fresh.sum(1))),
                ],
                ["key", "fp"],
            )

    return run


def _neighbour_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links among fingerprints through the values one bit away from them."""
    away = F.array(
        *[F.lit(0).cast("long")],
        *[F.shiftleft(F.lit(1).cast("long"), bit) for bit in range(64)],
    )
    near = prints.select("fp", F.explode(away).alias("bit")).select(
        F.col("fp").alias("u"), F.col("fp").bitwiseXOR(F.col("bit")).alias("near")
    )
    if distance == 1:
        near = near.filter("near <> u")
        return near.join(prints.select(F.col("fp").alias("near")), "near").select(
            "u", F.col("near").alias("v")
        )
    least = near.groupBy("near").agg(F.min("u").alias("v"), F.count("*").alias("n"))
    return near.join(least.filter("n > 1"), "near").select("u", "v").filter("u <> v")


def similar_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links (u, v) that join exactly what fingerprints within ``distance`` bits join.

    ``prints``: distinct longs ``fp``. Fingerprints of a key are compared in pairs and
    verified. A key with more than ``PAIRWISE`` of them emits no pairs: its fingerprints
    are linked through the values one bit away from them, since two fingerprints within
    two bits always share such a value (or one is the other's). Work is linear in the
    rows of such a key, and no link is lost.
    """
    keyed = prints.mapInArrow(_keyed(distance), "key long, fp long")
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = materialise(keyed.join(counts, "key"), "shared_keys")
    pairs = (
        shared.filter(F.col("n") <= PAIRWISE)
        .groupBy("key")
        .agg(F.collect_list("fp").alias("all"))
        .select("all", F.explode("all").alias("u"))
        .select("u", F.explode(F.filter("all", lambda v: _close(v, F.col("u"), distance))).alias("v"))
    )
    many = shared.filter(F.col("n") > PAIRWISE).select("fp").distinct()
    return pairs.unionByName(_neighbour_links(many, distance))


def _close(v, u, distance: int):
    return (v > u) & (F.bit_count(u.bitwiseXOR(v)) <= distance)


def simhash_groups(
    docs: DataFrame,
    shingle: int = 3,
    distance: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Fingerprints of whole texts, linked where they differ in at most ``distance`` (0 to
    2) bits; ``component_id`` is the smallest ``doc_id`` that can be reached. Texts of
    fewer words than a shingle are one shingle. Null, empty and blank texts have
    fingerprint 0, linked like any other. Repeated rows appear as often as they come; a
    null ``doc_id`` is kept but never names a component unless all of it are null; other
    columns are ignored; an empty table gives an empty result.

    Copies share one fingerprint, so only distinct fingerprints are keyed and linked.
    """
    if not 0 <= distance <= 2:
        raise ValueError("distance must be 0, 1 or 2")

    def rows(incoming):
        release_worker()
        for row in incoming:
            fp = fingerprint(row["text"], shingle)
            yield {"doc_id": row["doc_id"], "fp": fp - (fp >> 63 << 64)}

    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
    marked = materialise(
        whole_text(docs, id_col, text_col).mapInArrow(map_rows(schema, rows), "doc_id long, fp long"),
        "prints",
    )
    prints = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_prints")
    if distance:
        roots = connected(similar_links(prints.select("fp"), distance))
        rooted = prints.join(roots, prints.fp == roots.node, "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        )
        ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        labels = rooted.join(ids, "root").select("fp", "component_id")
    else:
        labels = prints.select("fp", F.col("least").alias("component_id"))
    return marked.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_unique(docs: DataFrame, shingle: int = 3, distance: int = 2, text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, the first in ``docs``, all columns as they are.

    Each row is a document of its own: ids may be null or repeat with other texts, and of
    repeated rows one stays. Null, empty and blank texts are one group. Columns may have any
    names; an empty table stays empty. ``docs`` must be a scan or a narrow plan over one, so
    that a repeated task numbers its rows alike.
    """
    row = fresh_name(docs, "_row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    kept = (
        simhash_groups(numbered, shingle, distance, row, text_col)
        .filter("doc_id = component_id")
        .select(F.col("doc_id").alias(row))
    )
    return numbered.join(kept, row, "left_semi").select(*[f"`{c}`" for c in docs.columns])
