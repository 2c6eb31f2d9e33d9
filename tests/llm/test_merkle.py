"""Merkle manifest against a plain fold over lists; the given tables are met by the SQL twin."""

import hashlib
import zlib

import pytest

from clickloom.llm.merkle import build_manifest, fold, proofs, sibling_index, verify_documents
from pyspark.sql import functions as F

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, arity=16):
    """Levels of a tree, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        n = levels[-1]
        levels.append([sha("".join(n[i : i + arity])) for i in range(0, len(n), arity)])
    return levels


def path(levels, index, arity=16):
    steps = []
    for nodes in levels[:-1]:
        run = index - index % arity
        steps.append(("".join(nodes[run:index]), "".join(nodes[index + 1 : run + arity])))
        index //= arity
    return steps


def brute_force(rows):
    def leaf_of(r, text):
        return sha("".join(map(part, (*r[:4], text))))

    def lowered(text):
        return text and "".join(c.lower() if c.isascii() else c for c in text)

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(r, r[4]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [sorted(groups[s], key=lambda x: x[:3]) for s in order]
    levels = [climb([x[2] for x in t]) for t in trees]
    top = climb([lv[-1][0] for lv in levels])
    out = []
    for k, tree in enumerate(trees):
        for i, (_, _, leaf, r) in enumerate(tree):
            steps = path(levels[k], i) + path(top, k)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            own = leaf_of(r, lowered(r[4])) if changed else leaf
            for left, right in steps:
                own = sha(left + own + right)
            proof = sha("".join(a + b for a, b in steps))
            out.append((r[0], leaf, levels[k][-1][0], top[-1][0], proof, own, own == top[-1][0]))
    return out


def result(df):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def rows_of(n, sources):
    rows = [(k * 7 % (2 * n), sources[k % len(sources)] if k % 3 else sources[0], "en", k, f"Text {k} É") for k in range(n)]
    rows += [rows[0], rows[0], (None, None, None, None, None), (None, "", "", None, ""), (3, None, "x", 1, "A" * 200_000)]
    return [(*r, "clash", 1) for r in rows]


@pytest.mark.parametrize("n, sources", [(700, ["hot", "Z", "é", None, ""]), (40, [f"s{k}" for k in range(35)])])
def test_manifest_matches_brute_force(spark, n, sources):
    rows = rows_of(n, sources)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(verify_documents(docs)) == sorted(brute_force(rows), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 256, 257])
def test_tree_sizes(spark, n):
    rows = [(k, "s", "en", 1, f"Text {k}", None, 0) for k in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert result(verify_documents(docs)) == sorted(brute_force(rows), key=repr)


def test_binary_trees_fold_back(spark):
    rows = spark.range(13).select("id", F.lit("g").alias("g"))
    manifest = build_manifest(rows, F.col("g"), F.col("id"), [F.col("id")], arity=2)
    expected = climb([sha(part(k)) for k in range(13)], 2)
    assert manifest.root == expected[-1][0]
    assert proofs(manifest).where(fold(F.col("digest"), F.col("path")) != F.lit(manifest.root)).count() == 0


def test_sibling_indices(spark):
    for arity, index in ((2, 5), (16, 35), (3, 7)):
        got = spark.range(arity).select(sibling_index(F.lit(index).cast("long"), F.col("id"), arity).alias("s"))
        run = index - index % arity
        assert sorted(r.s for r in got.collect()) == list(range(run, run + arity))


def test_carried_names_may_not_clash(spark):
    with pytest.raises(ValueError):
        build_manifest(spark.range(1), F.lit("g"), F.col("id"), [F.col("id")], carry={"tree": F.lit(1)})
