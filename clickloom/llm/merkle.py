"""Merkle manifest of a table: one digest for all rows, and a proof for each.

Rows are leaves of one tree per group, the groups' roots are the leaves of one more
tree. Every level is two equijoins: a node in slot zero of its run computes the
indices of its siblings (XOR with 1 for binary trees, slot offsets otherwise) and
meets them in a self-join of the level; it then emits the parent, so that runs are
never looked for, only computed. Down again, a node's path is its parent's with the
node's own siblings before it. Paths meet the leaves once per run, not once per leaf.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.keys import with_dense_key
from clickloom.workspace import materialise

_STEP = "struct<`left`:string,`right`:string>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of texts or bytes put end to end."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as its UTF-8 length, a colon and its text; ``-`` for null. No two rows read alike."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def row_digest(values: Sequence[Column]) -> Column:
    """Digest of one row's values in their order."""
    return digest(*map(field, values))


def sibling_index(index: Column, offset: Column, arity: int) -> Column:
    """Index of the node ``offset`` slots on in the run of ``index``, around its end."""
    if arity == 2:
        return index.bitwiseXOR(offset)
    slot = F.pmod(index, F.lit(arity))
    return index - slot + F.pmod(slot + offset, F.lit(arity))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(path, leaf, lambda own, step: digest(step["left"], own, step["right"]))


def path_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(
        F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256
    )


@dataclass
class Manifest:
    """Leaves and levels as written tables, and the root (None for an empty table).

    ``leaves``: ``tree``, ``idx``, ``size`` (of the tree), ``digest`` and what was carried.
    ``levels`` and ``top``, one table per level: ``tree``, ``run``, ``members`` (digests of
    the run), ``digest`` and ``size`` (nodes that the tree has one level up).
    """

    leaves: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]
    roots: DataFrame
    root: str | None
    arity: int


def _numbered(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """Rows with ``tree`` (groups in order, null first), ``idx`` within it and its ``size``.

    Rows lie in ranges of (group, order, digest), so a group of any size is spread; what
    is counted is one row per range and group. Also the number of trees and the largest.
    """
    placed = materialise(
        rows.repartitionByRange("group", "order", "digest")
        .sortWithinPartitions("group", "order", "digest")
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", 33)),
        "merkle-placed",
    )
    stretches = placed.groupBy("_part", "group").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy("group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stretches.select(
        F.col("_part").alias("_p"),
        F.col("group").alias("_g"),
        (F.col("_first") - F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_zero"),
    )
    sizes = stretches.groupBy("group").agg(F.sum("_n").alias("size"))
    trees = with_dense_key(sizes, "tree", [F.col("group").asc_nulls_first()])
    trees = trees.select((F.col("tree") - 1).alias("tree"), F.col("group").alias("_group"), "size")
    starts = materialise(
        starts.join(trees, F.col("_g").eqNullSafe(F.col("_group"))).drop("_group"), "merkle-starts"
    )
    n_trees, largest = starts.agg(F.max("tree"), F.max("size")).first()
    numbered = (
        placed.join(starts, (F.col("_part") == F.col("_p")) & F.col("group").eqNullSafe(F.col("_g")))
        .withColumn("idx", F.col("_place") - F.col("_zero"))
        .drop("group", "order", "_place", "_part", "_p", "_g", "_zero")
    )
    return materialise(numbered, "merkle-leaves"), 0 if n_trees is None else n_trees + 1, largest or 0


def _climb(nodes: DataFrame, largest: int, arity: int) -> list[DataFrame]:
    """The levels above ``nodes`` (``tree``, ``idx``, ``digest``, ``size``), each written.

    ``largest``: most nodes that a tree has; it says how many levels there are.
    """
    levels = []
    while largest > 1:
        nodes = nodes.where("size > 1")
        offset = F.explode(F.sequence(F.lit(0), F.lit(arity - 1)))
        zero = nodes.where(F.pmod("idx", F.lit(arity)) == 0).select("tree", "idx", "size", offset.alias("offset"))
        asked = zero.select(
            "tree",
            "size",
            F.expr(f"idx div {arity}").alias("run"),
            sibling_index(F.col("idx"), F.col("offset").cast("long"), arity).alias("sibling"),
        ).where("sibling < size")
        found = asked.join(
            nodes.select("tree", F.col("idx").alias("sibling"), "digest"), ["tree", "sibling"]
        )
        runs = found.groupBy("tree", "run").agg(
            F.sort_array(F.collect_list(F.struct("sibling", "digest"))).alias("run_nodes"),
            F.expr(f"(any_value(size) + {arity - 1}) div {arity}").alias("size"),
        )
        members = F.transform("run_nodes", lambda n: n["digest"])
        parents = runs.select("tree", "run", members.alias("members"), "size").withColumn(
            "digest", F.sha2(F.concat_ws("", "members"), 256)
        )
        levels.append(materialise(parents, f"merkle-level-{len(levels) + 1}"))
        nodes = levels[-1].withColumnRenamed("run", "idx").drop("members")
        largest = -(-largest // arity)
    return levels


def build_manifest(
    rows: DataFrame,
    group: Column,
    order: Column,
    values: Sequence[Column],
    arity: int = 16,
    carry: dict[str, Column] | None = None,
) -> Manifest:
    """Digest every row over ``values``, every group in ``order``, and all groups' roots.

    While a tree has several nodes, each ``arity`` consecutive ones (the last run: fewer,
    even one) become the digest of their hex digests end to end. Groups come in order,
    null first, bytewise; within one, rows with a null order come first and equal ones
    go by their digest, so repeated rows change nothing but the count. ``carry``: columns
    to keep beside the leaves, under names that don't begin with an underscore and aren't
    the manifest's own.

    Texts are read and hashed once; from then on rows are as narrow as their digests.
    A level is a self-join on (tree, computed index), keys that no group makes hot.
    """
    carry = carry or {}
    clash = {"group", "order", "tree", "idx", "size", "digest"} & set(carry)
    if clash:
        raise ValueError(f"names that the manifest uses: {sorted(clash)}")
    digests = materialise(
        rows.select(
            group.alias("group"),
            order.alias("order"),
            row_digest(values).alias("digest"),
            *[column.alias(name) for name, column in carry.items()],
        ),
        "merkle-digests",
    )
    leaves, n_trees, largest = _numbered(digests)
    nodes = leaves.select("tree", "idx", "digest", "size")
    levels = _climb(nodes, largest, arity)
    roots = nodes.where("size = 1").select("tree", "digest")
    for level in levels:
        roots = roots.unionByName(level.where("size = 1").select("tree", "digest"))
    roots = materialise(roots, "merkle-roots")
    subroots = roots.select(
        F.lit(0).cast("long").alias("tree"),
        F.col("tree").alias("idx"),
        "digest",
        F.lit(n_trees).cast("long").alias("size"),
    )
    top = _climb(subroots, n_trees, arity)
    last = (top[-1] if top else roots).select("digest").first()
    return Manifest(leaves, levels, top, roots, last[0] if last else None, arity)


def _step(members: Column, slot: Column) -> Column:
    """A node's siblings: the digests before and after it in its run."""
    return F.struct(
        F.concat_ws("", F.slice(members, F.lit(1), slot)).alias("left"),
        F.concat_ws("", F.slice(members, slot + 2, F.size(members))).alias("right"),
    )


def _below(runs: DataFrame, above: DataFrame, arity: int) -> DataFrame:
    """Paths of a level's nodes (``tree``, ``idx``, ``path``, rest) from those of their parents."""
    joined = runs.select("tree", "run", "members").join(
        above.withColumnRenamed("idx", "run"), ["tree", "run"]
    )
    slots = joined.select("*", F.explode(F.sequence(F.lit(0), F.size("members") - 1)).alias("slot"))
    return slots.select(
        "tree",
        (F.col("run") * arity + F.col("slot")).alias("idx"),
        F.concat(F.array(_step(F.col("members"), F.col("slot"))), "path").alias("path"),
        *[c for c in above.columns if c not in ("tree", "idx", "path")],
    )


def proofs(manifest: Manifest) -> DataFrame:
    """The leaves with ``subroot``, ``root`` and ``path``: siblings to the left and right of
    the leaf and of each node above it, up to the root, as an array of (left, right) texts.

    ``fold(digest, path)`` gives the root again.
    """
    arity, levels = manifest.arity, manifest.levels
    nothing = F.array().cast(f"array<{_STEP}>")
    zero = F.lit(0).cast("long")

    # the upper tree: subroots are its leaves
    paths = manifest.roots.sparkSession.range(1).select(zero.alias("tree"), zero.alias("idx"), nothing.alias("path"))
    for runs in reversed(manifest.top):
        paths = _below(runs, paths, arity)
    roots = manifest.roots.select("tree", F.col("digest").alias("subroot"))
    ends = roots.join(paths.select(F.col("idx").alias("tree"), "path"), "tree").select(
        "tree", zero.alias("idx"), "path", "subroot"
    )

    def ending(nodes: DataFrame) -> DataFrame:
        """Trees whose last node is at this level."""
        return ends.join(nodes.where("size = 1").select("tree"), "tree").select(*ends.columns)

    above = None
    for k in range(len(levels) - 1, -1, -1):
        here = ending(levels[k])
        # ``above``: paths of the nodes that level k made, which are the parents of the next lower one
        above = here if above is None else here.unionByName(_below(levels[k + 1], above, arity))
    lone = ending(manifest.leaves).select(
        "tree", F.col("idx").alias("run"), F.array().cast("array<string>").alias("members"), "path", "subroot"
    )
    if levels:
        first = levels[0].select("tree", "run", "members").join(
            above.withColumnRenamed("idx", "run"), ["tree", "run"]
        )
        lone = lone.unionByName(first)
    leaves = manifest.leaves.withColumn("run", F.expr(f"idx div {arity}")).join(lone, ["tree", "run"])
    slot = F.pmod("idx", F.lit(arity)).cast("int")
    path = F.when(F.col("size") > 1, F.concat(F.array(_step(F.col("members"), slot)), "path"))
    return leaves.withColumn("path", path.otherwise(F.col("path"))).withColumn(
        "root", F.lit(manifest.root).cast("string")
    ).drop("run", "members", "size")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def verify_documents(docs: DataFrame, tampered: int = 5) -> DataFrame:
    """Manifest of documents by source, and the proof of every row, tried on some altered texts.

    One row per input row: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``,
    ``folded_root`` (from the row as it was found and its proof) and ``verified``. Found
    altered (A-Z in lower case) are the texts of rows for which ``tampered`` divides the
    CRC-32 of the decimal ``doc_id``; a row without an id is never altered.

    Nulls in any column have a mark of their own in the leaf, so null and empty differ;
    rows of a null source form the first tree; repeated rows are leaves side by side;
    other columns are ignored; an empty table gives no row and no root.
    """
    cols = {n: F.col(f"`{n}`") for n in ("doc_id", "source", "lang", "n_chars", "text")}
    number = cols["doc_id"].cast("long")
    own = [number, cols["source"].cast("string"), cols["lang"], cols["n_chars"].cast("long"), cols["text"]]
    lowered = F.translate(cols["text"], _UPPER, _UPPER.lower())
    altered = F.coalesce(F.crc32(number.cast("string").cast("binary")) % tampered == 0, F.lit(False))
    found = F.when(altered, row_digest([*own[:-1], lowered]))
    manifest = build_manifest(
        docs, own[1], number, own, carry={"doc_id": number, "found": found}
    )
    proven = proofs(manifest)
    folded = fold(F.coalesce("found", "digest"), F.col("path"))
    return proven.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        path_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
