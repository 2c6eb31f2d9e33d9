"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.workspace import materialise


def _least_neighbour(links: DataFrame) -> DataFrame:
    """(u, v, m: least of u and its neighbours) over both directions of every link."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.join(least, "u")


def connected(links: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node of its component, for every node of a link.

    ``links`` has two long columns ``u`` and ``v``; repeats and loops do no harm. Large
    and small stars in turn: every step links a node's neighbours to the least of them,
    so a chain of n nodes needs about log n rounds. Each round is a written table; a
    node with very many neighbours is summed up before its shuffle, and the join that
    follows may be split by Spark.
    """
    edges = materialise(
        links.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        # large star: a node's larger neighbours go to the least around it
        large = (
            _least_neighbour(edges)
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # small star: a node and its smaller neighbours go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = materialise(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct(),
            "links",
        )
        # the links and the sum of their lower ends stand still once all are stars
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
