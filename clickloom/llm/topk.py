"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

A term is a dimension of the vectors, its postings are the candidates' weights in
that dimension. Queries and candidates are cut into blocks; every pair of blocks is one
group of a shuffle. In it each query row scatters its non-zero weights, one term after
the other, times the postings into a dense array of scores; the best k are selected
from the array, and Spark merges the blocks' selections.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block of queries and of a block of candidates.
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 8192
#: Query rows whose score arrays are held at once.
ROWS_AT_ONCE = 64


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows' floors as integers, absent components as 0. Python integers if 64 bits may not do."""
    rows = [np.asarray(v, dtype=np.float64) for v in vectors]
    out = np.zeros((len(rows), width))
    for k, row in enumerate(rows):
        out[k, : len(row)] = np.floor(row)
    if np.abs(out).max(initial=0) < 2.0**62:
        return out.astype(np.int64)
    return np.vectorize(int, otypes=[object])(out)


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of query rows (first axis) against all candidates, term by term."""
    largest = [float(np.abs(m).max(initial=0)) for m in (queries, candidates)]
    exact = largest[0] * largest[1] * max(1, queries.shape[1]) < 2.0**62
    kind = np.int64 if exact else object
    scores = np.zeros((len(queries), len(candidates)), kind)
    postings = np.ascontiguousarray(candidates.T).astype(kind, copy=False)
    weights = queries.astype(kind, copy=False)
    for term in range(queries.shape[1]):
        for row in np.flatnonzero(weights[:, term]):
            scores[row] += weights[row, term] * postings[term]
    return scores


def select(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores; ties go to the smaller position."""
    if len(scores) <= k:
        return np.argsort(-scores, kind="stable")
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    ties = np.flatnonzero(scores == least)[: k - len(above)]
    chosen = np.concatenate([above, ties])
    return chosen[np.argsort(-scores[chosen], kind="stable")]


def top_k(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's k best candidates.

    Every component x becomes floor(scale * x), x as double; the score is the integer
    inner product, missing components of the shorter vector counting as 0. Queries are
    the rows that satisfy ``is_query`` (a condition on ``vec_id``), candidates all rows
    but the query's own, other rows of its id included; ties go to the smaller ``vec_id``.
    Rows whose id or vector is null, or whose vector holds null or non-finite components,
    take no part. A query row that comes repeatedly, id and vector alike, is one query, and
    all its copies are its own row; repeated candidates count each.
    Fewer candidates than k: all of them. Empty tables give an empty result; other
    columns are ignored. A score beyond 64 bits fails.

    The number of block pairs follows the stated query set times the table, the work of
    an exhaustive search; a task holds one pair of blocks.
    """
    finite = F.forall(
        "raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    rows = (
        vectors.select(
            F.col(f"`{id_col}`").cast("long").alias("vec_id"),
            F.col(f"`{vector_col}`").cast("array<double>").alias("raw"),
        )
        .filter(F.col("vec_id").isNotNull() & F.col("raw").isNotNull() & finite)
        .select("vec_id", F.transform("raw", lambda x: x * scale).alias("w"))
    )
    queries = rows.filter(is_query).distinct()
    size = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    q_blocks = -(-size.q // QUERY_BLOCK) or 1
    c_blocks = -(-size.n // CANDIDATE_BLOCK) or 1
    placed = F.pmod(F.xxhash64("vec_id", "w"), F.lit(q_blocks))
    spread = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(c_blocks))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("qb", placed).withColumn("cb", every(c_blocks))
    right = rows.withColumn("cb", spread).withColumn("qb", every(q_blocks))

    def score(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame(columns=["query_id", "query_row", "vec_id", "score"])
        c = c.sort_values("vec_id", kind="stable")
        width = max(max(map(len, q["w"])), max(map(len, c["w"])))
        weights, postings = _matrix(q["w"], width), _matrix(c["w"], width)
        ids, q_ids = c["vec_id"].to_numpy(), q["vec_id"].to_numpy()
        q_rows, c_rows = q["query_row"].to_numpy(), c["row"].to_numpy()
        own_from, own_to = np.searchsorted(ids, q_ids), np.searchsorted(ids, q_ids, "right")
        parts = []
        for k0 in range(0, len(q), ROWS_AT_ONCE):
            scores = accumulate(weights[k0 : k0 + ROWS_AT_ONCE], postings)
            for r in range(len(scores)):
                first, end = own_from[k0 + r], own_to[k0 + r]
                own = first + np.flatnonzero(c_rows[first:end] == q_rows[k0 + r])
                others, other_ids = np.delete(scores[r], own), np.delete(ids, own)
                best = select(others, k)
                parts.append(
                    pd.DataFrame(
                        {
                            "query_id": q_ids[k0 + r],
                            "query_row": q_rows[k0 + r],
                            "vec_id": other_ids[best],
                            "score": others[best].astype(np.int64),
                        }
                    )
                )
        return pd.concat(parts)

    left = left.withColumn("query_row", F.xxhash64("vec_id", "w"))
    right = right.withColumn("row", F.xxhash64("vec_id", "w"))
    found = (
        left.groupBy("qb", "cb")
        .cogroup(right.groupBy("qb", "cb"))
        .applyInPandas(score, "query_id long, query_row long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
