"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Ratings are grades 0, 1, ..., top. One score f(x), a sum of weights of hashed text
features, is shared by all grades; ordered thresholds cut it:
P(grade <= k) = sigmoid(threshold[k] - f(x)). The expected grade orders documents, and
the tail probability P(grade >= k) selects them.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import map_rows, whole_text
from clickloom.llm.pretokens import release_worker

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Buckets of the hashed features.
BUCKETS = 1 << 22
#: A feature counts if so many of the sampled documents have it.
MIN_DOCUMENTS = 5
#: Entries of a task's caches; a full cache is emptied.
CACHE = 250_000


def _bucket(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature.encode()) & (BUCKETS - 1)


class _Cache(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[key] = value
        return value


def _shape(word: str) -> str:
    """Kinds of characters in a row, each run once, at most eight."""
    kinds = re.sub(r"[^\W\d_]", lambda m: "A" if m[0].isupper() else "a", word)
    return re.sub(r"(.)\1+", r"\1", re.sub(r"\d", "9", kinds))[:8]


class Features:
    """Feature buckets of a text: its words, and levels of word shapes, variety and length."""

    def __init__(self):
        self._word = _Cache(lambda w: _bucket("w " + (w.strip(".,;:!?\"'()").lower() or w))).__getitem__
        self._shapes = _Cache(_shape).__getitem__
        self._level = _Cache(_bucket).__getitem__

    def __call__(self, text: str) -> set[int]:
        words = text.split()
        n, distinct = len(words), set(words)
        found = set(map(self._word, distinct))
        for shape, count in Counter(map(self._shapes, words)).items():
            for level in (0.02, 0.1, 0.3):
                if count > level * n:
                    found.add(self._level(f"s {shape} {level}"))
        for level in (0.1, 0.2, 0.3, 0.4):
            if len(distinct) < level * n:
                found.add(self._level(f"v {level}"))
        for level in (1, 10, 30, 100, 1000):
            if n < level:
                found.add(self._level(f"n {level}"))
        return found


@dataclass
class Model:
    """Weights by bucket and ordered thresholds; ``constant`` if only one grade was seen."""

    weights: dict[int, float]
    thresholds: list[float]
    constant: int | None = None

    def score(self, features: set[int]) -> float:
        weights = self.weights
        return sum(weights[b] for b in features if b in weights)

    def judge(self, features: set[int], tail: int) -> tuple[float, float]:
        """Expected grade and P(grade >= tail)."""
        if self.constant is not None:
            return float(self.constant), float(self.constant >= tail)
        f = self.score(features)
        above = [1 / (1 + np.exp(np.clip(t - f, -50, 50))) for t in self.thresholds]
        return float(sum(above)), float(above[tail - 1])


def fit(
    flat: np.ndarray, lengths: np.ndarray, y: np.ndarray, steps: int = 120, penalty: float = 2e-4
) -> Model:
    """Maximum penalised likelihood by full-batch gradient steps (Adam), from zero: repeatable.

    ``flat``: the documents' buckets one after the other, ``lengths`` of each; ``y``: grades.
    """
    if len(np.unique(y)) < 2:
        return Model({}, [], constant=int(y[0]) if len(y) else 10**6)
    top, n = int(y.max()), len(y)
    counts = np.bincount(flat, minlength=BUCKETS)
    buckets = np.flatnonzero(counts >= MIN_DOCUMENTS)
    place = np.full(BUCKETS, -1, np.int32)
    place[buckets] = np.arange(len(buckets))
    column = place[flat]
    doc = np.repeat(np.arange(n, dtype=np.int32), lengths)[column >= 0]
    column = column[column >= 0]
    share = np.cumsum(np.bincount(y, minlength=top + 1))[:-1] / n
    first = np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
    w = np.zeros(len(buckets))
    # thresholds as the first and the logarithms of the steps, so that they stay in order
    t = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 0.05))])
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    rate, b1, b2 = 0.1, 0.9, 0.999
    for step in range(1, steps + 1):
        cuts = np.cumsum(np.concatenate([t[:1], np.exp(t[1:])]))
        f = np.bincount(doc, w[column], minlength=n)
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        low = 1 / (1 + np.exp(-np.clip(edges[y] - f, -50, 50)))
        high = 1 / (1 + np.exp(-np.clip(edges[y + 1] - f, -50, 50)))
        p = np.maximum(high - low, 1e-12)
        slope_low, slope_high = low * (1 - low), high * (1 - high)
        slope_low[y == 0], slope_high[y == top] = 0, 0
        grad_f = (slope_high - slope_low) / p / n  # of the negative log likelihood
        grad_w = np.bincount(column, grad_f[doc], minlength=len(w)) + penalty * w
        grad_cut = np.array(
            [((y == k + 1) * slope_low / p - (y == k) * slope_high / p).sum() / n for k in range(top)]
        )
        tails = np.cumsum(grad_cut[::-1])[::-1]
        grad_t = np.concatenate([tails[:1], tails[1:] * np.exp(t[1:])])
        for x, g, m, v in ((w, grad_w, *state[:2]), (t, grad_t, *state[2:])):
            m += (1 - b1) * (g - m)
            v += (1 - b2) * (g * g - v)
            x -= rate * (m / (1 - b1**step)) / (np.sqrt(v / (1 - b2**step)) + 1e-8)
    cuts = np.cumsum(np.concatenate([t[:1], np.exp(t[1:])]))
    return Model(dict(zip(buckets.tolist(), w.tolist(), strict=True)), cuts.tolist())


def train(
    docs: DataFrame, ratings: DataFrame, max_rows: int = 10_000, id_col: str = "doc_id", text_col: str = "text"
) -> Model:
    """Fit on at most ``max_rows`` rated documents (those with the smallest hashes of their ids).

    ``ratings`` has columns ``doc_id`` and ``grade``; rows with a null are left out, a
    rating that comes repeatedly counts once, different ones of a document count each. Of
    several texts under one id the bytewise smallest counts, so however often an id comes,
    one row of it is read on. The sampled ids are broadcast, their features come to the
    driver: both at most ``max_rows`` rows.
    """
    sample = (
        ratings.select(F.col("doc_id").cast("long").alias("rated"), F.col("grade").cast("int"))
        .dropna()
        .distinct()
        .orderBy(F.xxhash64("rated"), "rated", "grade")
        .limit(max_rows)
    )
    chosen = whole_text(docs, id_col, text_col).join(
        F.broadcast(sample), F.col("doc_id") == F.col("rated")
    )
    # one text per rating: rows of a repeated id are combined before they are shuffled
    chosen = chosen.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("grade", pa.int32()), ("features", pa.list_(pa.int32()))]
    )

    def rows(incoming):
        release_worker()
        features = Features()
        for row in incoming:
            yield {
                "doc_id": row["doc_id"],
                "grade": row["grade"],
                "features": sorted(features(row["text"])),
            }

    found = chosen.select("doc_id", "grade", "text").mapInArrow(
        map_rows(schema, rows), "doc_id long, grade int, features array<int>"
    )
    # in one order, whatever the tasks' order, so that the fit repeats bit by bit
    table = found.toArrow()
    table = table.append_column("n", pc.list_value_length(table["features"])).combine_chunks()
    table = table.sort_by([(c, "ascending") for c in ("doc_id", "grade", "n")])
    flat = pc.list_flatten(table["features"]).to_numpy()
    return fit(flat, table["n"].to_numpy(), table["grade"].to_numpy())


def grades_of_labels(labels: DataFrame) -> DataFrame:
    """Ratings from ``quality`` and ``toxic``: 0 poor, 1 sound but toxic, 2 sound."""
    return labels.filter("quality IS NOT NULL").select(
        "doc_id",
        F.when(F.col("quality") == 0, 0)
        .when(F.coalesce(F.col("toxic"), F.lit(0)) == 1, 1)
        .otherwise(2)
        .alias("grade"),
    )


def judge_documents(
    docs: DataFrame,
    model: Model,
    tail: int = 2,
    min_probability: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``expected_grade``, ``tail_probability``, ``kept`` for every row.

    ``tail_probability`` is P(grade >= ``tail``), ``kept`` whether it reaches
    ``min_probability``. One pass over whole texts, no shuffle. Null and empty texts are
    judged by their length features; repeated rows are judged each; other columns are
    ignored; an empty table gives an empty result. A model that saw no ratings keeps all.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [
        ("doc_id", pa.int64(), "long"),
        ("expected_grade", pa.float64(), "double"),
        ("tail_probability", pa.float64(), "double"),
        ("kept", pa.bool_(), "boolean"),
    ]

    def rows(incoming):
        features, fitted = Features(), shared.value
        for row in incoming:
            expected, above = fitted.judge(features(row["text"]), tail)
            yield {
                "doc_id": row["doc_id"],
                "expected_grade": expected,
                "tail_probability": above,
                "kept": above >= min_probability,
            }

    return whole_text(docs, id_col, text_col).mapInArrow(
        map_rows(pa.schema([f[:2] for f in fields]), rows),
        ", ".join(f"{name} {kind}" for name, _, kind in fields),
    )


def select_documents(
    docs: DataFrame, model: Model, tail: int = 2, min_probability: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns whatever their names, that ``judge_documents`` keeps.

    Null and empty texts are judged by their length features; each row, repeated ones
    included, is judged by itself; an empty table stays empty. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        release_worker()
        features, fitted = Features(), shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            good = [
                fitted.judge(features(t.as_py() or ""), tail)[1] >= min_probability for t in texts
            ]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
