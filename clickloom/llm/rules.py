"""Quality rules under weak supervision.

Each rule reads one measure of a text and votes good, bad or nothing. Nobody knows
how far a rule can be trusted, so expectation-maximisation over the table of votes
estimates for every rule how often it is right about good and about bad texts, and how
many texts are good. The posterior probability from all votes replaces the usual
demand that every rule must pass.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import NOT_SPACE, whole_text, words_of
from clickloom.workspace import materialise

#: Words of a window in which repetition is looked for.
WINDOW = 5
#: A word of letters or digits with at most one mark before and after it.
PLAIN_WORD = rf"(?<!{NOT_SPACE})[\"'(«„]?[\p{{L}}\p{{N}}'’-]++[.,;:!?)\"'»”]?(?!{NOT_SPACE})"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also inside other lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by windows that occur twice or more, the first occurrence included.

    Windows are compared by 64-bit hashes. Texts without a repeat stop after counting
    distinct hashes; the others sort them, and positions of equal neighbours are covered.
    """

    def hashes(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(w) - (window - 1)),
            lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(window)]),
        )

    def covered(places: Column) -> Column:
        steps = F.zip_with(
            F.slice(places, 2, F.size(places)),
            F.slice(places, 1, F.size(places) - 1),
            lambda b, a: F.least(b - a, F.lit(window)),
        )
        return F.aggregate(steps, F.lit(window), lambda a, x: a + x)

    def places(placed: Column) -> Column:
        n = F.size(placed)
        twice = F.zip_with(
            F.slice(placed, 1, n - 1),
            F.slice(placed, 2, n),
            lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)),
        )
        return F.array_sort(F.array_distinct(F.flatten(F.filter(twice, lambda x: x.isNotNull()))))

    def count(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            _let(_let(placed, places), covered)
        )

    return F.when(F.size(words) < window, F.lit(0)).otherwise(_let(words, lambda w: _let(hashes(w), count)))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What the rules look at, for every whole text."""
    split = whole_text(docs, id_col, text_col).select(
        "doc_id", "text", words_of(F.col("text")).alias("w")
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(NOT_SPACE))
    joined = F.array_join("w", "")
    return split.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(joined).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("lines"),
        repeated_words(F.col("w")).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit(r"[.!?]")).cast("long").alias("n_stops"),
        F.regexp_count("text", F.lit(PLAIN_WORD)).cast("long").alias("n_plain"),
    ).select(
        "*", F.col("lines.n").cast("long").alias("n_lines"), F.col("lines.dup").cast("long").alias("n_dup_lines")
    ).drop("lines")


def _votes() -> dict[str, Column]:
    """1: good, -1: bad, 0: no opinion."""
    words = F.col("n_words")

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    # a ratio over nothing is null, and then a rule abstains
    upper, mean = F.try_divide(F.col("n_upper"), F.col("word_chars")), F.try_divide(F.col("word_chars"), words)
    symbols, repeats = F.try_divide(F.col("n_symbols"), words), F.try_divide(F.col("n_repeat_words"), words)
    duplicate, variety = F.try_divide(F.col("n_dup_lines"), F.col("n_lines")), F.try_divide(F.col("n_distinct"), words)
    plain = F.try_divide(F.col("n_plain"), words)
    stops = F.try_divide(words, F.col("n_stops"))
    return {
        "length": vote(words < 10, words >= 30),
        "word_length": vote((mean < 2.5) | (mean > 12), mean.between(3, 9)),
        "symbols": vote(symbols > 0.1, symbols < 0.02),
        "duplicate_lines": vote(duplicate > 0.3, duplicate == 0),
        "repetition": vote(repeats > 0.2, repeats < 0.1),
        "capitals": vote(upper > 0.3, upper < 0.15),
        "variety": vote(variety < 0.2, variety > 0.4),
        "plain_words": vote(plain < 0.6, plain > 0.85),
        "sentences": vote((F.col("n_stops") == 0) | (stops > 80) | (stops < 1.5), stops.between(3, 40)),
    }


#: Where a rule starts: how often it is right on good and on bad texts. A bad text fails
#: few of the rules, a good one hardly any. As many votes as this share of the texts say so.
START, PSEUDO = (0.98, 0.4), 0.05


def fit(counts: dict[tuple[int, ...], int], rounds: int = 50) -> tuple[float, list[tuple[float, float]]]:
    """Share of good texts, and per rule how often it is right on good and on bad texts.

    Expectation-maximisation on the table of votes (at most 3 ** rules rows), with
    pseudo-votes that keep a rule near its start where few others speak.
    """
    rules, total = len(next(iter(counts), ())), sum(counts.values())
    good, right = 0.8, [START] * rules
    pseudo = PSEUDO * total
    for _ in range(rounds if total else 0):
        good_total = 0.0
        hits = [[pseudo * START[0], pseudo, pseudo * START[1], pseudo] for _ in range(rules)]
        for votes, n in counts.items():
            p = posterior(votes, good, right)
            good_total += n * p
            for k, vote in enumerate(votes):
                if vote:
                    hits[k][0] += n * p * (vote > 0)
                    hits[k][1] += n * p
                    hits[k][2] += n * (1 - p) * (vote < 0)
                    hits[k][3] += n * (1 - p)
        good = min(0.99, max(0.01, good_total / total))
        right = [(_inside(a / b), _inside(c / d)) for a, b, c, d in hits]
    return good, right


def _inside(p: float) -> float:
    return min(0.999, max(0.001, p))


def _weights(right: tuple[float, float]) -> tuple[float, float]:
    """Log odds for good that a good and that a bad vote give."""
    g, b = right
    return math.log(g / (1 - b)), math.log((1 - g) / b)


def posterior(votes: tuple[int, ...], good: float, right: list[tuple[float, float]]) -> float:
    odds = math.log(good / (1 - good))
    for vote, r in zip(votes, right, strict=True):
        odds += _weights(r)[0 if vote > 0 else 1] if vote else 0.0
    return 1 / (1 + math.exp(-odds))


def judge_quality(
    docs: DataFrame,
    min_probability: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Measures, votes and verdict for every row, by DataFrame functions only.

    ``doc_id``, ``n_words``, ``word_chars`` (code points in words), ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed`` (fewer than 10 words, or more
    than a fifth of them in repeated windows), ``probability`` that the text is good,
    and ``kept``: not ``base_failed`` and ``probability`` of at least ``min_probability``.

    Texts are read once; the measures are written, their vote combinations (at most
    3 ** 9, whatever the input) are counted, and the fitted weights go into one more
    projection. Null, empty and blank texts have no words and fail the base; repeated
    rows are judged each; other columns are ignored; an empty table gives an empty
    result.
    """
    votes = _votes()
    measured = materialise(measures(docs, id_col, text_col), "measures")
    voted = measured.select("*", *[v.alias(f"vote_{k}") for k, v in votes.items()])
    names = [f"vote_{k}" for k in votes]
    counts = {
        tuple(int(row[n]) for n in names): row["count"]
        for row in voted.groupBy(*names).count().collect()
    }
    good, right = fit(counts)
    odds = F.lit(math.log(good / (1 - good)))
    for name, r in zip(names, right, strict=True) if counts else []:
        for_good, for_bad = _weights(r)
        odds = odds + F.when(F.col(name) == 1, for_good).when(F.col(name) == -1, for_bad).otherwise(0.0)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return voted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (1 / (1 + F.exp(-odds))).alias("probability"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= min_probability))
