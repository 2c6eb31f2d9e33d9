"""URL filter: rules by host suffix and path prefix, and boosted trees for the rest.

A URL that a rule judges is a labelled one. Gradient-boosted trees are fitted on lexical
features of labelled URLs (lengths, depth, digit ratio, entropy, parameter counts, how often
hosts of the same suffix are blocked) and judge the URLs that no rule fits. Features are
binned on fixed grids and gradients are summed as whole numbers, so a fit repeats exactly.
Everything is column expressions and aggregates; the driver sees histograms of fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.workspace import materialise

#: (verdict, host suffix and path prefix).
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

#: Bins of every feature, and their width on the feature's scale.
BINS = 32
FEATURES = {
    "url_length": 8.0,
    "host_length": 2.0,
    "path_length": 4.0,
    "depth": 1.0,
    "digit_ratio": 1 / 32,
    "entropy": 0.2,
    "parameters": 1.0,
    "host_labels": 1.0,
    "host_hyphens": 1.0,
    "host_digits": 1.0,
    "marks": 1.0,
    "share_1": 1 / 16,
    "share_2": 1 / 16,
    "share_ending": 1 / 16,
}
#: Buckets of suffix statistics for each kind of suffix. Fixed, so that they may be broadcast.
SUFFIX_BUCKETS = 1 << 13
SUFFIXES = ["share_1", "share_2", "share_ending"]
#: Parts of the labelled rows; a row's own part doesn't count for its shares in the fit.
FOLDS = 4
#: Weight of the overall share in a suffix' share, in URLs.
PRIOR_WEIGHT = 4.0
#: Gradients are counted in steps of this size.
_UNIT = 1 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# -- parts of a URL and rules --------------------------------------------------------


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(host: Column, path: Column, rule: str) -> Column:
    suffix, slash, prefix = rule.partition("/")
    own = (host == suffix) | F.endswith(host, F.lit("." + suffix))
    return own & F.startswith(path, F.lit(slash + prefix))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule's text, the first listed of equally long ones; null if none fits.

    Rules are expressions in the plan: a list that a person keeps, not a table.
    """
    ordered = sorted((rule for _, rule in rules), key=len, reverse=True)
    return F.coalesce(
        F.lit(None).cast("string"), *[F.when(_fits(host, path, r), F.lit(r)) for r in ordered]
    )


def rule_verdict(rule: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The verdict that belongs to a rule's text."""
    known: dict[str, str] = {}
    for verdict, text in rules:
        known.setdefault(text, verdict)
    return F.coalesce(
        F.lit(None).cast("string"), *[F.when(rule == t, F.lit(v)) for t, v in known.items()]
    )


# -- features ----------------------------------------------------------------------------


def _count(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, f"(?s){pattern}", ""))


def entropy(text: Column) -> Column:
    """Bits per character. Characters that aren't printable ASCII count as one, so that there
    are at most 96 to count in however long a text."""
    plain = F.regexp_replace(text, r"[^\x21-\x7E]", " ")
    total = F.length(plain)
    kinds = F.array_distinct(F.split(plain, ""))
    shares = F.transform(
        F.filter(kinds, lambda c: c != ""),
        lambda c: (total - F.length(F.replace(plain, c, F.lit("")))) / total,
    )
    return F.aggregate(shares, F.lit(0.0), lambda sum_, p: sum_ - p * F.log2(p))


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def _ending(path: Column) -> Column:
    """The path's file ending, or its kind of last sign."""
    return F.regexp_extract(path, r"(\.[A-Za-z0-9]{1,8}|/)$", 1)


def _bucket(kind: int, text: Column) -> Column:
    return (F.pmod(F.xxhash64(text), F.lit(SUFFIX_BUCKETS)) + kind * SUFFIX_BUCKETS).cast("int")


def _bin(value: Column, width: float) -> Column:
    return F.least(F.lit(BINS - 1), F.floor(value / width).cast("int"))


def lexical_bins(url: Column, host: Column, path: Column) -> list[Column]:
    """Bins of the features that a URL has of itself, in the order of ``FEATURES``."""
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    values = {
        "url_length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda p: p != "")),
        "digit_ratio": _count(url, "[^0-9]") / F.greatest(F.length(url), F.lit(1)),
        "entropy": F.coalesce(entropy(url), F.lit(0.0)),
        "parameters": F.size(F.filter(F.split(query, "[&;]"), lambda p: p != "")),
        "host_labels": F.size(F.filter(F.split(host, r"\."), lambda p: p != "")),
        "host_hyphens": _count(host, "[^-]"),
        "host_digits": _count(host, "[^0-9]"),
        "marks": _count(url, r"[A-Za-z0-9/:.?&=#-]"),
    }
    return [_bin(v, FEATURES[n]).alias(n) for n, v in values.items()]


def suffix_buckets(host: Column, path: Column) -> list[Column]:
    """Buckets of the host's last label, its last two, and the path's ending."""
    texts = [_suffix(host, 1), _suffix(host, 2), _ending(path)]
    return [_bucket(k, t).alias(f"_{n}") for k, (n, t) in enumerate(zip(SUFFIXES, texts, strict=True))]


def _fold() -> Column:
    return F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(FOLDS)).cast("int")


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """``n`` and ``blocked`` by bucket and, as arrays, by fold; over all labelled rows."""
    buckets = F.explode(F.array(*suffix_buckets(F.col("host"), F.col("path"))))
    rows = labelled.select("blocked", _fold().alias("fold"), buckets.alias("bucket"))

    def by_fold(value: Column) -> Column:
        return F.array(*[F.sum(F.when(F.col("fold") == k, value).otherwise(0)) for k in range(FOLDS)])

    return rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("blocked").alias("blocked"),
        by_fold(F.lit(1)).alias("n_in_fold"),
        by_fold(F.col("blocked")).alias("blocked_in_fold"),
    )


def _with_shares(rows: DataFrame, statistics: DataFrame, prior: float, fold: str | None = None) -> DataFrame:
    """Add the bins of the shares of blocked URLs with the same suffixes.

    ``fold`` names the column of the rows' own fold, whose URLs are left out: whether a row
    is blocked must not show in its share. ``statistics`` has at most three times
    ``SUFFIX_BUCKETS`` rows.
    """
    kept = rows.columns
    for name in SUFFIXES:
        found = statistics.withColumnRenamed("bucket", f"_{name}")
        n, blocked = F.col("n"), F.col("blocked_")
        if fold is not None:
            n = n - F.get("n_in_fold", F.col(fold))
            blocked = blocked - F.get("blocked_in_fold", F.col(fold))
        n, blocked = F.coalesce(n, F.lit(0)), F.coalesce(blocked, F.lit(0))
        share = (blocked + PRIOR_WEIGHT * prior) / (n + PRIOR_WEIGHT)
        rows = rows.join(
            F.broadcast(found.withColumnRenamed("blocked", "blocked_")), f"_{name}", "left"
        ).withColumn(name, _bin(share, FEATURES[name]))
        kept = [*kept, name]
        rows = rows.select(*kept)
    return rows.drop(*[f"_{name}" for name in SUFFIXES])


# -- boosted trees -----------------------------------------------------------------------


@dataclass
class Tree:
    """Splits by heap number: ``splits[i] = (feature, last bin to the left)``; leaf values alike."""

    splits: dict[int, tuple[str, int]]
    values: dict[int, float]

    def _walk(self, leaf, node: int = 1) -> Column:
        if node not in self.splits:
            return leaf(node)
        feature, most = self.splits[node]
        return F.when(F.col(feature) <= most, self._walk(leaf, 2 * node)).otherwise(
            self._walk(leaf, 2 * node + 1)
        )

    def node(self) -> Column:
        return self._walk(lambda node: F.lit(node))

    def value(self) -> Column:
        return self._walk(lambda node: F.lit(self.values.get(node, 0.0)))


@dataclass
class UrlModel:
    """Log odds of being blocked: ``base`` and the trees' values."""

    base: float
    prior: float
    trees: list[Tree]
    statistics: DataFrame

    def score(self) -> Column:
        return reduce(lambda total, tree: total + tree.value(), self.trees, F.lit(self.base))


def best_split(sums: dict[tuple[str, int], tuple[int, int]], penalty: float, least: float):
    """(gain, feature, last bin to the left, (g, h) left, (g, h) right) of one node, or None.

    ``sums``: gradients and curvatures by feature and bin. Of equal gains the first feature's
    lowest bin wins.
    """
    best = None
    for feature in FEATURES:
        bins = [(b, *sums[feature, b]) for b in range(BINS) if (feature, b) in sums]
        g, h = sum(x[1] for x in bins), sum(x[2] for x in bins)
        left_g = left_h = 0
        for (b, own_g, own_h), (next_bin, _, _) in pairwise(bins):
            left_g, left_h = left_g + own_g, left_h + own_h
            right_g, right_h = g - left_g, h - left_h
            if min(left_h, right_h) < least * _UNIT:
                continue
            weight = penalty * _UNIT
            gain = (
                left_g * left_g / (left_h + weight)
                + right_g * right_g / (right_h + weight)
                - g * g / (h + weight)
            )
            if gain > 1e-6 * _UNIT and (best is None or gain > best[0]):
                # bins that no row has are shared out between both sides
                middle = (b + next_bin) // 2
                best = (gain, feature, middle, (left_g, left_h), (right_g, right_h))
    return best


def _grow(sample: DataFrame, depth: int, rate: float, penalty: float, least: float) -> Tree:
    """One tree on rows with bins and integer gradients ``_g``, ``_h``; one job per level."""
    tree = Tree({}, {})
    open_nodes = {1}
    bins = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES])
    for _ in range(depth):
        if not open_nodes:
            break
        cells = (
            sample.select(tree.node().alias("node"), "_g", "_h", F.explode(bins).alias("cell"))
            .where(F.col("node").isin(sorted(open_nodes)))
            .groupBy("node", "cell.feature", "cell.bin")
            .agg(F.sum("_g").alias("g"), F.sum("_h").alias("h"))
            .collect()
        )
        by_node: dict[int, dict] = {}
        for c in cells:
            by_node.setdefault(c.node, {})[c.feature, c.bin] = (c.g, c.h)
        open_nodes = set()
        for node, sums in sorted(by_node.items()):
            split = best_split(sums, penalty, least)
            if split is None:
                continue
            _, feature, most, *sides = split
            tree.splits[node] = (feature, most)
            for child, (g, h) in zip((2 * node, 2 * node + 1), sides, strict=True):
                tree.values[child] = rate * g / (h + penalty * _UNIT)
                open_nodes.add(child)
    return tree


def train(
    labelled: DataFrame,
    max_rows: int = 10_000,
    trees: int = 12,
    depth: int = 3,
    rate: float = 0.4,
    penalty: float = 1.0,
    least: float = 1.0,
) -> UrlModel:
    """Fit on labelled URLs: ``url``, ``host``, ``path`` and ``blocked`` (0 or 1).

    Suffix statistics cover all labelled rows; in the fit a row sees those of other folds.
    The trees see at most ``max_rows`` rows, those with the smallest hashes of all four
    columns. No rows: nothing is blocked. One label only: everything gets it.
    """
    host, path = F.col("host"), F.col("path")
    statistics = materialise(suffix_statistics(labelled), "url-suffixes")
    whole = statistics.where(F.col("bucket") < SUFFIX_BUCKETS).agg(F.sum("n"), F.sum("blocked")).first()
    n, blocked = (x or 0 for x in whole)
    prior = (blocked + 1) / (n + 2)
    model = UrlModel(math.log(prior / (1 - prior)), prior, [], statistics)
    if not 0 < blocked < n:
        return model
    order = F.xxhash64("url", "host", "path", "blocked")
    chosen = labelled.withColumn("_order", order)
    if n > max_rows:
        # most rows never reach the sort: the hash alone leaves out what can't be among the first
        share = min(1.0, 1.2 * max_rows / n)
        chosen = chosen.where(F.col("_order") <= int(-(1 << 63) + share * ((1 << 64) - 1)))
    chosen = chosen.orderBy("_order", "url").limit(max_rows)
    lexical = chosen.select(
        "blocked",
        _fold().alias("fold"),
        *lexical_bins(F.col("url"), host, path),
        *suffix_buckets(host, path),
    )
    sample = materialise(_with_shares(lexical, statistics, prior, "fold"), "url-sample")
    for _ in range(trees):
        p = 1 / (1 + F.exp(-model.score()))
        slopes = sample.withColumn("_p", p).select(
            *FEATURES,
            F.round((F.col("blocked") - F.col("_p")) * _UNIT).cast("long").alias("_g"),
            F.greatest(F.lit(1), F.round(F.col("_p") * (1 - F.col("_p")) * _UNIT)).cast("long").alias("_h"),
        )
        tree = _grow(slopes, depth, rate, penalty, least)
        if not tree.splits:
            break
        model.trees.append(tree)
    return model


def with_parts(pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str, url_col: str) -> DataFrame:
    """``page_id``, ``url``, ``host``, ``path`` and ``rule`` of every row; nothing else of the table."""
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url")
    )
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    return rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))


def labelled_by_rules(parts: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """The URLs that a rule judges, as training data."""
    verdict = rule_verdict(F.col("rule"), rules)
    return parts.where("rule IS NOT NULL").select(
        "url", "host", "path", F.when(verdict == "block", 1).otherwise(0).alias("blocked")
    )


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    model: UrlModel | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    max_rows: int = 10_000,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``block_probability`` of every row.

    A rule fits a host and its subdomains if the path starts with the rule's; the longest
    wins and gives the verdict. Rows without a rule are blocked if the ``model`` finds that
    more likely than not; without a model one is fitted on the rows that rules judge.

    URLs that are null or hold no ``://`` have an empty host and path, so the model judges
    them by what they have. Repeated rows are judged alike and each; other columns are
    ignored; an empty table gives an empty result. No shuffle of the rows that are judged:
    what the model needs of other rows is broadcast tables of fixed size.
    """
    parts = with_parts(pages, rules, id_col, url_col)
    if model is None:
        model = train(labelled_by_rules(parts, rules), max_rows)
    host, path = F.col("host"), F.col("path")
    rows = parts.select(
        "page_id",
        "host",
        "path",
        "rule",
        *lexical_bins(F.col("url"), host, path),
        *suffix_buckets(host, path),
    )
    scored = _with_shares(rows, model.statistics, model.prior)
    by_rule = rule_verdict(F.col("rule"), rules)
    by_model = F.when(F.col("_score") > 0, "block").otherwise("allow")
    return scored.withColumn("_score", model.score()).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce(by_rule, by_model).alias("verdict"),
        (1 / (1 + F.exp(-F.col("_score")))).alias("block_probability"),
    )
