"""URL filter: parts and rules against plain Python, trees against a fit on whole rows."""

import math
import random

import pytest

from clickloom.llm import urls
from clickloom.llm.urls import (
    BINS,
    FEATURES,
    RULES,
    _UNIT,
    judge_urls,
    labelled_by_rules,
    train,
    with_parts,
)

ODD = [
    None,
    "",
    "no scheme",
    "http://",
    "http://org",
    "http://org/",
    "HTTP://WWW.EXAMPLE.ORG/en/1?x=1&y=2#z",
    "http://notorg/",
    "http://a.example.org/es/x#/y",
    "http://example.org/en/2",
    "ftp://x.com/fr/?a=http://b.com/de/",
    "x://com/de/é",
    "http://com?/fr/",
    "http://ÄB.Com/de/",
    "http://h.net/" + "a/1?" * 20_000,
    "http://h.net/" + "".join(chr(0x4E00 + k) for k in range(5_000)),
]


def parts_of(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    path = path[:end]
    best = None
    for verdict, rule in RULES:
        suffix, prefix = rule.split("/", 1)
        if (host == suffix or host.endswith("." + suffix)) and path.startswith("/" + prefix):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return host, path, best


def made_up(n, seed=1):
    """Long, digit-rich URLs with parameters are bad; the path shows the label to the rules."""
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        bad = draw.random() < 0.4
        tail = "".join(draw.choice("0123456789") for _ in range(12)) if bad else draw.choice(["news", "about"])
        query = "?a=1&b=2&c=3" if bad and draw.random() < 0.7 else ""
        labelled = draw.random() < 0.5
        lang = ("de" if bad else "fr") if labelled else "it"
        rows.append((k, f"https://h{draw.randrange(9)}.com/{lang}/{tail}{query}", bad))
    return rows


def test_parts_and_rules(spark):
    pages = spark.createDataFrame(
        [(k, u, "h", 1) for k, u in enumerate(ODD + ODD[:3])], "page_id long, url string, host string, rule int"
    )
    rows = {r.page_id: r for r in judge_urls(pages).collect()}
    assert len(rows) == len(ODD) + 3
    for k, url in enumerate(ODD + ODD[:3]):
        host, path, best = parts_of(url)
        assert (rows[k].host, rows[k].path) == (host, path)
        assert rows[k].rule == (best and best[1])
        assert rows[k].verdict in ("allow", "block")
        if best:
            assert rows[k].verdict == best[0]


def test_model_judges_unseen_urls(spark):
    rows = made_up(1500)
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string").repartition(3)
    found = {r.page_id: r for r in judge_urls(pages).collect()}
    unseen = [(bad, found[k].verdict == "block") for k, _, bad in rows if found[k].rule is None]
    assert len(unseen) > 500
    assert sum(a == b for a, b in unseen) > 0.95 * len(unseen)
    again = {r.page_id: r for r in judge_urls(pages.repartition(7)).collect()}
    assert again == found


def reference_trees(rows, y, base, trees=12, depth=3, rate=0.4, penalty=1.0, least=1.0):
    """Scores of a fit in which every node looks at its own rows."""
    score = [base] * len(rows)
    for _ in range(trees):
        p = [1 / (1 + math.exp(-s)) for s in score]
        g = [math.floor((t - q) * _UNIT + 0.5) if t else -math.floor(q * _UNIT + 0.5) for t, q in zip(y, p)]
        h = [max(1, math.floor(q * (1 - q) * _UNIT + 0.5)) for q in p]
        grown = False
        nodes = [(list(range(len(rows))), 0.0)]
        for _ in range(depth):
            children = []
            for members, value in nodes:
                best = None
                for f in range(len(FEATURES)):
                    seen = sorted({rows[i][f] for i in members})
                    for b, following in zip(seen, seen[1:]):
                        left = [i for i in members if rows[i][f] <= b]
                        right = [i for i in members if rows[i][f] > b]
                        (gl, hl), (gr, hr) = ((sum(g[i] for i in s), sum(h[i] for i in s)) for s in (left, right))
                        if min(hl, hr) < least * _UNIT:
                            continue
                        w = penalty * _UNIT
                        gain = gl * gl / (hl + w) + gr * gr / (hr + w) - (gl + gr) ** 2 / (hl + hr + w)
                        if gain > 1e-6 * _UNIT and (best is None or gain > best[0]):
                            best = (gain, (left, rate * gl / (hl + w)), (right, rate * gr / (hr + w)))
                if best:
                    grown = True
                    children += best[1:]
                else:
                    children.append((members, value))
            nodes = children
        if not grown:
            break
        for members, value in nodes:
            for i in members:
                score[i] += value
    return score


def test_trees_match_a_fit_on_whole_rows(spark, monkeypatch):
    kept = {}
    write = urls.materialise

    def spy(df, name, *rest):
        kept[name] = write(df, name, *rest)
        return kept[name]

    monkeypatch.setattr(urls, "materialise", spy)
    draw = random.Random(5)
    rows = [(k, u if draw.random() < 0.8 else u.replace("/de/", "/fr/")) for k, u, _ in made_up(300, 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    model = train(labelled_by_rules(with_parts(pages, RULES, "page_id", "url"), RULES))
    assert model.trees
    sample = kept["url-sample"].withColumn("score", model.score()).collect()
    assert all(0 <= r[f] < BINS for r in sample for f in FEATURES)
    expected = reference_trees([[r[f] for f in FEATURES] for r in sample], [r.blocked for r in sample], model.base)
    assert [r.score for r in sample] == pytest.approx(expected, abs=1e-6)


def test_sample_is_bounded_and_statistics_are_not(spark, monkeypatch):
    kept = {}
    write = urls.materialise
    monkeypatch.setattr(urls, "materialise", lambda df, name, *r: kept.setdefault(name, write(df, name, *r)))
    pages = spark.createDataFrame([r[:2] for r in made_up(800)], "page_id long, url string")
    labelled = labelled_by_rules(with_parts(pages, RULES, "page_id", "url"), RULES)
    train(labelled, max_rows=100, trees=1)
    assert kept["url-sample"].count() <= 100
    assert kept["url-suffixes"].where(f"bucket < {urls.SUFFIX_BUCKETS}").agg({"n": "sum"}).first()[0] == labelled.count()


@pytest.mark.parametrize(
    "given, verdict", [(["http://a.net/"], "allow"), (["http://a.com/de/"] * 9 + ["http://a.net/"], "block"), ([], None)]
)
def test_no_labels_one_label_no_rows(spark, given, verdict):
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(given)], "page_id long, url string")
    rows = judge_urls(pages).collect()
    assert len(rows) == len(given)
    assert all(r.verdict == verdict for r in rows if r.rule is None)


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = judge_urls(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
