"""Line and near-duplicate detection, search and the pipeline against brute force."""

import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from clickloom.llm import line_dedup, simhash, topk
from clickloom.llm.components import connected

SMALL = "/root/testdata/sf0.001"


def removed(rows, threshold=0.8):
    """Lines that match an earlier one, by an inverted index."""
    lines, postings, gone = [], defaultdict(list), set()
    for i, t in sorted((i, t or "") for i, t in rows if i is not None):
        for k, line in enumerate(t.split("\n")):
            words = frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line) if w)
            if words:
                lines.append(((i, k), words))
    for at, (place, words) in enumerate(lines):
        shared = defaultdict(int)
        for w in words:
            for j in postings[w]:
                shared[j] += 1
            postings[w].append(at)
        for j, n in shared.items():
            if n / (len(words) + len(lines[j][1]) - n) >= threshold - 1e-12 and lines[j][0] < place:
                gone.add(place)
    return gone


LINES = [
    (1, "the first line of all\nanother one here\n\nthe first line of all"),
    (2, "all of line first the\n \nshort"),
    (3, None),
    (4, ""),
    (5, "short\nw" + " w".join(map(str, range(50)))),
    (6, "w" + " w".join(map(str, range(48)))),
    (None, "short"),
    (7, "w" + " w".join(map(str, range(3, 50)))),
    (8, "x" * 70000 + "\n" + "x" * 70000),
]


def test_removed_lines_join_on_one_hash(spark):
    """The last join carries ids, line numbers and one hash: half the bytes of two."""
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e\nx y z"), (2, "other words here")], "doc_id long, text string")
    found = line_dedup.removed_lines(docs)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    carried = [line for line in plan if "Join" in line or "Project" in line]
    assert carried and not any("set2" in line for line in carried)
    assert sorted(map(tuple, found.collect())) == [(2, 0)]


@pytest.mark.parametrize("witnesses, block", [(4, 512), (1, 3)])
def test_removed_lines(spark, monkeypatch, witnesses, block):
    monkeypatch.setattr(line_dedup, "FIRST_WITNESSES", witnesses)
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    given = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(i, t) for i, t in LINES], "doc_id long, text string")
    docs = odd.unionByName(given.selectExpr("doc_id + 100", "text").toDF("doc_id", "text"))
    want = removed([(r.doc_id, r.text) for r in docs.collect()])
    found = {tuple(r) for r in line_dedup.removed_lines(docs).collect()}
    assert found == want


def test_many_variants_of_a_line(spark):
    """A large group that is compared block by block, with and without earlier witnesses."""
    draw = np.random.default_rng(2)
    base = [f"b{k}" for k in range(30)]
    rows = []
    for k in range(300):
        words = list(base)
        for at in draw.choice(30, draw.integers(1, 6), replace=False):
            words[at] = f"v{draw.integers(0, 40)}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in line_dedup.removed_lines(docs).collect()} == removed(rows)


def test_dropping_lines_keeps_documents(spark):
    docs = spark.createDataFrame(
        [(i, t, None if t is None else len(t), 1) for i, t in LINES], "doc_id long, text string, n_chars long, line int"
    )
    out = {r.doc_id: r for r in line_dedup.drop_removed_lines(docs).collect()}
    assert out[1].text == "the first line of all\nanother one here\n" and out[1].n_chars == 39
    assert out[2].text == " \nshort" and out[3].text is None and out[4].text == ""
    assert 6 not in out and None not in out and out[5].text == "w" + " w".join(map(str, range(50)))
    empty = docs.filter("doc_id = 99")
    assert line_dedup.drop_removed_lines(empty).count() == 0


def test_one_template_with_a_free_word(spark):
    """Lines that share all words but one: neither all pairs nor one task."""
    lines = [f"{draw} this line is of one template" for draw in range(100_000)]
    docs = spark.createDataFrame([(k, "\n".join(lines[k::100])) for k in range(100)], "doc_id long, text string")
    assert line_dedup.removed_lines(docs.repartition(8)).count() == 0


@pytest.mark.parametrize("hot", [1, 40])
def test_hot_tokens_are_dealt_out(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT_ROWS", hot)
    draw = np.random.default_rng(8)
    rows = []
    for k in range(700):
        words = [f"c{j}" for j in draw.choice(14, draw.integers(6, 12), replace=False)]
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in line_dedup.removed_lines(docs).collect()} == removed(rows)


def test_rows_that_repeat_an_id_are_documents_of_their_own(spark):
    a, b = "alpha beta gamma delta epsilon zeta eta", "a totally different text of many other words"
    rows = [(1, a, 0, 0), (1, b, 0, 0), (2, a, 0, 0), (None, b + " here", 0, 0), (None, "one more " + a, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int, _gone int").coalesce(1)
    texts = lambda df: sorted(r.text for r in df.collect())
    assert texts(line_dedup.drop_removed_lines(docs)) == sorted([a, b, "one more " + a])
    kept = simhash.near_unique(docs)
    assert kept.columns == docs.columns
    assert texts(kept) == sorted([a, b, b + " here", "one more " + a])
    assert simhash.near_unique(docs.filter("doc_id = 9")).count() == 0
    assert line_dedup.removed_lines(docs.filter("doc_id = 9")).count() == 0
    assert simhash.simhash_groups(docs.filter("doc_id = 9")).count() == 0


def test_long_document_of_repeated_lines(spark):
    docs = spark.createDataFrame([(1, "the same line again\n" * 40_000 + "end")], "doc_id long, text string")
    assert line_dedup.drop_removed_lines(docs).first().text == "the same line again\nend"


def plain_print(text, size=3):
    text = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, distance):
    roots = list(range(len(prints)))

    def root(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                roots[root(a)] = root(b)
    return [root(k) for k in range(len(prints))]


def test_simhash_groups(spark):
    given = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(
        [(900, None), (901, ""), (902, "ÀB Cd"), (903, "Àb cD"), (904, " \n"), (904, " \n")],
        "doc_id long, text string",
    )
    docs = given.unionByName(odd)
    rows = [(r.doc_id, plain_print(r.text)) for r in docs.collect()]
    label = groups([p for _, p in rows], 2)
    least = defaultdict(lambda: 10**9)
    for (i, _), g in zip(rows, label, strict=True):
        least[g] = min(least[g], i)
    want = sorted((i, f"{p:016x}", least[g]) for (i, p), g in zip(rows, label, strict=True))
    assert sorted(map(tuple, simhash.simhash_groups(docs).collect())) == want
    kept = [r.doc_id for r in simhash.near_unique(docs.coalesce(1)).collect()]
    assert sorted(kept) == sorted({i for i, _, c in want if i == c})


@pytest.mark.parametrize("distance", [0, 1, 2])
@pytest.mark.parametrize("pairwise", [16, 1])
def test_links_of_close_fingerprints(spark, monkeypatch, distance, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    draw = np.random.default_rng(distance)
    prints = set()
    for _ in range(12):
        chain = int(draw.integers(0, 1 << 62)) * 3
        for _ in range(12):
            prints.add(chain % (1 << 64))
            for b in draw.choice(64, draw.integers(1, 4), replace=False):
                chain ^= 1 << int(b)
    prints = [p - (p >> 63 << 64) for p in sorted(prints)]
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = simhash.similar_links(df, distance) if distance else None
    label = groups([p % (1 << 64) for p in prints], distance)
    want = {p: min(q for q, h in zip(prints, label, strict=True) if h == g) for p, g in zip(prints, label, strict=True)}
    got = {r.node: r.root for r in connected(links).collect()} if distance else {}
    assert {p: got.get(p, p) for p in prints} == want


def test_fuzzy_keys_meet_within_the_distance():
    draw = np.random.default_rng(1)
    prints = draw.integers(0, 1 << 63, 2000, dtype=np.uint64) * np.uint64(2)
    other = prints.copy()
    for k in range(len(other)):
        for b in draw.choice(64, 2, replace=False):
            other[k] ^= np.uint64(1) << np.uint64(b)
    for a, b in zip(simhash.fuzzy_keys(prints, 2), simhash.fuzzy_keys(other, 2), strict=True):
        assert set(a.tolist()) & set(b.tolist())


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(40)] + [(7, 7)]
    found = {r.node: r.root for r in connected(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {k: 0 for k in range(61)} | {100 + k: 100 for k in range(40)}
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    draw = np.random.default_rng(4)
    rows = [(k, [float(x) for x in draw.normal(0, 1, 6).round(1)], k) for k in range(200)]
    rows += [(200, None, 0), (250, [1.0, float("nan")], 0), (300, [1.0, None], 0), (350, [], 0)]
    rows += [(51, rows[51][1], 1), (50, rows[50][1], 1), (400, [1e6, -3.0], 0), (None, [1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    found = defaultdict(list)
    for r in topk.top_k(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.score, r.vec_id))
    valid = [
        (i, [int(np.floor(256 * x)) for x in v])
        for i, v, _ in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    for q, w in {i: v for i, v in valid if i % 50 == 0}.items():
        scores = [(sum(a * b for a, b in zip(w, v, strict=False)), i) for i, v in valid if i != q]
        assert found.pop(q) == sorted(scores, key=lambda x: (-x[0], x[1]))[:5]
    assert not found
    assert topk.top_k(df.filter("vec_id = 1000"), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_finds_other_rows_of_the_query_id(spark):
    rows = [(50, [1.0, 2.0]), (50, [1.0, 3.0]), (50, [1.0, 3.0]), (7, [0.5, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.top_k(df, F.col("vec_id") % 50 == 0)
    one, two, both = (256 * 256 * x for x in (0.5, 0.5, 7))
    wanted = [(50, 1, 50, both), (50, 2, 50, both), (50, 3, 7, one), (50, 1, 50, both), (50, 2, 7, two)]
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept[-1], SMALL).cache()
        assert out.columns == columns
        assert out.join(kept[-1], "doc_id", "left_anti").count() == 0
        kept.append(out)
    sizes = [d.count() for d in kept]
    assert sizes == sorted(sizes, reverse=True) and sizes[3] == sizes[4] > 0
    packed = corpus_pipeline.run(spark, SMALL)
    assert packed.select("doc_id").distinct().count() == sizes[-1]


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    """Null and repeated ids, empty and null texts, clashing names: no text of its own goes."""
    given = spark.read.parquet(f"{SMALL}/documents.parquet").limit(30)
    unlike = ["one text that stands alone among all these rows here", "quite another text under the very same id, unlike it"]
    rows = [(7, unlike[0]), (7, unlike[1]), (None, "a row that has no id but words of its own, eleven in all"), (8, None), (9, "")]
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    for name in given.columns[2:]:
        odd = odd.withColumn(name, F.lit(None).cast(given.schema[name].dataType))
    docs = given.unionByName(odd.select(given.columns)).withColumn("_row", F.lit(1)).withColumn("__id", F.lit("x"))
    path = str(tmp_path / "docs")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    wanted = {t for _, t in rows if t}
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        docs_out = stage(spark, docs, SMALL)
        assert docs_out.columns == docs.columns
        out = str(tmp_path / name)
        docs_out.write.parquet(out)
        docs = spark.read.parquet(out)
        assert wanted <= {r.text for r in docs.collect()}, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() > 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0
