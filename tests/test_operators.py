import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.operators.joins import lookup_join, spread_nulls
from clickloom.operators.keyed_table import KeyedTable
from clickloom.operators.keys import with_dense_key
from clickloom.operators.latest import latest_per_key
from clickloom.operators.nested_ranges import locate_innermost
from clickloom.operators.ranges import locate_in_ranges
from clickloom.operators.snapshots import upsert
from clickloom.workspace import materialise


def rows(df):
    return sorted(map(str, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """20 000 rows, a third of them full copies of one row."""
    base = spark.range(20_000, numPartitions=7)
    hot = F.col("id") % 3 == 0
    return base.select(
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        F.when(hot, F.lit(0)).otherwise(F.col("id")).alias("v"),
    )


def test_dense_key_equals_global_window(spark, skewed, small_scans):
    keyed = with_dense_key(skewed, "n", [F.asc_nulls_first("k"), F.asc_nulls_first("v")])
    expected = skewed.withColumn("n", F.row_number().over(Window.orderBy("k", "v")))
    assert rows(keyed.select("n", "k", "v")) == rows(expected.select("n", "k", "v"))


def test_dense_key_splits_full_copies(spark, skewed, small_scans):
    written = materialise(skewed, "skewed").withColumn(
        "place", F.xxhash64("_metadata.file_path", "_metadata.row_index")
    )
    keyed = with_dense_key(written, "n", [F.asc("k"), F.asc("v")], spread=F.col("place"))
    expected = skewed.withColumn("n", F.row_number().over(Window.orderBy("k", "v")))
    assert rows(keyed.select("n", "k", "v")) == rows(expected.select("n", "k", "v"))


def test_dense_key_has_one_single_partition_step_over_counts(spark, skewed):
    plan = plan_of(with_dense_key(skewed, "n", [F.asc("k"), F.asc("v")]))
    assert plan.count("SinglePartition") == 1
    # it orders the per-partition counts, not rows
    assert re.search(r"Window .*_part.*rows|sum\(_rows", plan, re.S)


def test_dense_key_writes_kept_columns_alone(spark, skewed):
    order = [F.col(c).asc_nulls_first() for c in skewed.columns]
    whole, kept = with_dense_key(skewed, "n", order), with_dense_key(skewed, "n", order, keep=skewed.columns[:1])
    assert kept.columns == ["n", skewed.columns[0]]
    assert rows(kept) == rows(whole.select(*kept.columns))
    (scan, *_) = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(kept))
    assert skewed.columns[-1] not in scan


def test_dense_key_of_nothing(spark):
    empty = spark.createDataFrame([], "k string")
    assert with_dense_key(empty, "n", [F.asc("k")]).count() == 0


def test_latest_combines_before_the_shuffle(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "q"), ("b", None, "p"), ("c", 2, "m"), ("c", 2, "n")],
        "k string, t int, v string",
    )
    newest = latest_per_key(df, ["k"], [F.col("t").desc_nulls_last()])
    assert [(r.k, r.v) for r in newest.orderBy("k").collect()] == [("a", "y"), ("b", "p"), ("c", "m")]
    plan = plan_of(newest)
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    left = materialise(skewed, "left").withColumn("row", F.monotonically_increasing_id())
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k7", 4), ("none", 5)], "k string, w int")
    plain = left.join(right, "k", how)
    salted = lookup_join(left, right, ["k"], how, "row", share=0.01, min_rows=100, salts=8)
    assert "_salt" in plan_of(salted)
    assert rows(salted.select("k", "v", "w")) == rows(plain.select("k", "v", "w"))
    assert "_salt" not in plan_of(lookup_join(left, right, ["k"], how, "row"))


def test_spread_nulls_never_matches(spark):
    left = spark.createDataFrame([(None,), (None,), ("a",), ("",)], "k string").withColumn(
        "row", F.monotonically_increasing_id()
    )
    right = spark.createDataFrame([("a", 1), ("", 2)], "k string, w int")
    spread = left.withColumn("k", spread_nulls(F.col("k"), F.col("row")))
    assert spread.select("k").distinct().count() == 4
    assert sorted(r.w or 0 for r in spread.join(right, "k", "left").collect()) == [0, 0, 1, 2]


def test_ranges_match_brute_force(spark, small_scans):
    random.seed(5)
    edges = sorted(random.sample(range(100_000), 800))
    spans = [(f"{a:06d}", f"{b - 1:06d}", i) for i, (a, b) in enumerate(zip(edges[::2], edges[1::2]))]
    picks = [random.randrange(100_000) for _ in range(3000)] + [edges[0], edges[1] - 1, edges[1]] + [4242] * 2000
    points = spark.createDataFrame([(f"{p:06d}",) for p in picks] + [(None,)], "p string")
    spans.append((None, "999999", -1))
    ranges = spark.createDataFrame(spans, "low string, high string, tag int")
    got = locate_in_ranges(points, "p", ranges, "low", "high")
    plain = points.join(ranges, (points.p >= ranges.low) & (points.p <= ranges.high), "left")
    assert rows(got.select("p", "tag")) == rows(plain.select("p", "tag"))
    assert "NestedLoop" not in plan_of(got)


def test_range_wider_than_a_partition(spark):
    ranges = spark.createDataFrame([("000000", "999999", "all")], "low string, high string, tag string")
    points = spark.range(5000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("p"))
    got = locate_in_ranges(points, "p", ranges, "low", "high")
    assert got.where("tag = 'all'").count() == 5000


def test_overlapping_ranges_are_refused(spark, small_scans):
    points = spark.createDataFrame([("105",), ("200",)], "p string")
    lone = [(f"{k:04d}", f"{k:04d}", k) for k in range(2000, 2400)]
    for spans in ([("000", "999", 1), ("100", "110", 2)], [("100", "110", 1), ("100", "110", 1)], [("0000", "9999", 1), *lone]):
        ranges = spark.createDataFrame(spans, "low string, high string, tag int")
        with pytest.raises(ValueError, match="overlap"):
            locate_in_ranges(points, "p", ranges, "low", "high")


@pytest.fixture
def many_parts(spark):
    """Small axes stay in several partitions."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def innermost(spans, p):
    around = [s for s in spans if s[0] is not None and s[1] is not None and s[0] <= p <= s[1]]
    return max(around, key=lambda s: (s[0], -s[1], s[2]), default=(None, None, None))


def crossing(draw):
    return [(a, a + draw.choice([0, 3, 50, 2000]), k) for k, a in enumerate(draw.choices(range(9000), k=700))]


def nested(draw):
    """Blocks within blocks, down to single points, with gaps."""
    spans, todo = [], [(0, 8191)]
    while todo:
        a, b = todo.pop()
        if draw.random() < 0.8:
            spans.append((a, b, len(spans)))
        if b > a:
            todo += [(a, (a + b) // 2), ((a + b) // 2 + 1, b)] if draw.random() < 0.9 else []
    return spans


def onion(draw):
    """Every range holds all later ones."""
    return [(k, 9000 - k, k) for k in range(2000)]


@pytest.mark.parametrize("shape", [crossing, nested, onion])
def test_innermost_range_matches_brute_force(spark, many_parts, small_scans, shape):
    draw = random.Random(11)
    spans = shape(draw)
    spans += [(100, 100, -5), (100, 100, -6), (100, 100, -5), (5, None, -7), (None, 9, -8), (60, 50, -9)]
    picks = draw.choices(range(-50, 9500), k=3000) + [100] * 1000 + [s[1] for s in spans[:300]]
    points = spark.createDataFrame([(p,) for p in picks] + [(None,)], "p int")
    ranges = spark.createDataFrame(spans, "low int, high int, tag int")
    got = sorted((r.p, r.low, r.high, r.tag) for r in locate_innermost(points, "p", ranges, "low", "high").where("p IS NOT NULL").collect())
    by_point = {p: innermost(spans, p) for p in set(picks)}
    assert [(p, tag) for p, _, _, tag in got] == sorted((p, by_point[p][2]) for p in picks)


def test_innermost_range_spreads_hot_points_and_ranges(spark, many_parts, monkeypatch):
    """One range holds nearly all points, one point a third of all rows; both are salted."""
    monkeypatch.setattr("clickloom.operators.joins.HOT_ROWS", 1000)
    points = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("p"))
    ranges = spark.createDataFrame([(0, 19_990, "wide"), (5, 9, "narrow")], "low long, high long, tag string")
    got = locate_innermost(points, "p", ranges, "low", "high")
    assert "_salt" in plan_of(got)
    counts = {r.tag: r["count"] for r in got.groupBy("tag").count().collect()}
    rows_at = [7 if k % 3 == 0 else k for k in range(20_000)]
    narrow = sum(5 <= p <= 9 for p in rows_at)
    missed = sum(p > 19_990 for p in rows_at)
    assert counts == {"narrow": narrow, "wide": 20_000 - narrow - missed, None: missed}


def test_innermost_range_of_empty_tables(spark):
    points = spark.createDataFrame([("1",), (None,)], "p string")
    ranges = spark.createDataFrame([("0", "5", "a")], "low string, high string, tag string")
    assert locate_innermost(points, "p", ranges.limit(0), "low", "high").where("tag IS NULL").count() == 2
    assert locate_innermost(points.limit(0), "p", ranges, "low", "high").count() == 0
    assert locate_innermost(points, "p", ranges, "low", "high").where("tag = 'a'").count() == 1


def test_range_points_may_repeat_or_be_missing(spark):
    ranges = spark.createDataFrame(
        [("100", "199", "a"), ("300", None, "b"), ("500", "400", "c")], "low string, high string, tag string"
    )
    points = spark.createDataFrame([("150", 1), ("150", 2), ("350", 3), ("450", 4), (None, 5)], "p string, v int")
    got = locate_in_ranges(points, "p", ranges, "low", "high").select("v", "tag").orderBy("v").collect()
    assert [(r.v, r.tag) for r in got] == [(1, "a"), (2, "a"), (3, None), (4, None), (5, None)]
    assert locate_in_ranges(points, "p", ranges.limit(0), "low", "high").where("tag IS NULL").count() == 5
    assert locate_in_ranges(points.limit(0), "p", ranges, "low", "high").count() == 0


def test_repeated_points_meet_ranges_once(spark, small_scans):
    """A third of the points are copies of one: the axis holds it once, its rows are salted."""
    points = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("p"), F.lit("x").alias("v")
    )
    ranges = spark.range(200).select((F.col("id") * 100).alias("low"), (F.col("id") * 100 + 99).alias("high"))
    rows = materialise(points, "points").withColumn("_row", F.monotonically_increasing_id())
    looked = lookup_join(rows, ranges.withColumn("p", F.col("low")), ["p"], "left", "_row", min_rows=1000)
    assert "_salt" in plan_of(looked)
    got = locate_in_ranges(points, "p", ranges, "low", "high")
    assert got.count() == 20_000
    assert got.where("p < low OR p > high OR low IS NULL").count() == 0


def test_upsert_keeps_last_write_and_is_repeatable(spark):
    old = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old")], "k string, t int, v string")
    new = spark.createDataFrame([("b", 2, "mid"), ("b", 3, "new"), ("c", 1, "new")], "k string, t int, v string")
    once = upsert(old, new, ["k"], [F.desc_nulls_last("t")])
    assert rows(once.select("k", "v")) == rows(
        spark.createDataFrame([("a", "old"), ("b", "new"), ("c", "new")], "k string, v string")
    )
    twice = upsert(once, new, ["k"], [F.desc_nulls_last("t")])
    assert rows(twice) == rows(once)


def keyed(spark, tmp_path, n=2000, size=100):
    table = KeyedTable(spark, f"{tmp_path}/t", "k", rows_per_file=size)
    base = spark.range(n).select(F.format_string("k%06d", F.col("id") * 10).alias("k"), F.lit(0).alias("v"), F.lit("x").alias("file"))
    table.replace(base)
    return table, base


def names(table):
    return {r.file for r in table.files().collect()}


def test_upsert_rewrites_touched_files_only(spark, tmp_path, small_scans):
    table, base = keyed(spark, tmp_path)
    before = names(table)
    # one percent of the keys, close together; some are new and lie between old ones
    batch = spark.createDataFrame([(f"k{k:06d}", 1, "y") for k in range(10_000, 10_200, 5)], "k string, v int, file string")
    merge = table.upsert(batch, [F.col("v").desc()])
    after = names(table)
    assert len(before) >= 15 and merge.kept == len(before & after) >= len(before) - 3
    assert merge.rewritten == len(before - after) and merge.written == len(after - before)
    assert rows(table.read()) == rows(upsert(base, batch, ["k"], [F.col("v").desc()]))
    spans = sorted((r.low, r.high) for r in table.files().collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_small_files_take_no_task_each(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", "k", rows_per_file=10)
    table.replace(spark.range(2000).select(F.format_string("k%06d", F.col("id") % 1900).alias("k"), "id"))
    files = table.files().collect()
    assert len(files) >= 180 and all(f.rows < 30 for f in files)
    assert len({re.search(r"part-(\d+)", f.file)[1] for f in files}) <= 8
    spans = sorted((f.low, f.high) for f in files)  # rows of one key lie in one file
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_upsert_at_both_ends_nulls_and_ties(spark, tmp_path):
    table, base = keyed(spark, tmp_path, 300)
    expected = base
    for keys in (["a", "z", "zz"], [None, None, "a"], ["k000010", "k000010", "m"], []):
        batch = spark.createDataFrame([(k, i, "y") for i, k in enumerate(keys)], "k string, v int, file string")
        table.upsert(batch, [F.col("v").desc()])
        expected = materialise(upsert(expected, batch, ["k"], [F.col("v").desc()]), "expected")
        assert rows(table.read()) == rows(expected)


def test_upsert_into_an_empty_table(spark, tmp_path):
    table, base = keyed(spark, tmp_path, 0)
    assert table.read().columns == base.columns and table.read().count() == 0
    batch = spark.createDataFrame([("b", 1, "y"), ("a", 2, "y")], "k string, v int, file string")
    table.upsert(batch, [F.col("v").desc()])
    assert rows(table.read()) == rows(batch)


def test_nearest_start(spark, small_scans):
    points = spark.createDataFrame([("a",), ("c",), ("c5",), ("z",), (None,)], "p string")
    starts = spark.createDataFrame([("c", 1), ("f", 2)], "low string, tag int")
    got = {r.p: r.tag for r in locate_in_ranges(points, "p", starts, "low", "low", to_next=True).collect()}
    assert got == {"a": None, "c": 1, "c5": 1, "z": 2, None: None}
