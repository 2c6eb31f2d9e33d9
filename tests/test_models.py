"""Staging and mart semantics on handwritten rows."""

import os
import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clickloom.plans import sketches
from clickloom.plans.order_bitmaps import distinct_orders, order_bitmaps
from clickloom.sources.versions import VersionedTable
from clickloom import workspace
from clickloom.workspace import materialise
from clickloom.plans import bi, checks, collection, diagnostics, mart, profiling, staging
from clickloom.sources.schemas import EVENTS, IP_LOCATIONS, PRODUCTS

DAY = 1704067200  # 2024-01-01 00:00:00 UTC


def table(spark, schema, *rows):
    """Rows as dicts; absent columns are NULL."""
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def checkout(oid, **fields):
    base = {
        "_id": f'{{"$oid":"{oid}"}}',
        "time_stamp": DAY,
        "collection": "checkout_success",
        "device_id": "d1",
        "order_id": f"o-{oid}",
        "country": "France",
        "city": "Paris",
        "price": "100",
        "currency": "EUR",
    }
    return base | fields


def lines_of(spark, *rows):
    staged = staging.checkout_events(table(spark, EVENTS, *rows))
    got = staging.checkout_line_items(staged).orderBy("line_item_id").collect()
    return [(r.line_item_id, r.product_id, r.order_qty, None if r.line_amount is None else float(r.line_amount)) for r in got]


def test_checkout_filter_and_casts(spark):
    rows = [
        checkout("a", event_name="other"),
        checkout("b", collection="x", event_name="checkout_success", price="1e2", is_paypal="1"),
        checkout("c", _id='{"oid":"c"}'),
        checkout("d", _id=None),
        checkout("e", price="n/a", time_stamp=None),
    ]
    got = {r.event_id: r for r in staging.checkout_events(table(spark, EVENTS, *rows)).collect()}
    assert sorted(got) == ["b", "e"]
    assert got["b"].price_raw == Decimal("100") and got["b"].is_price_valid
    assert (got["b"].event_ts, got["b"].event_date) == (datetime(2024, 1, 1), date(2024, 1, 1))
    assert got["e"].price_raw is None and not got["e"].is_price_valid and got["e"].event_date is None


def test_cart_fallbacks_and_gaps(spark):
    cart = (
        '[{"product_id":{"v":1},"id":"7","qty":"2.0","quantity":3,"price":"1,5","amount":"9.5"},'
        '{"sku":"none"},{"productId":8,"order_qty":"4","line_amount":2},{"id":"9"}]'
    )
    assert lines_of(spark, checkout("a", cart_products=cart)) == [
        ("a-1", "7", 3, 9.5),
        ("a-3", "8", 4, 2.0),
        ("a-4", "9", 1, 100.0),
    ]


@pytest.mark.parametrize("cart", ["[]", None, '{"product_id":"9"}', "broken", '[{"sku":1}]'])
def test_event_level_line_where_the_cart_gives_none(spark, cart):
    assert lines_of(spark, checkout("a", cart_products=cart, product_id="5")) == [("a-1", "5", 1, 100.0)]
    assert lines_of(spark, checkout("a", cart_products=cart)) == []


def test_cart_of_a_namesake_event_suppresses_the_fallback(spark):
    rows = [checkout("a", cart_products='[{"id":"1"}]'), checkout("a", product_id="5")]
    assert [line[1] for line in lines_of(spark, *rows)] == ["1"]


def test_unit_price_and_zero_quantity(spark):
    cart = '[{"id":"1","qty":3,"price":10},{"id":"2","qty":0,"price":10}]'
    staged = staging.checkout_events(table(spark, EVENTS, checkout("a", cart_products=cart)))
    got = [r.unit_price for r in staging.checkout_line_items(staged).orderBy("line_number").collect()]
    assert got == [Decimal("3.333333333"), None]


def ip(address, **fields):
    base = {"ip": address, "country_short": "FR", "country_long": "France", "region": "IDF", "city": "Paris"}
    return base | {"latitude": 48.0, "longitude": 2.0, "updated_at": datetime(2024, 1, 1)} | fields


def product(pid, **fields):
    return {"product_id": pid, "product_name": f"Ring {pid}", "status": 200, "updated_at": datetime(2024, 1, 1)} | fields


def build(spark, events, ips, products):
    return mart.build_mart(
        table(spark, EVENTS, *events), table(spark, PRODUCTS, *products), table(spark, IP_LOCATIONS, *ips)
    )


def test_latest_versions_and_coordinate_limits(spark):
    ips = [
        ip("1", city="old", updated_at=datetime(2023, 1, 1)),
        ip("1", city="new", latitude=95.0, longitude=-180.0),
        ip("1", city="undated", updated_at=None),
    ]
    (row,) = staging.latest_ip_locations(table(spark, IP_LOCATIONS, *ips)).collect()
    assert (row.city_name, row.latitude, row.longitude) == ("new", None, -180.0)
    versions = [product("1", status=404), product("1", status=None, updated_at=datetime(2024, 2, 1)), product(None)]
    (row,) = staging.latest_products(table(spark, PRODUCTS, *versions)).collect()
    assert row.crawl_status_code is None and row.is_crawl_success is None


def test_dim_date_is_gapless(spark):
    staged = staging.checkout_events(
        table(spark, EVENTS, checkout("a"), checkout("b", time_stamp=DAY + 86400 * 9 + 5))
    )
    got = mart.dim_date(staged).orderBy("date_key").collect()
    assert [r.date_key for r in got] == [20240101 + i for i in range(10)]
    assert (got[0].day_of_week, got[0].day_of_week_number, got[0].week_of_year) == ("Monday", 2, 0)
    assert [r.is_weekend for r in got[:7]] == [False] * 5 + [True, True]
    nothing = staging.checkout_events(table(spark, EVENTS))
    assert mart.dim_date(nothing).count() == 0


def test_fact_drops_and_fans_out_as_specified(spark):
    events = [
        checkout("plain", product_id="1", ip="9"),
        checkout("no_device", product_id="1", device_id=None, user_id_db="u"),
        checkout("unknown_product", product_id="404"),
        checkout("no_place", product_id="1", country=None, city=None),
        # NULL and '' are the same customer to the join, but two customers in the dimension
        checkout("null_user", product_id="1", device_id="d2"),
        checkout("blank_user", product_id="1", device_id="d2", user_id_db=""),
        # one place with two coordinates
        checkout("two_spots", product_id="1", device_id="d3", ip="1"),
        checkout("other_spot", product_id="404", device_id="d3", ip="2"),
    ]
    m = build(spark, events, [ip("1"), ip("2", latitude=49.0)], [product("1")])
    counts = {r.event_id: r["count"] for r in m.fact.groupBy("event_id").count().collect()}
    assert counts == {"plain": 1, "null_user": 2, "blank_user": 2, "two_spots": 2}
    keys = sorted(r.sales_order_line_key for r in m.fact.collect())
    assert keys == list(range(1, 8))
    sources = {r.event_id: r.geo_source for r in mart.event_geo(m.checkouts, m.ip_locations).collect()}
    assert sources["two_spots"] == "ip2location" and sources["plain"] == "event_fallback"


def test_repeated_event_id_multiplies_and_is_reported(spark):
    events = [checkout("a", product_id="1"), checkout("a", product_id="1")]
    m = build(spark, events, [], [product("1")])
    assert m.lines.count() == 2
    # two lines x two events x two places
    assert m.fact.count() == 8
    assert m.fact.select("sales_order_line_key").distinct().count() == 8
    assert checks.repeated_values(m.checkouts, "event_id").count() == 1


def test_view_has_no_personal_columns_and_22_columns(spark):
    m = build(spark, [checkout("a", product_id="1", email_address="x@y.z")], [], [product("1")])
    view = m.view()
    assert len(view.columns) == 22
    assert not {"email_address", "ip", "device_id", "customer_key"} & set(view.columns)
    masked = mart.customer_masked(m.dim_customer)
    assert "email_address" not in masked.columns and len(masked.first().email_hash) == 64


def test_publish_and_register(spark, tmp_path):
    m = build(spark, [checkout("a", product_id="1")], [], [product("1")])
    m.publish(str(tmp_path))
    m.publish(str(tmp_path))
    assert mart.read_published(spark, str(tmp_path), "fact_sales_order_detail").count() == 1
    m.register()
    row = spark.sql("select sum(sales_amount) s, max(metal_type) m from vw_sales_performance").first()
    assert (float(row.s), row.m) == (100.0, "Not Defined")


def test_pruned_view_and_totals_agree_with_the_whole_view(spark):
    cart = '[{"id":"1","qty":2,"price":10},{"id":"2","qty":1,"price":30}]'
    events = [
        checkout("a", cart_products=cart),
        checkout("b", product_id="1", time_stamp=DAY + 86400, country="Spain"),
        checkout("undated", product_id="1", time_stamp=None),
    ]
    m = build(spark, events, [], [product("1", product_name="Ruby"), product("2")])
    assert m.fact.count() == 4 and m.view().count() == 3
    for columns in (["sales_amount"], ["stone_type", "order_id"], ["city_name", "full_date"], ["is_paypal"]):
        assert sorted(map(str, m.view(*columns).collect())) == sorted(map(str, m.view().select(*columns).collect()))
    plan = m.view("order_id", "sales_amount")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    for dimension in ("stone_type", "country_name", "full_date", "is_paypal", "currency_code"):
        whole = bi.revenue_by(m.view(), dimension)
        assert sorted(map(str, bi.revenue_by(m.totals(dimension), dimension).collect())) == sorted(map(str, whole.collect()))


def test_range_of_days_reads_its_months_only(spark, tmp_path):
    days = {"a": "2024-01-31", "b": "2024-02-01", "c": "2024-02-29", "d": "2024-03-01"}
    events = [
        checkout(name, product_id="1", order_id=name, time_stamp=int(datetime.fromisoformat(f"{day}T12:00+00:00").timestamp()))
        for name, day in days.items()
    ]
    m = build(spark, [*events, checkout("undated", product_id="1", time_stamp=None)], [], [product("1")])
    february = m.view("order_id", "full_date", first_day="2024-02-01", last_day=date(2024, 2, 29))
    assert sorted(r.order_id for r in february.collect()) == ["b", "c"]
    open_end = m.view("order_id", first_day="2024-02-29")
    assert sorted(r.order_id for r in open_end.collect()) == ["c", "d"]
    plan = february._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^]]*sales_month[^]]*)\]", plan)
    assert filters and all("202402" in f for f in filters)
    m.publish(str(tmp_path))
    published = VersionedTable(spark, f"{tmp_path}/fact_sales_order_detail").current()
    folders = {f for f in os.listdir(published) if f.startswith("sales_month")}
    assert {"sales_month=202401", "sales_month=202402", "sales_month=202403"} < folders


def test_reports(spark):
    cart = '[{"id":"1","qty":2,"price":10},{"id":"2","qty":1,"price":30}]'
    events = [
        checkout("a", cart_products=cart, is_paypal="yes"),
        checkout("b", product_id="1", time_stamp=DAY + 3 * 86400),
        checkout("c", product_id="2", order_id="o-b", time_stamp=DAY + 3 * 86400),
    ]
    products = [product("1", product_name="750 Ruby"), product("2", product_name="Silver diamond")]
    view = build(spark, events, [], products).view()
    row = bi.scorecards(view).first()
    assert (float(row.total_revenue), row.total_quantity, row.order_count) == (240.0, 5, 2)
    assert (row.daily_avg_revenue, row.daily_avg_quantity, row.avg_order_value) == (120.0, 2.5, 120.0)
    share = {r.metal_type: r.share for r in bi.share_of_revenue(view, "metal_type").collect()}
    assert share["18K Gold - 750"] == pytest.approx(110 / 240)
    assert [r.stone_type for r in bi.top_by_revenue(view, "stone_type", 1).collect()] == ["Diamond"]
    assert bi.filtered(view, ["France"], "2024-01-02", "2024-01-31", "unknown").count() == 2
    nothing = bi.scorecards(bi.filtered(view, ["Nowhere"])).first()
    assert nothing.total_revenue is None and nothing.avg_order_value is None


def test_candidates(spark):
    rows = [
        {"collection": "view_product_detail", "product_id": "1", "current_url": "u1", "time_stamp": 5},
        {"collection": "view_product_detail", "viewing_product_id": "1", "referrer_url": "u2", "time_stamp": 7},
        {"collection": "view_product_detail", "product_id": "1", "current_url": "", "referrer_url": "r", "time_stamp": 9},
        {"collection": "x", "event_name": "view_product_detail", "product_id": "2", "current_url": "u"},
        {"collection": "add_to_cart_action", "product_id": "3", "current_url": "only"},
        {"collection": "add_to_cart_action", "current_url": "no product"},
    ]
    found = collection.product_candidates(collection.product_events(table(spark, EVENTS, *rows)))
    got = {r.product_id: (r.best_url, r.last_seen_ts) for r in found.collect()}
    assert got == {"1": ("u2", 7), "3": ("only", None)}
    done = table(spark, PRODUCTS, product("1"))
    # the limit counts the product that is already done
    assert collection.crawl_queue(found, done, 1).count() == 0
    assert [r.product_id for r in collection.crawl_queue(found, done).collect()] == ["3"]
    ips = spark.createDataFrame([("b",), (" a ",), ("c",), (" ",)], "ip string")
    known = table(spark, IP_LOCATIONS, ip("a"))
    assert [r.ip for r in collection.new_ips(ips, known, 1).collect()] == ["b"]


def test_collection_tables_are_replaced(spark, tmp_path):
    row = {"collection": "view_product_detail", "product_id": "1", "current_url": "u", "ip": "1.1.1.1"}
    for _ in range(2):
        collection.publish(table(spark, EVENTS, row, row), str(tmp_path))
    names = ("unique_ips", "product_events", "product_candidates")
    counts = [VersionedTable(spark, f"{tmp_path}/{t}").read().count() for t in names]
    assert counts == [1, 2, 1]


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    table(spark, EVENTS, checkout("a")).write.parquet(path)
    raw = spark.read.parquet(path)

    def scan_of(df):
        spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
        text = df._jdf.queryExecution().executedPlan().toString()
        return next(line for line in text.split("\n") if "FileScan" in line)

    scan = scan_of(staging.checkout_events(raw).select("event_id", "price_raw"))
    assert "EqualTo(event_name,checkout_success)" in scan and "EqualTo(collection,checkout_success)" in scan
    assert "ReadSchema: struct<_id:string,collection:string,event_name:string,price:string>" in scan
    assert "In(collection" in scan_of(collection.product_events(raw).select("ip"))
    assert "Not(EqualTo(ip,))" in scan_of(collection.unique_ips(raw))


def test_profile(spark):
    rows = [checkout("a", is_paypal="maybe"), checkout("b", is_paypal="TRUE", ip="1")]
    raw = table(spark, EVENTS, *rows).withColumn("ingest_date", F.lit("2024-01-01"))
    bad = {r["column"]: r.rows_failing_cast for r in profiling.type_check(raw, "events").collect()}
    assert bad["is_paypal"] == 1 and sum(bad.values()) == 1 and "cart_products" not in bad
    nulls = {r["column"]: (r.null_count, r.approx_distinct) for r in profiling.null_and_approx_distinct(raw, "events").collect()}
    assert nulls["ip"] == (1, 1) and nulls["_id"] == (0, 2) and nulls["region"] == (2, 0)
    kpi = {r.metric: r.value for r in profiling.kpis(raw, "events").collect()}
    assert kpi["row_count"] == "2" and kpi["partition_dates_covered"] == "1" and kpi["min_time_stamp"] == str(DAY)
    products = table(spark, PRODUCTS, product("1")).withColumn("ingest_date", F.lit("2024-01-01"))
    assert profiling.schema_report(products, "products").where("mode = 'REQUIRED'").first()["column"] == "product_id"


def test_approximate_distinct_is_close(spark):
    raw = spark.range(200_000).select((F.col("id") % 50_000).cast("string").alias("product_id"))
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in PRODUCTS.fields[1:]]
    row = profiling.null_and_approx_distinct(raw.select("product_id", *columns), "products").where("column = 'product_id'")
    assert row.first().approx_distinct == pytest.approx(50_000, rel=0.06)


def test_kpis_take_one_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    table(spark, PRODUCTS, product("1")).write.parquet(path)
    plan = profiling.kpis(spark.read.parquet(path), "products")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_checks_find_what_is_broken(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert [(r["_key"], r.n) for r in checks.orphans(child, "k", parent, "k").collect()] == [(2, 1)]
    assert [r.k for r in checks.repeated_values(child, "k").collect()] == [1]
    parity = checks.stage_parity(child, parent, ("a", "b")).first()
    assert (parity.left_rows, parity.right_rows, parity.equal) == (4, 1, False)


def test_diagnostics(spark):
    rows = [
        checkout("a", cart_products="[]"),
        checkout("b", _id='{"oid":"b"}', cart_products='{"a":1}'),
        checkout("c", cart_products='[{"id":1}]', product_id="1"),
    ]
    events = table(spark, EVENTS, *rows)
    ids = diagnostics.event_id_report(events).first()
    assert tuple(ids) == (3, 1, 2, 2)
    staged = staging.checkout_events(events)
    assert tuple(diagnostics.line_item_report(staged).first()) == (2, 1, 2, 2, 1)
    assert diagnostics.carts(events, 2).count() == 2


def test_sketches_scan_new_dates_only(spark, tmp_path):
    rows = [{"ip": f"1.1.1.{k % 50}", "product_id": str(k)} for k in range(600)]
    raw = table(spark, EVENTS, *rows).withColumn("ingest_date", F.concat(F.lit("2024-03-0"), 1 + F.col("product_id").cast("int") % 3))
    path = str(tmp_path / "raw")
    raw.write.partitionBy("ingest_date").parquet(path)
    stored = spark.read.schema(raw.schema).parquet(path)
    store = sketches.ProfileStore(spark, str(tmp_path / "sketches"), "events")
    assert store.add(stored.where("ingest_date < '2024-03-03'")) == ["2024-03-01", "2024-03-02"]
    plan = sketches.sketch_rows(stored.where(F.col("ingest_date").isin(store.missing_dates(stored))), "events")
    assert {f.rsplit("ingest_date=", 1)[1][:10] for f in plan.inputFiles()} == {"2024-03-03"} or "PartitionFilters: [isnotnull" in plan._jdf.queryExecution().executedPlan().toString()
    assert store.add(stored) == ["2024-03-03"] and store.add(stored) == []
    assert store.rows().count() == 3 * len(profiling.scalar_columns("events"))
    exact = {r.column: r.distinct_count for r in profiling.exact_distinct(stored, "events").collect()}
    for r in store.report().collect():
        assert abs(r.approx_distinct - exact[r.column]) <= max(2, 0.07 * exact[r.column])
        assert r.null_count == (0 if exact[r.column] else 600)
    day = {r.column: r.approx_distinct for r in store.report("2024-03-02", "2024-03-02").collect()}
    assert abs(day["product_id"] - 200) <= 14
    # a date whose rows changed is taken again
    assert store.add(stored.where("ip <> '1.1.1.0'"), again=["2024-03-01"]) == ["2024-03-01"]


def test_order_bitmaps_add_up(spark):
    data = [(f"o{k % 700}", f"2024-03-{1 + k % 9:02d}", "AB"[k % 2]) for k in range(3000)] + [(None, "2024-03-01", "A"), ("o1", None, None)]
    view = spark.createDataFrame(data, "order_id string, full_date string, country string").withColumn("full_date", F.col("full_date").cast("date"))
    stored = materialise(order_bitmaps(view, ["country"]), "bitmaps")
    for dims in ([], ["country"], ["full_date"], ["full_date", "country"]):
        got = {tuple(r)[:-1]: r.order_count for r in distinct_orders(stored, *dims).collect()}
        want = {tuple(r)[:-1]: r.n for r in view.groupBy(*dims).agg(F.count_distinct("order_id").alias("n")).collect()}
        assert got == {k: n for k, n in want.items() if n}
    assert distinct_orders(order_bitmaps(view.limit(0), ["country"]), "country").count() == 0


def test_reports_write_only_what_they_read(spark):
    event = checkout("a" * 24, device_id="d", ip="1", product_id="1", price="5")
    m = build(spark, [event], [ip("1")], [product("1")])
    assert mart.event_geo(m.checkouts, m.ip_locations).count() == 1
    assert not {"cart_lines", "lines", "sales", "fact"} & set(vars(m))
    assert m.view("order_id", "sales_amount").count() == m.totals("metal_type").count() == 1
    assert "sales" in vars(m) and "fact" not in vars(m)
    assert m.view().count() == 1 and "fact" in vars(m)


def test_stored_lines_hold_no_ids_twice(spark):
    """A line's id is its event's and a number; places are looked up once per address."""
    events = [checkout(c * 24, device_id="d", ip="1", product_id="1", price="5") for c in "abc"]
    m = build(spark, [*events, checkout("no hex-1", device_id="d", ip="1", product_id="1")], [ip("1")], [product("1")])
    ids = sorted(r.line_item_id for r in m.fact.collect())
    assert ids == ["a" * 24 + "-1", "b" * 24 + "-1", "c" * 24 + "-1", "no hex-1-1"]
    for stored in (m.cart_lines, m.event_lines, m.sales, m.fact):
        assert "line_item_id" not in spark.read.parquet(*stored.inputFiles()).columns
    assert mart.location_keys(m.checkouts, m.ip_locations, m.dim_location).count() == 1


def _below(folder):
    return sorted(name.rsplit("-", 1)[0] for name in os.listdir(folder))


def test_fact_leaves_one_copy_and_no_shuffle_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_dir", lambda _: f"{tmp_path}/clickloom/{spark.sparkContext.applicationId}")
    folder = workspace.shared_dir(spark)
    cart = '[{"product_id":"p1"},{"product_id":"p1"}]'
    built = build(spark, [checkout(k, cart_products=cart) for k in ("a", "ab", "0c", "!")], [], [product("p1")])
    key = "sales_order_line_key"
    fact = built.fact.orderBy(key).collect()
    ids = [r.line_item_id for r in fact]
    assert [r[key] for r in fact] == list(range(1, 9)) and ids == sorted(ids) and ids[0] == "!-1"
    assert not {key, "sales-lines"} & set(_below(folder)) and "fact-sales" in _below(folder)
    assert sorted(map(str, built.sales.collect())) == sorted(map(str, built.fact.select(built.sales.columns).collect()))
    again = build(spark, [checkout("a", cart_products=cart)], [], [product("p1")])
    before = again.sales  # handed out, so it stays
    assert again.fact.count() == before.count() == 2
    built.discard()
    again.discard()
    assert not {"checkouts", "cart-lines", "fact-sales", "sales-lines"} & set(_below(folder))


def test_what_a_write_shuffled_is_deleted(spark):
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {name for name in store.getAllFiles().mkString("|").split("|") if "shuffle_" in name}

    before = shuffled()
    materialise(spark.range(1000).repartition(3, "id"), "moved")
    assert not shuffled() - before
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(setting, None) in (None, "false")


def test_a_range_with_several_rows_gives_an_address_all(spark):
    places = "country_short country_long region city latitude longitude zipcode timezone".split()
    spans = [("2001:db8::1", "2001:db8::1", "a"), ("2001:db8::1", "2001:db8::1", "b"), ("1.0.0.0", "1.0.0.9", "c")]
    ranges = spark.createDataFrame(spans, "ip_from string, ip_to string, city string")
    ranges = ranges.withColumns({c: F.lit(None).cast("string") for c in places if c != "city"})
    ips = spark.createDataFrame([("2001:db8::1",), ("1.0.0.5",), ("9.9.9.9",), ("no address",)], "ip string")
    got = sorted((r.ip, r.city) for r in collection.enrich_ips(ips, ranges).fillna("-").collect())
    assert got == [("1.0.0.5", "c"), ("2001:db8::1", "a"), ("2001:db8::1", "b"), ("9.9.9.9", "-"), ("no address", "-")]
    crossing = spark.createDataFrame([("1.0.0.5", "1.0.0.20", "d")], "ip_from string, ip_to string, city string")
    crossing = ranges.unionByName(crossing, allowMissingColumns=True)
    with pytest.raises(ValueError, match="overlap"):
        collection.enrich_ips(ips, crossing)


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cart_is_parsed_whole_and_odd_elements_alone(spark):
    carts = [
        '[{"id":"1"},5,{"id":"2","qty":3},null,{"id":"x","id":"y"}]',
        '[{"id":1E999},{"product_id":{"v":1},"id":"7"},{"id":"\\"NaN\\""},{"id":"{x"}]',
        '{"id":"1"}',
        "[]",
        None,
    ]
    rows = [(str(k), None, None, None, cart) for k, cart in enumerate(carts)]
    kind = "event_id string, order_id string, currency_code string, price_raw decimal(38,9), cart_products string"
    lines = staging.cart_lines(spark.createDataFrame(rows, kind))
    assert "from_json(ArrayType(MapType" in _optimized(lines)
    got = {(r.event_id, r.line_number): (r.product_id, r.order_qty) for r in lines.collect()}
    assert got == {
        ("0", 1): ("1", 1),
        ("0", 3): ("2", 3),
        ("0", 5): ("x", 1),
        ("1", 1): ("Infinity", 1),
        ("1", 2): ("7", 1),
        ("1", 3): ('"NaN"', 1),
        ("1", 4): ("{x", 1),
    }


def test_line_item_report_parses_a_cart_once(spark):
    carts = [("1", '[{"id":"1"}]'), (None, "[]"), ("2", "{}"), (None, None)]
    report = diagnostics.line_item_report(spark.createDataFrame(carts, "product_id string, cart_products string"))
    assert _optimized(report).count("lengthOfJsonArray") == 1
    assert report.first()[:] == (4, 2, 3, 2, 1)


def test_sketches_take_bytes_and_merge_with_those_of_text(spark):
    df = spark.range(500).select(
        F.lit("2024-03-01").alias("ingest_date"), *[F.col("id").cast(f.dataType).alias(f.name) for f in PRODUCTS if f.name != "updated_at"], F.lit(None).cast("timestamp_ntz").alias("updated_at")
    )
    rows = sketches.sketch_rows(df, "products")
    assert "as binary)" in _optimized(rows)
    of_text = df.agg(F.hll_sketch_agg("product_id", sketches.LOG2_BUCKETS)).first()[0]
    assert rows.where("column = 'product_id'").first().sketch == of_text
