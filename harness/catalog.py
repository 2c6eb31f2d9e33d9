"""Every registered query: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType

from clickloom.functions.labels import metal_type, payment_label, stone_type
from clickloom.functions.temporal import epoch_date
from clickloom.operators.keys import with_dense_key
from clickloom.operators.keyed_table import KeyedTable
from clickloom.plans import bi, checks, collection, diagnostics, increment, mart, profiling, sketches, staging
from clickloom.plans.order_bitmaps import distinct_orders, order_bitmaps
from clickloom.session import tune
from clickloom.sources import clustering, lake, routing, schemas
from clickloom.sources.listing import list_objects
from clickloom.sources.loader import Warehouse
from clickloom.sources.versions import VersionedTable
from clickloom.streaming.arrivals import ingest_available
from clickloom.workspace import materialise, new_path
from harness import raw_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: One moment for all loads, so that a repeated run gives the same rows.
SPLIT_DAY = "2024-02-01"


class Domain:
    """Raw tables of one test folder, and the mart built from them on first use."""

    _known: dict[tuple[str, str], "Domain"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.raw = raw_tables.RawTables(spark, sf_dir)
        self._mart: mart.Mart | None = None

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Domain":
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._known:
            cls._known[key] = cls(tune(spark), sf_dir)
        return cls._known[key]

    @property
    def events(self) -> DataFrame:
        """The raw events as a view, for queries that read them once or a few columns of them."""
        return self.raw.events_view

    @property
    def stored_events(self) -> DataFrame:
        """The raw events as a written table, for queries that read most of them repeatedly."""
        return self.raw.events

    @property
    def products(self) -> DataFrame:
        return self.raw.products

    @property
    def ip_locations(self) -> DataFrame:
        return self.raw.ip_locations

    def derived(self, name: str) -> DataFrame:
        return raw_tables.derive(self.spark, self.sf_dir, name)

    @property
    def mart(self) -> mart.Mart:
        if self._mart is None:
            self._mart = mart.build_mart(self.events, self.products, self.ip_locations)
        return self._mart

    def models(self) -> dict[str, DataFrame]:
        m = self.mart
        return {
            "stg_checkout_events": m.checkouts,
            "stg_products": staging.latest_products(self.products),
            "stg_ip_locations": m.ip_locations,
            "stg_checkout_line_items": m.lines,
            "dim_date": m.dim_date,
            "dim_customer": m.dim_customer,
            "dim_product": m.dim_product,
            "dim_location": m.dim_location,
            "fact_sales_order_detail": m.fact,
        }

    def per_table(self, report: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        raw = {"events": self.stored_events, "ip_locations": self.ip_locations, "products": self.products}
        parts = [report(df, t).withColumn("table_name", F.lit(t)) for t, df in raw.items()]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])


def plain(df: DataFrame) -> DataFrame:
    """Types that every engine's client shows alike: numbers as doubles, times as text."""
    shown = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (DateType, TimestampNTZType)):
            column = column.cast("string")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def query(build: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(Domain.of(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


# -- sources, routing, loading -----------------------------------------------------


@query
def q_scan_events(d: Domain) -> DataFrame:
    path = new_path(d.spark, "export-events")
    lake.write_events(d.events.select(*schemas.EVENTS.names), path)
    return lake.read_events(d.spark, path)


@query
def q_scan_ip_locations(d: Domain) -> DataFrame:
    root = new_path(d.spark, "export-ips")
    path = lake.repack_reference(d.ip_locations, "ip_locations", root, "2024-03-01", "errorifexists")
    return lake.read_reference(d.spark, "ip_locations", path)


@query
def q_scan_products(d: Domain) -> DataFrame:
    root = new_path(d.spark, "export-products")
    path = lake.repack_reference(d.products, "products", root, "2024-03-01", "errorifexists")
    return lake.read_reference(d.spark, "products", path)


@query
def q_route_objects(d: Domain) -> DataFrame:
    return routing.route(d.derived("manifest"))


@query
def q_load_ids(d: Domain) -> DataFrame:
    manifest = d.derived("manifest")
    return routing.with_load_ids(manifest, "shop/manual load").select("object_no", "load_key", "load_id")


@query
def q_pending_loads(d: Domain) -> DataFrame:
    manifest = d.derived("manifest")
    ledger = routing.with_load_ids(manifest.where("object_no % 3 = 0"), "by hand")
    todo = routing.pending(routing.routed_objects(manifest), ledger)
    return todo.select("table", "bucket", "name", "ingest_date", "load_id", "write_mode")


@query
def q_backfill_plan(d: Domain) -> DataFrame:
    plan = routing.backfill_plan(d.derived("manifest"), ingest_date="2024-02-17")
    return plan.select("table", "bucket", "name", "write_mode", "load_id")


@query
def q_schema_additions(d: Domain) -> DataFrame:
    old = schemas.conform(d.events, "events")
    tagged = d.events.withColumn("campaign", F.concat(F.lit("c-"), F.col("cat_id"))).drop("cat_id")
    new = schemas.conform(tagged.drop("ingest_date"), "events", allow_additions=True)
    whole = schemas.union_additive(old, new)
    return whole.groupBy("collection", "campaign").agg(
        F.count(F.lit(1)).alias("event_count"), F.count("cat_id").alias("with_category")
    )


@query
def q_stream_file_ingest(d: Domain) -> DataFrame:
    root = new_path(d.spark, "lake")
    raw = f"{root}/{routing.LAKE_PREFIX}"
    lake.publish_events(d.events.select(*schemas.EVENTS.names), raw, "2024-03-01")
    lake.repack_reference(d.ip_locations, "ip_locations", raw, "2024-03-01", "errorifexists")
    lake.repack_reference(d.products, "products", raw, "2024-03-02", "errorifexists")
    warehouse = Warehouse(d.spark, new_path(d.spark, "warehouse"))
    checkpoint = new_path(d.spark, "arrivals")
    ingest_available(d.spark, root, warehouse, checkpoint, any_file=True)
    # again, and once more as if the stream's own memory were lost: nothing is added
    ingest_available(d.spark, root, warehouse, checkpoint, any_file=True)
    ingest_available(d.spark, root, warehouse, new_path(d.spark, "arrivals"), any_file=True)
    kinds = {
        "events": staging.event_type(),
        "ip_locations": F.col("country_short"),
        "products": F.col("status").cast("string"),
    }
    parts = [
        warehouse.table(t)
        .groupBy("ingest_date", kind.alias("kind"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("table_name", F.lit(t))
        for t, kind in kinds.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def q_snapshot_rollback(d: Domain) -> DataFrame:
    """The last load of a snapshot counts: here a backfill of the older date."""
    root = new_path(d.spark, "lake")
    raw = f"{root}/{routing.LAKE_PREFIX}"
    second = d.ip_locations.where("ip < '5'").withColumn("city", F.lit("elsewhere"))
    lake.repack_reference(d.ip_locations, "ip_locations", raw, "2024-03-01", "errorifexists")
    lake.repack_reference(second, "ip_locations", raw, "2024-03-09", "errorifexists")
    warehouse = Warehouse(d.spark, new_path(d.spark, "warehouse"))
    routed = routing.routed_objects(list_objects(d.spark, root), any_file=True)
    warehouse.load(routed.where("ingest_date = '2024-03-09'"))
    warehouse.load(routed.where("ingest_date = '2024-03-01'"))
    first = F.when(F.col("ingest_date") == "2024-03-01", "first").otherwise("second")
    table = warehouse.table("ip_locations").withColumn("snapshot", first)
    return table.groupBy("snapshot", "country_short").agg(F.count(F.lit(1)).alias("row_count"))


#: Fixed for both sides of the comparison: shards of this size whatever the table's.
EXPORT_SHARD = 5_000


def _exported_lake(d: Domain) -> str:
    """All raw tables as lake objects, events by an export that stopped and went on."""
    root = new_path(d.spark, "lake")
    raw = f"{root}/{routing.LAKE_PREFIX}"
    events = d.events.select(*schemas.EVENTS.names)
    for stop_after in (1, None):
        lake.publish_events(events, raw, "2024-03-01", EXPORT_SHARD, shards_per_job=64, stop_after=stop_after)
    lake.repack_reference(d.products, "products", raw, "2024-03-02", "errorifexists")
    return root


@query
def q_resumed_export(d: Domain) -> DataFrame:
    """Shards under their routes' own names, whatever run wrote them."""
    root = _exported_lake(d)
    path = f"{root}/{routing.LAKE_PREFIX}/events/ingest_date=2024-03-01"
    number = F.regexp_extract("_metadata.file_name", r"-(\d+)\.", 1).cast("int")
    rows = lake.read_events(d.spark, path).select("_id", "time_stamp", number.alias("shard"))
    return rows.groupBy("shard").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("_id").alias("first_id"),
        F.max("_id").alias("last_id"),
        F.sum("time_stamp").alias("time_sum"),
    )


@query
def q_skipped_files(d: Domain) -> DataFrame:
    """Filters on the third clustering key alone, on events in the interleaved order of all three."""
    path = new_path(d.spark, "clustered")
    stored = d.stored_events.withColumn("ingest_date", F.lit("2024-03-01"))
    clustering.recluster_interleaved(stored, schemas.CLUSTER_KEYS["events"], path, files=32)
    events = d.spark.read.parquet(path)
    ids = d.stored_events.select("product_id").where(F.col("product_id").isNotNull()).distinct()
    wanted = [("product_id", r.product_id) for r in ids.orderBy("product_id").limit(10).collect()]
    report = clustering.skipped_files(events, wanted)
    return report.select("column_name", "value", "rows", (F.col("files_read") * 2 <= F.col("files")).alias("most_skipped"))


class _Interrupted(Warehouse):
    """A loader during whose every load another one sets out to load the same objects."""

    def __init__(self, spark: SparkSession, root: str, objects: DataFrame):
        super().__init__(spark, root)
        self.rival, self.objects = Warehouse(spark, root), objects

    def _write(self, table: str, rows: DataFrame, folder: str) -> None:
        super()._write(table, rows, folder)
        self.rival.load(self.objects)


@query
def q_concurrent_loads(d: Domain) -> DataFrame:
    """Two loaders at once and a third after them: every object once."""
    root, place = _exported_lake(d), new_path(d.spark, "warehouse")
    objects = routing.routed_objects(list_objects(d.spark, root), any_file=True)
    _Interrupted(d.spark, place, objects).load(objects)
    last = Warehouse(d.spark, place)
    last.load(objects)
    kinds = {"events": staging.event_type(), "products": F.col("status").cast("string")}
    parts = [
        last.table(t)
        .groupBy("ingest_date", kind.alias("kind"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("table_name", F.lit(t))
        for t, kind in kinds.items()
    ]
    return parts[0].unionByName(parts[1])


@query
def q_replaced_table(d: Domain) -> DataFrame:
    """Readers of a table that is replaced, then replaced by a publication that fails."""
    table = VersionedTable(d.spark, new_path(d.spark, "replaced"))
    rows = d.products.groupBy("status").agg(F.count(F.lit(1)).alias("row_count"))
    table.publish(rows.withColumn("version", F.lit(1)))
    first = table.read()
    table.publish(rows.withColumn("version", F.lit(2)))
    broken = F.when(F.col("status") == 404, F.raise_error(F.lit("broken"))).otherwise(3)
    try:
        table.publish(rows.withColumn("version", broken.cast("int")))
    except PySparkException:
        pass
    return first.unionByName(table.read())


# -- collection ---------------------------------------------------------------------


@query
def q_unique_ips(d: Domain) -> DataFrame:
    return collection.unique_ips(d.events)


@query
def q_product_events(d: Domain) -> DataFrame:
    return collection.product_events(d.events)


def _candidates(d: Domain) -> DataFrame:
    return collection.product_candidates(collection.product_events(d.events))


@query
def q_product_candidates(d: Domain) -> DataFrame:
    return _candidates(d)


@query
def q_crawl_queue(d: Domain) -> DataFrame:
    return collection.crawl_queue(_candidates(d), d.products, max_items=500)


@query
def q_new_products(d: Domain) -> DataFrame:
    return collection.new_products(_candidates(d), d.products)


@query
def q_new_ips(d: Domain) -> DataFrame:
    return collection.new_ips(collection.unique_ips(d.events), d.ip_locations, max_items=400)


@query
def q_ip_range_enrich(d: Domain) -> DataFrame:
    return collection.enrich_ips(collection.unique_ips(d.events), d.derived("ip_ranges"))


@query
def q_ip_nested_enrich(d: Domain) -> DataFrame:
    return collection.enrich_ips(collection.unique_ips(d.events), d.derived("ip_networks"), nested=True)


@query
def q_crawl_outcome(d: Domain) -> DataFrame:
    return collection.crawl_results(d.derived("crawl_log"))


def _old_and_new(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    old = F.col("updated_at") < F.lit(SPLIT_DAY).cast("timestamp_ntz")
    return df.where(old), df.where(~F.coalesce(old, F.lit(False)))


@query
def q_upsert_products(d: Domain) -> DataFrame:
    return collection.upsert_products(*_old_and_new(d.products.drop("ingest_date")))


@query
def q_upsert_ip_locations(d: Domain) -> DataFrame:
    old, new = _old_and_new(d.ip_locations.drop("ingest_date"))
    return collection.upsert_ip_locations(old, new)


def _touched(d: Domain, old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    table = KeyedTable(d.spark, new_path(d.spark, "keyed"), key, rows_per_file=500)
    table.replace(old)
    table.upsert(new, [F.col("updated_at").desc_nulls_last()])
    return table.read()


@query
def q_upsert_touched_products(d: Domain) -> DataFrame:
    """The rows of ``q_upsert_products``, by rewriting the files that the batch touches."""
    old, new = _old_and_new(d.products.drop("ingest_date"))
    return _touched(d, old, new, "product_id")


@query
def q_upsert_touched_ips(d: Domain) -> DataFrame:
    old, new = _old_and_new(d.ip_locations.drop("ingest_date"))
    return _touched(d, old, new, "ip")


@query
def q_page_names(d: Domain) -> DataFrame:
    return collection.page_names(d.derived("raw_pages"))


@query
def q_stage_parity(d: Domain) -> DataFrame:
    ips = checks.stage_parity(
        collection.unique_ips(d.events), d.ip_locations, ("unique_ips", "ip_locations")
    )
    return ips.unionByName(
        checks.stage_parity(_candidates(d), d.products, ("product_candidates", "products"))
    )


# -- staging --------------------------------------------------------------------------


@query
def q_stg_checkout_events(d: Domain) -> DataFrame:
    return staging.checkout_events(d.events)


@query
def q_stg_products(d: Domain) -> DataFrame:
    return staging.latest_products(d.products)


@query
def q_stg_ip_locations(d: Domain) -> DataFrame:
    return staging.latest_ip_locations(d.ip_locations)


@query
def q_line_items_cart(d: Domain) -> DataFrame:
    return staging.cart_lines(staging.checkout_events(d.events))


@query
def q_line_items_fallback(d: Domain) -> DataFrame:
    return staging.event_level_lines(d.mart.checkouts, d.mart.cart_lines)


@query
def q_stg_line_items(d: Domain) -> DataFrame:
    return staging.checkout_line_items(d.mart.checkouts, d.mart.cart_lines)


@query
def q_payment_label(d: Domain) -> DataFrame:
    return staging.checkout_events(d.events).select(
        "event_id", "is_paypal_raw", payment_label(F.col("is_paypal_raw")).alias("is_paypal")
    )


@query
def q_metal_type(d: Domain) -> DataFrame:
    name = F.col("product_name")
    return staging.latest_products(d.products).select(
        "product_id", "product_name", metal_type(name).alias("metal_type")
    )


@query
def q_stone_type(d: Domain) -> DataFrame:
    name = F.col("product_name")
    return staging.latest_products(d.products).select(
        "product_id", "product_name", stone_type(name).alias("stone_type")
    )


@query
def q_event_geo(d: Domain) -> DataFrame:
    return mart.event_geo(d.mart.checkouts, d.mart.ip_locations)


# -- mart -----------------------------------------------------------------------------


@query
def q_surrogate_keys(d: Domain) -> DataFrame:
    lines = d.mart.lines
    rest = [c for c in lines.columns if c != "line_item_id"]
    order = [F.col(c).asc_nulls_first() for c in ["line_item_id", *rest]]
    return with_dense_key(lines, "line_key", order, keep=["line_item_id", "product_id"])


@query
def q_dim_date(d: Domain) -> DataFrame:
    return mart.dim_date(d.mart.checkouts)


@query
def q_dim_customer(d: Domain) -> DataFrame:
    return mart.dim_customer(d.mart.checkouts)


@query
def q_dim_product(d: Domain) -> DataFrame:
    return mart.dim_product(staging.latest_products(d.products))


@query
def q_dim_location(d: Domain) -> DataFrame:
    return mart.dim_location(d.mart.checkouts, d.mart.ip_locations)


@query
def q_fact_sales(d: Domain) -> DataFrame:
    m = d.mart
    sales = mart.sales_lines(
        m.checkouts, m.lines, m.ip_locations, m.dim_product, m.dim_customer, m.dim_location
    )
    return mart.fact_sales(sales)


@query
def q_vw_sales_performance(d: Domain) -> DataFrame:
    return d.mart.view()


@query
def q_month_rebuild(d: Domain) -> DataFrame:
    """The view of a stored mart that got the last month's second half by a rebuild of that month."""
    month = increment.sales_month(F.max("full_date"))
    days = mart.dim_date(staging.checkout_events(d.events))
    last = days.agg(month.alias("month")).first().month
    late = (increment.sales_month(epoch_date(F.col("time_stamp"))) == last) & (F.crc32(F.col("_id")) % 2 == 0)
    stored = increment.StoredMart(d.spark, new_path(d.spark, "stored-mart"))
    earlier = d.events.where(~F.coalesce(late, F.lit(False)))
    built = mart.build_mart(earlier, d.products, d.ip_locations)
    stored.create(built)
    built.discard()
    stored.rebuild(d.events, d.products, d.ip_locations, [last])
    return stored.view().drop("sales_order_line_key")


@query
def q_customer_masked(d: Domain) -> DataFrame:
    return mart.customer_masked(d.mart.dim_customer)


@query
def q_customer_seen_dates(d: Domain) -> DataFrame:
    return mart.customer_seen_dates(d.mart.checkouts, d.mart.dim_customer)


@query
def q_dim_payment_method(d: Domain) -> DataFrame:
    return mart.dim_payment_method(d.mart.checkouts)


@query
def q_dim_geo_hashed(d: Domain) -> DataFrame:
    return mart.dim_geo(d.mart.ip_locations)


# -- reports --------------------------------------------------------------------------


@query
def q_bi_scorecards(d: Domain) -> DataFrame:
    return bi.scorecards(d.mart.view("sales_amount", "order_qty", "order_id", "full_date"))


@query
def q_bi_revenue_by_day(d: Domain) -> DataFrame:
    return bi.revenue_by(d.mart.totals("full_date"), "full_date")


@query
def q_bi_orders_by_day(d: Domain) -> DataFrame:
    return bi.orders_by(d.mart.view("full_date", "order_id"), "full_date")


@query
def q_bi_orders_united(d: Domain) -> DataFrame:
    """Distinct orders by day, week, month and country, all from one table of bitmaps."""
    view = d.mart.view("full_date", "country_name", "order_id")
    stored = materialise(order_bitmaps(view, ["country_name"]), "order-bitmaps")
    day = F.col("full_date").cast("timestamp_ntz")
    labels = {
        "day": F.col("full_date").cast("string"),
        "week": F.date_trunc("week", day).cast("date").cast("string"),
        "month": F.date_trunc("month", day).cast("date").cast("string"),
        "country": F.col("country_name"),
        "all": F.lit("all"),
    }
    parts = [
        distinct_orders(stored, F.lit(level), label).toDF("level", "label", "order_count")
        for level, label in labels.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def q_bi_trend_by_week(d: Domain) -> DataFrame:
    return bi.trend(d.mart.view("full_date", "order_id", "sales_amount"), "week")


@query
def q_bi_trend_by_month(d: Domain) -> DataFrame:
    return bi.trend(d.mart.view("full_date", "order_id", "sales_amount"), "month")


@query
def q_bi_top_stones(d: Domain) -> DataFrame:
    return bi.top_by_revenue(d.mart.totals("stone_type"), "stone_type")


@query
def q_bi_top_products(d: Domain) -> DataFrame:
    return bi.top_by_revenue(d.mart.totals("product_name"), "product_name")


@query
def q_bi_metal_share(d: Domain) -> DataFrame:
    return bi.share_of_revenue(d.mart.totals("metal_type"), "metal_type")


@query
def q_bi_revenue_by_country(d: Domain) -> DataFrame:
    return bi.revenue_by(d.mart.totals("country_name"), "country_name")


@query
def q_bi_geo_country_city(d: Domain) -> DataFrame:
    return bi.geo_country_city(d.mart.view("country_name", "city_name", "order_id", "sales_amount"))


@query
def q_bi_product_performance(d: Domain) -> DataFrame:
    return bi.product_performance(d.mart.totals("product_id", "product_name"))


@query
def q_bi_payment_breakdown(d: Domain) -> DataFrame:
    return bi.payment_breakdown(d.mart.view("is_paypal", "order_id", "order_qty", "sales_amount"))


@query
def q_bi_filtered_sales(d: Domain) -> DataFrame:
    view = d.mart.view(
        *("country_name", "year_number", "is_paypal", "order_id", "order_qty", "sales_amount"),
        first_day="1996-02-01",
        last_day="1999-10-31",
    )
    chosen = bi.filtered(view, ["NATION_3", "NATION_8", "NATION_21"], payment="paypal")
    return chosen.groupBy("country_name", "year_number").agg(
        bi.revenue().alias("revenue"), bi.orders().alias("order_count"), bi.units().alias("units")
    )


# -- profiles, checks, diagnostics --------------------------------------------------------


@query
def q_profile_events_kpi(d: Domain) -> DataFrame:
    return profiling.kpis(d.events, "events")


@query
def q_profile_ip_kpi(d: Domain) -> DataFrame:
    return profiling.kpis(d.ip_locations, "ip_locations")


@query
def q_profile_products_kpi(d: Domain) -> DataFrame:
    return profiling.kpis(d.products, "products")


@query
def q_profile_nulls(d: Domain) -> DataFrame:
    return d.per_table(profiling.null_counts)


@query
def q_profile_distinct(d: Domain) -> DataFrame:
    return d.per_table(profiling.exact_distinct)


@query
def q_profile_approx_distinct(d: Domain) -> DataFrame:
    return d.per_table(profiling.approx_distinct_check)


@query
def q_profile_incremental(d: Domain) -> DataFrame:
    """As ``q_profile_approx_distinct``, from sketches stored date by date."""

    def report(df: DataFrame, table: str) -> DataFrame:
        store = sketches.ProfileStore(d.spark, new_path(d.spark, f"sketches-{table}"), table)
        store.add(df.where("ingest_date <= '2024-03-02'"))
        store.add(df)
        return profiling.within_bound(store.report(), profiling.exact_distinct(df, table))

    return d.per_table(report)


@query
def q_profile_type_check(d: Domain) -> DataFrame:
    return d.per_table(profiling.type_check)


@query
def q_top_event_types(d: Domain) -> DataFrame:
    return profiling.top_event_types(d.events, 5)


@query
def q_raw_row_counts(d: Domain) -> DataFrame:
    return profiling.row_counts(
        {"events": d.events, "ip_locations": d.ip_locations, "products": d.products}
    )


@query
def q_ip_match_ratio(d: Domain) -> DataFrame:
    return profiling.ip_match_ratio(d.events, d.ip_locations)


@query
def q_test_unique(d: Domain) -> DataFrame:
    return checks.unique_report(d.models())


@query
def q_test_not_null(d: Domain) -> DataFrame:
    return checks.not_null_report(d.models())


@query
def q_test_relationships(d: Domain) -> DataFrame:
    return checks.relationships_report(d.models())


def _faulty(models: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The models with repeated ids, missing values and orphans put in by rule."""
    checkouts, fact = models["stg_checkout_events"], models["fact_sales_order_detail"]
    checkouts = checkouts.unionByName(checkouts.where(F.col("event_id").endswith("0")))
    fact = fact.unionByName(fact.where("sales_order_line_key % 13 = 0"))
    key = F.col("sales_order_line_key")
    return models | {
        "stg_checkout_events": checkouts.withColumn(
            "event_date", F.when(~F.col("event_id").endswith("1"), F.col("event_date"))
        ),
        "fact_sales_order_detail": fact.withColumns(
            {
                "product_key": F.when(key % 7 != 0, F.col("product_key")),
                "customer_key": F.when(key % 11 == 0, -F.col("customer_key")).otherwise(F.col("customer_key")),
            }
        ),
    }


@query
def q_test_faults(d: Domain) -> DataFrame:
    """All three kinds of data tests on models that have faults."""
    models = _faulty(d.models())
    parts = [
        checks.unique_report(models).withColumn("test", F.lit("unique")),
        checks.not_null_report(models).withColumn("test", F.lit("not_null")),
        checks.relationships_report(models).withColumn("test", F.lit("relationship")),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


@query
def q_profile_schema(d: Domain) -> DataFrame:
    return d.per_table(profiling.schema_report)


@query
def q_debug_event_ids(d: Domain) -> DataFrame:
    return diagnostics.event_id_report(d.events)


@query
def q_debug_line_items(d: Domain) -> DataFrame:
    return diagnostics.line_item_report(staging.checkout_events(d.events))


@query
def q_explore_cart(d: Domain) -> DataFrame:
    return diagnostics.carts(d.events)
