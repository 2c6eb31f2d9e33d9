"""Collection: unique IPs, product candidates, work lists, enrichment, page names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.labels import crawl_outcome
from clickloom.functions.network import address_position
from clickloom.functions.text import key_text, non_empty, page_name
from clickloom.operators.joins import spread_nulls
from clickloom.operators.nested_ranges import locate_innermost
from clickloom.operators.ranges import locate_in_ranges
from clickloom.operators.snapshots import upsert
from clickloom.sources.versions import VersionedTable

# Events in which a visitor deals with one product.
PRODUCT_EVENTS = [
    "view_product_detail",
    "select_product_option",
    "select_product_option_quality",
    "add_to_cart_action",
    "product_detail_recommendation_visible",
    "product_detail_recommendation_noticed",
    "product_view_all_recommend_clicked",
]

# Columns of a location, in the order in which they are delivered.
GEO_ATTRIBUTES = [
    "country_short",
    "country_long",
    "region",
    "city",
    "latitude",
    "longitude",
    "zipcode",
    "timezone",
]


def unique_ips(events: DataFrame) -> DataFrame:
    return events.where(non_empty(F.col("ip"))).select("ip").distinct()


def product_events(events: DataFrame) -> DataFrame:
    """Product interactions, recognised by collection alone."""
    return events.where(F.col("collection").isin(PRODUCT_EVENTS)).select(
        "time_stamp",
        F.col("collection").alias("event_name"),
        "product_id",
        "viewing_product_id",
        "current_url",
        "referrer_url",
        "device_id",
        "ip",
    )


def product_candidates(interactions: DataFrame) -> DataFrame:
    """Each product with the URL of its latest sighting.

    The maximum of (time, url) combines before the shuffle, so a product seen in
    most events costs one row per task. A missing time sorts first; of equal
    times the greater URL wins. An empty URL does not fall back to the referrer.
    """
    usable = interactions.select(
        F.coalesce("product_id", "viewing_product_id").alias("product_id"),
        F.coalesce("current_url", "referrer_url").alias("best_url"),
        "time_stamp",
    ).where(F.col("product_id").isNotNull() & non_empty(F.col("best_url")))
    return (
        usable.groupBy("product_id")
        .agg(F.max(F.struct("time_stamp", "best_url")).alias("latest"))
        .select(
            "product_id",
            F.col("latest.best_url").alias("best_url"),
            F.col("latest.time_stamp").alias("last_seen_ts"),
        )
    )


def crawl_queue(candidates: DataFrame, products: DataFrame, max_items: int = 0) -> DataFrame:
    """Candidates to crawl, latest first. The limit counts candidates that are
    already done too, as it is applied before they are left out."""
    chosen = candidates
    if max_items:
        order = [F.desc_nulls_last("last_seen_ts"), F.asc("product_id")]
        chosen = chosen.orderBy(*order).limit(max_items)
    cleaned = chosen.withColumn("product_id", key_text(F.col("product_id"))).where(
        non_empty(F.col("product_id")) & non_empty(F.col("best_url"))
    )
    done = products.select("product_id").distinct()
    return cleaned.join(done, "product_id", "left_anti")


def new_products(candidates: DataFrame, products: DataFrame) -> DataFrame:
    return crawl_queue(candidates, products)


def new_ips(ips: DataFrame, ip_locations: DataFrame, max_items: int = 0) -> DataFrame:
    """IPs without a location yet; the limit counts only those."""
    cleaned = ips.select(key_text(F.col("ip")).alias("ip")).where(non_empty(F.col("ip")))
    todo = cleaned.join(ip_locations.select("ip").distinct(), "ip", "left_anti")
    return todo.orderBy("ip").limit(max_items) if max_items else todo


def enrich_ips(ips: DataFrame, ranges: DataFrame, nested: bool = False) -> DataFrame:
    """Each IPv4 or IPv6 address with the attributes of its address range.

    ``ranges`` has ``ip_from`` and ``ip_to`` as addresses and the attributes. With
    ``nested`` they may lie within each other or cross, and the innermost counts;
    otherwise they must be disjoint or the same: of a range with several rows an address
    gets them all, one row each.
    """
    points = ips.select("ip", address_position(F.col("ip")).alias("_at"))
    spans = ranges.select(
        address_position(F.col("ip_from")).alias("_low"),
        address_position(F.col("ip_to")).alias("_high"),
        *GEO_ATTRIBUTES,
    )
    if nested:
        return locate_innermost(points, "_at", spans, "_low", "_high").select("ip", *GEO_ATTRIBUTES)
    located = locate_in_ranges(points, "_at", spans.select("_low", "_high").distinct(), "_low", "_high")
    # addresses outside all ranges would meet in one reducer
    located = located.withColumn("_low", spread_nulls(F.col("_low"), F.col("ip")))
    return located.join(spans, ["_low", "_high"], "left").select("ip", *GEO_ATTRIBUTES)


def crawl_results(log: DataFrame) -> DataFrame:
    """Crawl log rows with status and error text in place of raw outcomes."""
    failed = F.col("exception").isNotNull()
    status = F.when(failed, F.lit(0)).otherwise(F.col("status")).cast("bigint")
    error = crawl_outcome(F.col("status"), F.col("product_name"), F.col("exception"))
    return log.select(
        "product_id",
        F.when(error.isNull(), F.col("product_name")).alias("product_name"),
        "source_url",
        status.alias("status"),
        error.alias("error"),
        "updated_at",
    )


def _newest() -> list[Column]:
    return [F.col("updated_at").desc_nulls_last()]


def upsert_products(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(old, new, ["product_id"], _newest())


def upsert_ip_locations(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(old, new, ["ip"], _newest())


def page_names(pages: DataFrame) -> DataFrame:
    """Product name shown by each fetched page."""
    return pages.select("page_id", "url", page_name(F.col("html")).alias("product_name"))


def publish(events: DataFrame, path: str) -> None:
    """Rebuild the collection tables, each without a gap; each step reads the one before."""
    tables = {
        name: VersionedTable(events.sparkSession, f"{path}/{name}")
        for name in ("unique_ips", "product_events", "product_candidates")
    }
    tables["unique_ips"].publish(unique_ips(events))
    tables["product_events"].publish(product_events(events))
    tables["product_candidates"].publish(product_candidates(tables["product_events"].read()))
