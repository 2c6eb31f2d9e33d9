"""Queries that explain an empty or thin fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.jsontext import object_id
from clickloom.plans.staging import is_checkout


def event_id_report(events: DataFrame) -> DataFrame:
    """How many checkouts have an id, and in which spelling."""
    raw = F.col("_id")
    return events.where(is_checkout()).agg(
        F.count(F.lit(1)).alias("n_checkout_success"),
        F.count_if(F.get_json_object(raw, "$.oid").isNotNull()).alias("n_oid_plain"),
        F.count_if(F.get_json_object(raw, "$.$oid").isNotNull()).alias("n_oid_dollar"),
        F.count_if(object_id(raw).isNotNull()).alias("n_event_id_ok"),
    )


def line_item_report(checkouts: DataFrame) -> DataFrame:
    """How many checkouts have a product or a usable cart; a cart is parsed once."""
    cart = F.col("cart_products")
    counted = checkouts.select("product_id", cart, F.json_array_length(cart).alias("n_elements"))
    return counted.agg(
        F.count(F.lit(1)).alias("n_checkout_success"),
        F.count("product_id").alias("n_top_level_product_id"),
        F.count(cart).alias("n_has_cart_products"),
        F.count("n_elements").alias("n_cart_is_array"),
        F.count_if(F.col("n_elements") > 0).alias("n_cart_nonempty_array"),
    )


def carts(events: DataFrame, n: int = 20) -> DataFrame:
    """Some checkouts that have a cart, for reading."""
    columns = ["cart_products", "order_id", "product_id", "price", "currency"]
    with_cart = events.where(is_checkout() & F.col("cart_products").isNotNull())
    return with_cart.select(*columns).orderBy("order_id", "cart_products", "product_id", "price").limit(n)
