"""Schemas of the three raw tables and of the derived inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


# Columns of the three raw tables, in the order of their exports.

#: ``_id``, ``cart_products`` and ``option`` hold JSON text. ``is_paypal`` stays
#: text because clients send words, digits and booleans.
EVENTS = StructType(
    [
        StructField("_id", StringType()),
        StructField("time_stamp", LongType()),
        StructField("collection", StringType()),
        StructField("event_name", StringType()),
        StructField("app_id", StringType()),
        StructField("device_id", StringType()),
        StructField("ip", StringType()),
        StructField("country", StringType()),
        StructField("region", StringType()),
        StructField("city", StringType()),
        StructField("current_url", StringType()),
        StructField("referrer_url", StringType()),
        StructField("user_agent", StringType()),
        StructField("resolution", StringType()),
        StructField("language", StringType()),
        StructField("store_id", StringType()),
        StructField("user_id_db", StringType()),
        StructField("product_id", StringType()),
        StructField("viewing_product_id", StringType()),
        StructField("price", StringType()),
        StructField("currency", StringType()),
        StructField("key_search", StringType()),
        StructField("is_paypal", StringType()),
        StructField("recommendation", BooleanType()),
        StructField("show_recommendation", BooleanType()),
        StructField("email_address", StringType()),
        StructField("cart_products", StringType()),
        StructField("option", StringType()),
        StructField("order_id", StringType()),
        StructField("cat_id", StringType()),
        StructField("collect_id", StringType()),
    ]
)

IP_LOCATIONS = StructType(
    [
        StructField("ip", StringType()),
        StructField("country_short", StringType()),
        StructField("country_long", StringType()),
        StructField("region", StringType()),
        StructField("city", StringType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("zipcode", StringType()),
        StructField("timezone", StringType()),
        StructField("updated_at", TimestampNTZType()),
    ]
)

PRODUCTS = StructType(
    [
        StructField("product_id", StringType()),
        StructField("product_name", StringType()),
        StructField("source_url", StringType()),
        StructField("status", LongType()),
        StructField("error", StringType()),
        StructField("updated_at", TimestampNTZType()),
    ]
)

RAW_SCHEMAS = {"events": EVENTS, "ip_locations": IP_LOCATIONS, "products": PRODUCTS}

#: Columns that must never be NULL; file readers cannot enforce it.
REQUIRED = {"events": [], "ip_locations": ["ip"], "products": ["product_id"]}

#: Columns holding JSON text, left out of per-column profiles.
SEMI_STRUCTURED = {"events": ["cart_products", "option"], "ip_locations": [], "products": []}

#: Types the source declares where they differ from the stored ones.
DECLARED_TYPES = {"events": {"is_paypal": "boolean"}, "ip_locations": {}, "products": {}}

#: Columns on which readers filter most; files are sorted by them.
CLUSTER_KEYS = {
    "events": ["event_name", "collection", "product_id"],
    "ip_locations": ["country_short"],
    "products": ["status"],
}


def declared_type(table: str, column: str) -> str:
    stored = RAW_SCHEMAS[table][column].dataType.simpleString()
    return DECLARED_TYPES[table].get(column, stored)


def missing_required(df: DataFrame, table: str) -> Column:
    """True for a row in which a required column is NULL."""
    broken = F.lit(False)
    for name in REQUIRED[table]:
        broken = broken | F.col(name).isNull()
    return broken


def schema_additions(df: DataFrame, table: str) -> list[StructField]:
    """Top-level columns of ``df`` that the raw table does not have yet."""
    known = set(RAW_SCHEMAS[table].names)
    return [field for field in df.schema.fields if field.name not in known]


def conform(df: DataFrame, table: str, allow_additions: bool = False) -> DataFrame:
    """Bring ``df`` to the raw table's columns and types.

    Missing columns become NULL. Unknown ones are dropped, or appended when
    additions are allowed; a known column is never dropped or retyped.
    """
    present = set(df.columns)
    columns = [
        (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in RAW_SCHEMAS[table].fields
    ]
    if allow_additions:
        columns += [F.col(f"`{f.name}`") for f in schema_additions(df, table)]
    return df.select(*columns)


def union_additive(*parts: DataFrame) -> DataFrame:
    """Append parts whose later members may carry further columns."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole
