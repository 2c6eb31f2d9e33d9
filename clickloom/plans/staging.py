"""Staged views over the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.jsontext import (
    OBJECTS,
    field_scalar,
    has_object_id,
    json_elements,
    json_maps,
    object_id,
)
from clickloom.functions.numbers import inside, safe_divide, safe_integer, safe_numeric
from clickloom.functions.temporal import epoch_date, epoch_timestamp
from clickloom.functions.text import packed_id, unpacked_id
from clickloom.operators.latest import latest_per_key

CHECKOUT = "checkout_success"

# Names under which clients send a cart line's id, quantity and
# amount; the first usable one counts.
PRODUCT_FIELDS = ["product_id", "productId", "id"]
QUANTITY_FIELDS = ["qty", "quantity", "order_qty"]
AMOUNT_FIELDS = ["price", "amount", "line_amount"]

LINE_COLUMNS = [
    "line_item_id",
    "event_id",
    "order_id",
    "product_id",
    "order_qty",
    "line_amount",
    "unit_price",
    "currency_code",
    "line_number",
]


def event_type() -> Column:
    """Event name, with the collection standing in where a client sent none."""
    return F.coalesce("event_name", "collection")


def is_checkout() -> Column:
    """``event_type() = 'checkout_success'`` in a form that reaches the Parquet scan.

    A comparison of ``coalesce`` is not pushed down; this one is, and skips all
    row groups without checkouts in files sorted by event name and collection.
    """
    name, collection = F.col("event_name"), F.col("collection")
    return (name == CHECKOUT) | (name.isNull() & (collection == CHECKOUT))


def checkout_events(events: DataFrame) -> DataFrame:
    """Successful checkouts that carry an id: typed, renamed, one row per event."""
    day = epoch_date(F.col("time_stamp"))
    price = safe_numeric(F.col("price"))
    return (
        events.where(is_checkout() & has_object_id(F.col("_id")))
        .select(
            object_id(F.col("_id")).alias("event_id"),
            event_type().alias("event_type"),
            "time_stamp",
            epoch_timestamp(F.col("time_stamp")).alias("event_ts"),
            day.alias("event_date"),
            "device_id",
            "user_id_db",
            "email_address",
            "ip",
            "order_id",
            "product_id",
            price.alias("price_raw"),
            F.col("currency").alias("currency_code"),
            F.col("is_paypal").alias("is_paypal_raw"),
            F.col("country").alias("country_event"),
            F.col("city").alias("city_event"),
            "cart_products",
            price.isNotNull().alias("is_price_valid"),
        )
    )


def latest_products(products: DataFrame) -> DataFrame:
    """Newest version of each product."""
    known = products.where(F.col("product_id").isNotNull())
    newest = latest_per_key(known, ["product_id"], [F.col("updated_at").desc_nulls_last()])
    return newest.select(
        "product_id",
        "product_name",
        "source_url",
        F.col("status").alias("crawl_status_code"),
        F.col("error").alias("crawl_error"),
        (F.col("status") == 200).alias("is_crawl_success"),
        "updated_at",
    )


def latest_ip_locations(ip_locations: DataFrame) -> DataFrame:
    """Newest location of each IP; impossible coordinates become NULL."""
    # the raw zip code is not staged, so it must not break ties either
    known = ip_locations.where(F.col("ip").isNotNull()).select(
        "ip",
        "country_short",
        F.col("country_long").alias("country_name"),
        F.col("region").alias("region_name"),
        F.col("city").alias("city_name"),
        "latitude",
        "longitude",
        "timezone",
        "updated_at",
    )
    newest = latest_per_key(known, ["ip"], [F.col("updated_at").desc_nulls_last()])
    return newest.withColumns(
        {
            "latitude": inside(F.col("latitude"), -90, 90),
            "longitude": inside(F.col("longitude"), -180, 180),
        }
    )


def _line_id(number: Column) -> Column:
    return F.concat("event_id", F.lit("-"), number.cast("string"))


def line_number_of(line_id: Column) -> Column:
    """What follows the event id in a line's id."""
    return F.substring_index(line_id, "-", -1)


def without_line_id(lines: DataFrame) -> DataFrame:
    """Lines to be stored: the id's number in place of the id, whose rest is the event's."""
    rest = [c for c in lines.columns if c != "line_item_id"]
    return lines.select(line_number_of(F.col("line_item_id")).alias("_line"), *rest)


def with_line_id(stored: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of lines that were stored by ``without_line_id``."""
    return stored.withColumn("line_item_id", _line_id(F.col("_line"))).select(*columns)


def cart_lines(checkouts: DataFrame) -> DataFrame:
    """One row per cart element that names a product; numbers keep their gaps.

    Elements leave the generator parsed: a filter on what is read from them can't be
    pushed below it, where it would parse them again.
    """
    cart, kept = F.col("cart_products"), ["event_id", "order_id", "currency_code", "price_raw"]
    parsed = checkouts.select(*kept, cart, F.from_json(cart, OBJECTS).alias("whole"))
    elements = parsed.select(
        *kept, cart, F.posexplode(json_maps(cart, F.col("whole"))).alias("position", "element")
    )
    element = F.col("element")
    line = F.get(json_elements(cart), F.col("position"))
    ids = [field_scalar(element, name, line) for name in PRODUCT_FIELDS]
    # a nested object's text is no number, so amounts and quantities need no scalar test
    amounts = [safe_numeric(element[name]) for name in AMOUNT_FIELDS]
    quantities = [safe_integer(element[name]) for name in QUANTITY_FIELDS]
    number = (F.col("position") + 1).cast("bigint")
    return elements.select(
        _line_id(number).alias("line_item_id"),
        "event_id",
        "order_id",
        F.coalesce(*ids).alias("product_id"),
        F.coalesce(*quantities, F.lit(1).cast("bigint")).alias("order_qty"),
        F.coalesce(*amounts, F.col("price_raw")).alias("line_amount"),
        "currency_code",
        number.alias("line_number"),
    ).where(F.col("product_id").isNotNull())


def event_level_lines(checkouts: DataFrame, from_cart: DataFrame) -> DataFrame:
    """One line from the event itself where no event of that id has a cart line.

    The other side of the anti join is only the ids of events with cart lines.
    Both sides stay narrow, with the ids packed, and Spark may split a hot id on the left.
    """
    event = packed_id(F.col("event_id")).alias("_event")
    in_cart = from_cart.select(event).distinct()
    single = checkouts.where(F.col("product_id").isNotNull()).select(
        event, "order_id", "product_id", "price_raw", "currency_code"
    )
    one = F.lit(1).cast("bigint")
    alone = single.join(in_cart, "_event", "left_anti")
    return alone.withColumn("event_id", unpacked_id(F.col("_event"))).select(
        _line_id(one).alias("line_item_id"),
        "event_id",
        "order_id",
        "product_id",
        one.alias("order_qty"),
        F.col("price_raw").alias("line_amount"),
        "currency_code",
        one.alias("line_number"),
    )


def checkout_line_items(
    checkouts: DataFrame, from_cart: DataFrame | None = None, from_event: DataFrame | None = None
) -> DataFrame:
    """Checkout lines from carts and, failing those, from the event itself.

    The amount is the line's price as sent, not price times quantity. Both
    branches need the cart lines: pass a written ``cart_lines`` table to have the
    carts parsed once, and a written ``event_level_lines`` table to have them joined once.
    """
    if from_cart is None:
        from_cart = cart_lines(checkouts)
    if from_event is None:
        from_event = event_level_lines(checkouts, from_cart)
    lines = from_cart.unionByName(from_event)
    unit_price = safe_divide(F.col("line_amount"), F.col("order_qty"))
    return lines.withColumn("unit_price", unit_price).select(*LINE_COLUMNS)
