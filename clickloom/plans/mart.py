"""Star schema: four dimensions, the line-level sales fact, the reporting view."""

from __future__ import annotations

import operator
from datetime import date
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.labels import PAYMENT_LABELS, metal_type, payment_label, stone_type
from clickloom.functions.numbers import safe_divide
from clickloom.functions.temporal import date_key, week_from_sunday
from clickloom.functions.text import packed_id, unpacked_id
from clickloom.operators.joins import lookup_join, spread_nulls
from clickloom.operators.keys import numbered, placed, with_dense_key
from clickloom.plans.staging import (
    cart_lines,
    checkout_events,
    checkout_line_items,
    event_level_lines,
    latest_ip_locations,
    latest_products,
    line_number_of,
    with_line_id,
    without_line_id,
)
from clickloom.sources.versions import VersionedTable
from clickloom.workspace import discard, materialise

LOCATION_COLUMNS = [
    "country_short",
    "country_name",
    "region_name",
    "city_name",
    "latitude",
    "longitude",
    "timezone",
    "geo_source",
]
#: A location is looked up by these; coordinates and time zone do not take part,
#: so a place with two coordinates matches twice.
LOCATION_JOIN = ["country_short", "country_name", "region_name", "city_name", "geo_source"]
#: What a checkout says of its place.
SEEN_COLUMNS = ["ip", "country_event", "city_event"]
CUSTOMER_COLUMNS = ["device_id", "user_id_db", "email_address"]


def _ordered(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def _any_present(columns: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNotNull() for c in columns])


def dim_date(checkouts: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last checkout."""
    bounds = checkouts.agg(F.min("event_date").alias("first"), F.max("event_date").alias("last"))
    days = bounds.where("first is not null").select(
        F.explode(F.sequence("first", "last")).alias("full_date")
    )
    day = F.col("full_date")
    weekday = F.dayofweek(day).between(2, 6)
    return days.select(
        date_key(day).alias("date_key"),
        "full_date",
        F.year(day).cast("bigint").alias("year_number"),
        F.quarter(day).cast("bigint").alias("quarter_number"),
        F.month(day).cast("bigint").alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        week_from_sunday(day).alias("week_of_year"),
        F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofweek(day).cast("bigint").alias("day_of_week_number"),
        weekday.alias("is_weekday"),
        (~weekday).alias("is_weekend"),
    )


def dim_customer(checkouts: DataFrame) -> DataFrame:
    """Every distinct identity seen at checkout."""
    identities = checkouts.select(*CUSTOMER_COLUMNS).where(_any_present(CUSTOMER_COLUMNS)).distinct()
    keyed = with_dense_key(identities, "customer_key", _ordered(CUSTOMER_COLUMNS))
    known = _any_present(["user_id_db", "email_address"])
    return keyed.withColumn("is_identified_user", known)


def dim_product(products: DataFrame) -> DataFrame:
    """Staged products under a surrogate key."""
    columns = products.select(
        "product_id",
        "product_name",
        "source_url",
        "crawl_status_code",
        "is_crawl_success",
        F.col("updated_at").alias("product_updated_at"),
    )
    return with_dense_key(columns, "product_key", _ordered(["product_id"]))


def locate(events: DataFrame, ip_locations: DataFrame, row_id: str | None = None) -> DataFrame:
    """Add the place of each event: by IP, else the one the event itself names.

    Rows without an IP never match and are kept apart by ``row_id``; a hot IP is
    salted by it.
    """
    ip = spread_nulls(F.col("ip"), F.col(row_id)) if row_id else F.col("ip")
    places = ip_locations.drop("updated_at").withColumn("_found", F.lit(True))
    joined = lookup_join(events.withColumn("ip", ip), places, ["ip"], "left", row_id)
    return joined.withColumns(
        {
            "country_short": F.coalesce("country_short", "country_event"),
            "country_name": F.coalesce("country_name", "country_event"),
            "city_name": F.coalesce("city_name", "city_event"),
            "geo_source": F.when(F.col("_found"), "ip2location").otherwise("event_fallback"),
        }
    ).drop("_found", "ip", "country_event", "city_event")


def event_geo(checkouts: DataFrame, ip_locations: DataFrame) -> DataFrame:
    """Event id and place of every checkout."""
    rows = checkouts.select("event_id", "ip", "country_event", "city_event").withColumn(
        "_row", F.monotonically_increasing_id()
    )
    return locate(rows, ip_locations, "_row").select("event_id", *LOCATION_COLUMNS)


def dim_location(checkouts: DataFrame, ip_locations: DataFrame) -> DataFrame:
    """Every distinct place of a checkout that has a country or a city name.

    The events are reduced to distinct (ip, country, city) before the look-up,
    so no IP is hot in it.
    """
    seen = checkouts.select("ip", "country_event", "city_event").distinct()
    places = ip_locations.drop("updated_at").withColumn("_found", F.lit(True))
    located = seen.join(places, "ip", "left").select(
        F.coalesce("country_short", "country_event").alias("country_short"),
        F.coalesce("country_name", "country_event").alias("country_name"),
        "region_name",
        F.coalesce("city_name", "city_event").alias("city_name"),
        "latitude",
        "longitude",
        "timezone",
        F.when(F.col("_found"), "ip2location").otherwise("event_fallback").alias("geo_source"),
    )
    distinct = located.where(_any_present(["country_name", "city_name"])).distinct()
    return with_dense_key(distinct, "location_key", _ordered(LOCATION_COLUMNS))


def _exact(columns: list[str]) -> dict[str, Column]:
    """Join keys in which NULL is a value of its own and equals nothing else."""
    return {f"_{c}": F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in columns}


def _blank(columns: list[str]) -> dict[str, Column]:
    """Join keys in which NULL equals the empty string."""
    return {f"_{c}": F.coalesce(F.col(c), F.lit("")) for c in columns}


def sales_lines(
    checkouts: DataFrame,
    lines: DataFrame,
    ip_locations: DataFrame,
    product: DataFrame,
    customer: DataFrame,
    location: DataFrame,
) -> DataFrame:
    """Checkout lines with the keys of all dimensions, not numbered yet.

    Customers are looked up once per event, places once per distinct address, country and
    city (``location_keys``), before the events meet their lines. An event id that occurs on several events multiplies its lines,
    once through the events and once through their places.
    """
    event = packed_id(F.col("event_id")).alias("_event")
    numbered = checkouts.select(
        event, "event_date", "is_paypal_raw", *CUSTOMER_COLUMNS
    ).withColumn("_row", F.monotonically_increasing_id())

    who_keys = ["device_id", "_user_id_db", "_email_address"]
    buyers = numbered.where(F.col("device_id").isNotNull()).withColumns(_blank(CUSTOMER_COLUMNS[1:]))
    who = customer.where(F.col("device_id").isNotNull()).withColumns(_blank(CUSTOMER_COLUMNS[1:]))
    who = who.select("customer_key", *who_keys)
    bought = lookup_join(
        buyers.select("_event", "event_date", "is_paypal_raw", *who_keys, "_row"),
        who,
        who_keys,
        row_id="_row",
    ).select(
        "_event",
        date_key(F.col("event_date")).alias("date_key"),
        "customer_key",
        payment_label(F.col("is_paypal_raw")).alias("is_paypal"),
    )

    seen_keys = [f"_{c}" for c in SEEN_COLUMNS]
    where = checkouts.select(event, *SEEN_COLUMNS).withColumns(_exact(SEEN_COLUMNS))
    where = where.select("_event", *seen_keys).withColumn("_row", F.monotonically_increasing_id())
    found = location_keys(checkouts, ip_locations, location)
    placed = lookup_join(where, found, seen_keys, row_id="_row").select("_event", "location_key")

    # the unit price and the line's id follow from what a line has, so they needn't travel with it
    items = without_line_id(lines).withColumn("_event", event).drop("event_id", "unit_price", "line_number")
    items = items.withColumn("_row", F.monotonically_increasing_id())
    known = lookup_join(
        items, product.select("product_id", "product_key"), ["product_id"], row_id="_row"
    )
    return (
        known.join(bought, "_event")
        .join(placed, "_event")
        .withColumn("event_id", unpacked_id(F.col("_event")))
        .withColumn("line_item_id", F.concat("event_id", F.lit("-"), "_line"))
        .select(
            "date_key",
            "customer_key",
            "product_key",
            "location_key",
            "is_paypal",
            "event_id",
            "line_item_id",
            "order_id",
            "order_qty",
            F.col("line_amount").alias("sales_amount"),
            safe_divide(F.col("line_amount"), F.col("order_qty")).alias("unit_price"),
            "currency_code",
        )
    )


def location_keys(checkouts: DataFrame, ip_locations: DataFrame, location: DataFrame) -> DataFrame:
    """``location_key`` of every (ip, country, city) that a checkout has, see ``_exact``.

    Places are looked up once per combination and not once per event. A place with several
    keys gives a row each, one without any gives none.
    """
    seen = checkouts.select(*SEEN_COLUMNS).distinct().withColumns(_exact(SEEN_COLUMNS))
    seen = materialise(seen.withColumn("_row", F.monotonically_increasing_id()), "places-seen")
    where_keys, seen_keys = [f"_{c}" for c in LOCATION_JOIN], [f"_{c}" for c in SEEN_COLUMNS]
    located = locate(seen, ip_locations, "_row").withColumns(_blank(LOCATION_JOIN))
    located = materialise(located.select(*seen_keys, *where_keys, "_row"), "places-located")
    places = location.withColumns(_blank(LOCATION_JOIN)).select("location_key", *where_keys)
    return lookup_join(located, places, where_keys, row_id="_row").select(*seen_keys, "location_key")


def fact_sales(sales: DataFrame) -> DataFrame:
    """Number the sales lines by line id.

    ``sales`` is written first: the fact's joins then run once, and the row's
    place in the written files separates full copies of a row.
    """
    written = _stored_lines(sales, "sales-lines")
    fact = number_lines(written)
    discard(written)
    return fact


def _stored_lines(lines: DataFrame, name: str) -> DataFrame:
    """Lines written, and read again with all their columns."""
    return with_line_id(materialise(without_line_id(lines), name), lines.columns)


def number_lines(written: DataFrame) -> DataFrame:
    """``fact_sales`` of sales lines that are a written table, as a written table of its own.

    Of a line's id, which orders the lines, only its number and the packed event id are shuffled
    and stored; the event id follows from the line's id, so it orders nothing more.
    """
    key = "sales_order_line_key"
    rest = [c for c in written.columns if c not in ("line_item_id", "event_id")]
    packed = written.select(
        packed_id(F.col("event_id")).alias("_event"),
        line_number_of(F.col("line_item_id")).alias("_line"),
        *rest,
        F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_place_hash"),
    )
    line_id = F.concat(unpacked_id(F.col("_event")), F.lit("-"), F.col("_line"))
    ranged = packed.repartitionByRange(line_id.asc_nulls_first(), *_ordered(rest), "_place_hash")
    order = _ordered(["line_item_id", *rest])
    columns = ["_event", "_line", *rest]
    lines = materialise(placed(ranged.withColumn("line_item_id", line_id), order, columns), key)
    named = numbered(lines, key, columns).withColumn("event_id", unpacked_id(F.col("_event")))
    return with_line_id(named, [key, *written.columns])


def by_month(fact: DataFrame) -> DataFrame:
    """The fact laid out for reports: with its ``sales_month``, in ranges of days.

    Ranges are by day, then line, so a month of any size is split evenly and most
    files hold one month.
    """
    dated = fact.withColumn("sales_month", F.expr("date_key div 100").cast("int"))
    return dated.repartitionByRange("date_key", "sales_order_line_key")


def between_days(fact: DataFrame, first_day: date | str | None, last_day: date | str | None) -> DataFrame:
    """Fact rows of a range of days, both included; reads only the range's months."""
    for day, keeps in ((first_day, operator.ge), (last_day, operator.le)):
        if day is not None:
            key = int(f"{date.fromisoformat(str(day)):%Y%m%d}")
            fact = fact.where(keeps(F.col("date_key"), key) & keeps(F.col("sales_month"), key // 100))
    return fact


class Mart:
    """The tables of one build, each written when it is first asked for, and once.

    A table writes those it is made of and no others, so a report or a single dimension
    costs its own steps. The fact is partitioned by ``sales_month``.
    """

    def __init__(self, events: DataFrame, products: DataFrame, ip_locations: DataFrame):
        self._raw = events, products, ip_locations

    @cached_property
    def checkouts(self) -> DataFrame:
        return materialise(checkout_events(self._raw[0]), "checkouts")

    @cached_property
    def cart_lines(self) -> DataFrame:
        return _stored_lines(cart_lines(self.checkouts), "cart-lines")

    @cached_property
    def event_lines(self) -> DataFrame:
        return _stored_lines(event_level_lines(self.checkouts, self.cart_lines), "event-lines")

    @cached_property
    def lines(self) -> DataFrame:
        """All order lines: the two written kinds side by side."""
        return checkout_line_items(self.checkouts, self.cart_lines, self.event_lines)

    @cached_property
    def ip_locations(self) -> DataFrame:
        return materialise(latest_ip_locations(self._raw[2]), "ip-latest")

    @cached_property
    def dim_date(self) -> DataFrame:
        return materialise(dim_date(self.checkouts), "dim-date")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return materialise(dim_customer(self.checkouts), "dim-customer")

    @cached_property
    def dim_product(self) -> DataFrame:
        return materialise(dim_product(latest_products(self._raw[1])), "dim-product")

    @cached_property
    def dim_location(self) -> DataFrame:
        return materialise(dim_location(self.checkouts, self.ip_locations), "dim-location")

    def _sales(self) -> DataFrame:
        sales = sales_lines(
            self.checkouts, self.lines, self.ip_locations, self.dim_product, self.dim_customer, self.dim_location
        )
        return _stored_lines(sales, "sales-lines")

    @cached_property
    def sales(self) -> DataFrame:
        """The fact's rows without their numbers: before they are laid out by month, or, where
        the fact is there first, from it."""
        if "fact" in self.__dict__:
            return self.fact.drop("sales_order_line_key", "sales_month")
        return self._sales()

    @cached_property
    def fact(self) -> DataFrame:
        known = self.__dict__.get("sales")
        sales = self._sales() if known is None else known
        lines = number_lines(sales)
        if known is None:
            discard(sales)
        packed = without_line_id(lines).withColumn("event_id", packed_id(F.col("event_id")))
        laid_out = by_month(packed).withColumn("event_id", unpacked_id(F.col("event_id")))
        stored = materialise(laid_out, "fact-sales", "sales_month")
        discard(lines)
        return with_line_id(stored, [*lines.columns, "sales_month"])

    def view(
        self, *columns: str, first_day: date | str | None = None, last_day: date | str | None = None
    ) -> DataFrame:
        """The reporting view, or some of its columns, of all days or a range of them.

        See ``sales_performance``. All days without the line key need no numbered lines.
        """
        wanted = columns or VIEW_COLUMNS
        numbered = "sales_order_line_key" in wanted or first_day is not None or last_day is not None
        fact = between_days(self.fact, first_day, last_day) if numbered else self.sales
        return sales_performance(
            fact, self.dim_date, self.dim_product, self.dim_location, list(columns)
        )

    def totals(self, *columns: str) -> DataFrame:
        """View columns with sales and quantity added up per combination of dimension keys.

        The fact shrinks to one row per key combination before it meets a
        dimension, so a best-selling product or place is one row per task there.
        Good for sums over the given columns, not for counting orders.
        """
        keys = [key for key, parts in _DIMENSION_PARTS.items() if set(parts) & set(columns)]
        plain = [c for c in columns if c in self.sales.columns]
        added = (
            self.sales.where(F.col("date_key").isNotNull())
            .groupBy(*dict.fromkeys(keys + plain))
            .agg(F.sum("sales_amount").alias("sales_amount"), F.sum("order_qty").alias("order_qty"))
        )
        wanted = [*columns, "sales_amount", "order_qty"]
        return sales_performance(added, self.dim_date, self.dim_product, self.dim_location, wanted)

    def tables(self) -> dict[str, DataFrame]:
        """Dimensions and fact under the names they are published by."""
        return {
            "dim_date": self.dim_date,
            "dim_customer": self.dim_customer,
            "dim_product": self.dim_product,
            "dim_location": self.dim_location,
            "fact_sales_order_detail": self.fact,
        }

    def discard(self) -> None:
        """Delete what this build has written, once no plan reads it any more."""
        for name in [n for n, value in self.__dict__.items() if isinstance(value, DataFrame)]:
            discard(self.__dict__.pop(name))

    def publish(self, path: str) -> None:
        """Replace the published tables, each without a gap; see ``read_published``."""
        for name, df in self.tables().items():
            months = ["sales_month"] if df is self.fact else []
            VersionedTable(df.sparkSession, f"{path}/{name}").publish(df, *months)

    def register(self) -> None:
        """Name staging, mart and reporting view for SQL users of the session."""
        views = {
            "stg_events__checkout_success": self.checkouts,
            "stg_checkout_line_items": self.lines,
            "stg_ip_locations": self.ip_locations,
            "vw_sales_performance": self.view(),
        }
        for name, df in (views | self.tables()).items():
            df.createOrReplaceTempView(name)


def read_published(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of the mart's published tables as it is now."""
    return VersionedTable(spark, f"{path}/{name}").read()


def build_mart(events: DataFrame, products: DataFrame, ip_locations: DataFrame) -> Mart:
    """Star schema of the raw tables; see ``Mart`` for when what is written."""
    return Mart(events, products, ip_locations)


_DATE_PARTS = [
    "full_date",
    "year_number",
    "month_number",
    "month_name",
    "quarter_number",
    "day_of_week",
]
_PRODUCT_PARTS = ["product_id", "product_name"]
_PLACE_PARTS = ["country_name", "country_short", "city_name", "region_name"]
_PARSED_PARTS = {"metal_type": metal_type, "stone_type": stone_type}
#: Dimension key of the fact -> view columns that need the dimension.
_DIMENSION_PARTS = {
    "date_key": _DATE_PARTS,
    "product_key": [*_PRODUCT_PARTS, *_PARSED_PARTS],
    "location_key": _PLACE_PARTS,
}
VIEW_COLUMNS = [
    "sales_order_line_key",
    "order_id",
    "event_id",
    "order_qty",
    "sales_amount",
    "unit_price",
    "currency_code",
    "is_paypal",
    *_DATE_PARTS,
    *_PRODUCT_PARTS,
    *_PLACE_PARTS,
    *_PARSED_PARTS,
]


def sales_performance(
    fact: DataFrame,
    days: DataFrame,
    product: DataFrame,
    location: DataFrame,
    columns: list[str] | None = None,
) -> DataFrame:
    """Denormalised reporting view; no customer columns, so nothing personal.

    With ``columns`` only the dimensions they come from are joined. Every product
    and place key of the fact exists in its dimension, and so does every date key
    that is not NULL, so leaving a join out changes no other column.

    Dimensions are not hinted: Spark broadcasts those whose size is below the
    threshold and shuffles the others.
    """
    columns = columns or VIEW_COLUMNS
    joined = fact
    for key, dimension in (("date_key", days), ("product_key", product), ("location_key", location)):
        stored = [c for c in _DIMENSION_PARTS[key] if c in dimension.columns]
        if set(_DIMENSION_PARTS[key]) & set(columns):
            joined = joined.join(dimension.select(key, *stored), key)
        elif key == "date_key" and key in fact.columns:
            joined = joined.where(F.col(key).isNotNull())
    parsed = {c: rule(F.col("product_name")) for c, rule in _PARSED_PARTS.items() if c in columns}
    return joined.select(*[parsed[c].alias(c) if c in parsed else c for c in columns])


# -- documented extras -----------------------------------------------------------


def customer_masked(customer: DataFrame) -> DataFrame:
    """Customers for reports: a hash in place of the e-mail address."""
    return customer.withColumn("email_hash", F.sha2("email_address", 256)).drop("email_address")


def customer_seen_dates(checkouts: DataFrame, customer: DataFrame) -> DataFrame:
    """First and last checkout day of each customer.

    Events are reduced to one row per identity before they meet the dimension.
    """
    spans = checkouts.groupBy(*CUSTOMER_COLUMNS).agg(
        F.min("event_date").alias("first_seen_date"), F.max("event_date").alias("last_seen_date")
    )
    same = [customer[c].eqNullSafe(spans[c]) for c in CUSTOMER_COLUMNS]
    return customer.join(spans, reduce(Column.__and__, same)).select(
        "customer_key", "first_seen_date", "last_seen_date"
    )


def dim_payment_method(checkouts: DataFrame) -> DataFrame:
    """The three payment methods in their fixed order, with the checkouts of each."""
    methods = checkouts.sparkSession.createDataFrame(
        list(enumerate(PAYMENT_LABELS, start=1)),
        "payment_method_key bigint, payment_method string",
    )
    used = checkouts.groupBy(payment_label(F.col("is_paypal_raw")).alias("payment_method")).agg(
        F.count(F.lit(1)).alias("checkouts")
    )
    return methods.join(used, "payment_method", "left").select(
        "payment_method_key",
        "payment_method",
        F.coalesce("checkouts", F.lit(0)).cast("bigint").alias("checkouts"),
    )


def dim_geo(ip_locations: DataFrame) -> DataFrame:
    """Locations by hashed IP, for joins that must not show the address."""
    return ip_locations.select(
        F.sha2("ip", 256).alias("ip_hash"),
        "country_short",
        "country_name",
        "region_name",
        "city_name",
    )
