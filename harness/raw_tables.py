"""Raw domain tables derived from the generated test tables.

Each is one SQL text that Spark and DuckDB both run. The rules use integer
arithmetic and concatenation only. The few fragments that differ per engine are
written ``@name(...)`` and filled in by ``for_spark`` / ``for_duckdb``.

Every checkout event comes from one line item and its order, so the events grow
with the largest table and no order's lines are ever gathered in one row. Copies of a
line are one event, as event ids are unique at the source.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from clickloom.workspace import materialise

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def _text(expression: str) -> str:
    return f"cast({expression} as string)"


def _dotted(number: str) -> str:
    """Dotted IPv4 text of a number from 0, starting at 1.0.0.0."""
    octets = [
        f"1 + floor(({number}) / 16777216) % 223",
        f"floor(({number}) / 65536) % 256",
        f"floor(({number}) / 256) % 256",
        f"({number}) % 256",
    ]
    return " || '.' || ".join(_text(f"cast({o} as bigint)") for o in octets)


_CART = """
case
  when k % 10 = 0 then '[]'
  when k % 10 = 1 then '{"product_id":"9","qty":1}'
  when k % 10 = 2 then null
  else '[{'
    || case when p % 50 = 7 then '"product_id":{"v":1},"id":"' || @s(p) || '",'
            when p % 50 = 9 then '"product_id":123456789012345678901234567890' || @s(p) || ','
            when p % 50 = 11 then '"id":"x' || @s(p) || '","id":"' || @s(p) || '","product_id":"' || @s(p) || '",'
            when p % 3 = 0 then '"product_id":"' || @s(p) || '",'
            when p % 3 = 1 then '"productId":' || @s(p) || ','
            else '"product_id":null,"id":"' || @s(p) || '",' end
    || case when s % 41 = 0 then '"qty":0,'
            when s % 5 = 0 then '"qty":' || @s(q) || ','
            when s % 7 = 1 then '"qty":2.0,"quantity":' || @s(q) || ','
            when s % 5 = 1 then '"quantity":"' || @s(q) || '",'
            when s % 5 = 2 then '"order_qty":' || @s(q) || ','
            when s % 5 = 3 then ''
            else '"qty":"2.0","quantity":' || @s(q) || ',' end
    || case when (p + s) % 6 = 0 then '"price":' || amt || ','
            when (p + s) % 6 = 1 then '"price":"' || amt || '",'
            when (p + s) % 6 = 2 then '"amount":"' || amt || '",'
            when (p + s) % 6 = 3 then '"line_amount":' || amt || ','
            when (p + s) % 6 = 4 then ''
            else '"price":"1,234.5","amount":' || amt || ',' end
    || '"n":1}'
    || case when s % 3 = 0 then ',{"sku":"x","qty":1}' else '' end
    || case when s % 4 = 0
            then ',{"id":"' || @s((p * 3 + s) % 2000) || '","qty":"' || @s(1 + n) || '","price":"' || @s(10 + p % 90) || '.25"}'
            else '' end
    || ']'
end
"""

_CHECKOUTS = f"""
select
  case when k % 997 = 0 then null
       when k % 991 = 0 then '{{"oid":"' || oid || '"}}'
       else '{{"$oid":"' || oid || '"}}' end as _id,
  t as time_stamp,
  case when k % 6 = 5 then 'order_placed' else 'checkout_success' end as collection,
  case when k % 2 = 0 then null else 'checkout_success' end as event_name,
  'shop-' || @s(k % 3) as app_id,
  case when c % 211 = 0 then null else 'dev-' || @s(c % 700) end as device_id,
  case when c % 17 = 0 then null
       when c % 23 = 1 then ''
       when c % 19 = 0 then '2001:db8::' || @s(c % 10000)
       else {_dotted('4 * c + k % 4')} end as ip,
  case when c % 9 = 0 then null else 'NATION_' || @s(c % 25) end as country,
  cast(null as string) as region,
  case when c % 8 = 0 then null else 'CITY_' || @s(c % 40) end as city,
  'https://shop.example/checkout/' || @s(k) as current_url,
  cast(null as string) as referrer_url,
  'agent-' || @s(s % 4) as user_agent,
  '1920x1080' as resolution,
  case when c % 2 = 0 then 'en' else 'fr' end as language,
  @s(s % 12) as store_id,
  case when c % 13 = 0 then '' when c % 3 = 0 then @s(c) else null end as user_id_db,
  case when k % 3 = 0 then null else @s(k % 2000) end as product_id,
  cast(null as string) as viewing_product_id,
  case when k % 97 = 0 then 'N/A' else amt end as price,
  case k % 3 when 0 then 'EUR' when 1 then 'USD' else 'GBP' end as currency,
  cast(null as string) as key_search,
  case k % 7 when 0 then 'true' when 1 then 'false' when 2 then '1' when 3 then '0'
             when 4 then 'YES' when 5 then null else 'maybe' end as is_paypal,
  k % 2 = 0 as recommendation,
  cast(null as boolean) as show_recommendation,
  case when c % 13 = 0 then null when c % 4 = 0 then 'user' || @s(c) || '@mail.example' else null end as email_address,
  {_CART} as cart_products,
  case when s % 2 = 0 then '{{"size":"' || @s(s % 9) || '"}}' else null end as option,
  @s(k) as order_id,
  @s(p % 30) as cat_id,
  cast(null as string) as collect_id,
  '2024-03-0' || @s(1 + k % 5) as ingest_date
from (
  select
    l_orderkey as k, o_custkey as c, l_partkey as p, l_suppkey as s, l_linenumber as n,
    cast(l_quantity as bigint) as q,
    cast(cast(l_extendedprice as decimal(18,2)) as string) as amt,
    @days(o_orderdate) * 86400 + (l_orderkey * 7 + l_partkey) % 86400 as t,
    substr(md5(@s(l_orderkey) || '/' || @s(l_linenumber) || '/' || @s(l_partkey) || '/'
      || @s(l_suppkey) || '/' || @s(o_custkey) || '/' || cast(cast(l_extendedprice as decimal(18,2)) as string)), 1, 24) as oid
  from lineitem as l
    join orders as o on l_orderkey = o_orderkey
) as lines
"""

_BEHAVIOUR = f"""
select
  '{{"$oid":"' || lpad(@s(event_id), 24, '0') || '"}}' as _id,
  case when event_id % 500 = 3 then null
       else @days(ts) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + cast(floor(second(ts)) as bigint) end as time_stamp,
  case event_type when 'view' then 'view_product_detail' when 'click' then 'select_product_option'
                  when 'purchase' then 'add_to_cart_action' else event_type end as collection,
  case when event_id % 6 = 0 then event_type else null end as event_name,
  'shop-' || @s(event_id % 3) as app_id,
  'dev-' || @s(user_id) as device_id,
  case when event_id % 29 = 0 then null when event_id % 31 = 0 then '' else {_dotted('4 * user_id + event_id % 4')} end as ip,
  'NATION_' || @s(user_id % 25) as country,
  cast(null as string) as region,
  'CITY_' || @s(user_id % 40) as city,
  case when event_id % 5 = 0 then null when event_id % 7 = 0 then ''
       else 'https://shop.example/p/' || @s(event_id * 7 % 2000) || '?e=' || @s(event_id % 10) end as current_url,
  case when event_id % 3 = 0 then null else 'https://ref.example/' || @s(event_id % 100) end as referrer_url,
  'agent-' || @s(event_id % 4) as user_agent,
  '1280x720' as resolution,
  'en' as language,
  @s(event_id % 12) as store_id,
  case when user_id % 3 = 0 then @s(user_id) else null end as user_id_db,
  case when event_id % 4 = 0 then null else @s(event_id * 7 % 2000) end as product_id,
  case when event_id % 8 = 0 then null else @s(event_id * 11 % 2000) end as viewing_product_id,
  cast(null as string) as price,
  cast(null as string) as currency,
  cast(null as string) as key_search,
  cast(null as string) as is_paypal,
  cast(null as boolean) as recommendation,
  event_id % 2 = 0 as show_recommendation,
  cast(null as string) as email_address,
  cast(null as string) as cart_products,
  props as option,
  cast(null as string) as order_id,
  @s(event_id % 30) as cat_id,
  cast(null as string) as collect_id,
  '2024-03-0' || @s(1 + event_id % 5) as ingest_date
from events
"""

_IP_LOCATIONS = f"""
select
  case when c % 19 = 0 then '2001:db8::' || @s(c % 10000) else {_dotted('4 * c + j')} end as ip,
  case when c % 51 = 0 then null else 'C' || @s(n_nationkey) end as country_short,
  n_name as country_long,
  case when cn % 7 = 0 then null else 'REGION_' || @s(n_regionkey) end as region,
  'CITY_' || @s(cn) as city,
  cast(case when cn % 37 = 0 then 95.5 when c % 53 = 0 then (cn * 7 % 181) - 90.5 else (cn * 7 % 181) - 90.0 end as double) as latitude,
  cast(case when cn % 41 = 0 then 200.25 else (cn * 11 % 361) - 180.0 end as double) as longitude,
  lpad(@s(c % 100000), 5, '0') as zipcode,
  '+0' || @s(n_nationkey % 10) || ':00' as timezone,
  case when v = 1 and c % 12 = 0 then cast(null as @ts)
       when v = 1 and c % 30 = 6 then cast('2024-01-' || lpad(@s(1 + c % 28), 2, '0') || ' 00:00:00' as @ts)
       else cast('2024-0' || @s(1 + v) || '-' || lpad(@s(1 + c % 28), 2, '0') || ' 00:00:00' as @ts) end as updated_at,
  '2024-03-01' as ingest_date
from (
  select c_custkey as c, c_nationkey, (c_custkey + v * 5) % 997 as cn, j, v
  from (select c_custkey, c_nationkey, i % 3 as j, cast(floor(i / 3) as bigint) as v
        from (select c_custkey, c_nationkey, @series6 as i from customer) as copies) as versions
  where c_custkey % 10 <> 7 and (v = 0 or c_custkey % 6 = 0) and (j = 0 or c_custkey % 19 <> 0)
) as places join nation on c_nationkey = n_nationkey
"""

_PRODUCTS = """
select
  @s(p) as product_id,
  case when state in (0, 1, 2, 3, 4) then null
       else p_name
         || case p % 7 when 0 then ' 18K Gold' when 1 then ' 585 Gold' when 2 then ' 9k' when 3 then ' Silver'
                       when 4 then ' Platinum 950' when 5 then ' 750/925' else '' end
         || case p % 8 when 0 then ' Diamond' when 1 then ' sapphire' when 2 then ' Topaz' when 3 then ' Zirconia'
                       when 4 then ' EMERALD' when 5 then ' Ruby' else '' end end as product_name,
  'https://shop.example/p/' || @s(p) as source_url,
  cast(case state when 0 then 403 when 1 then 0 when 2 then 404 when 4 then 429
             else case when p % 97 = 0 then null else 200 end end as bigint) as status,
  case state when 0 then 'blocked_403' when 1 then 'request_error:ConnectionError' when 2 then 'http_404'
             when 3 then 'no_name_found' when 4 then 'blocked_429' else null end as error,
  case when v = 1 and p % 15 = 0 then cast(null as @ts)
       else cast('2024-0' || @s(1 + v) || '-' || lpad(@s(1 + p % 28), 2, '0') || ' 12:00:00' as @ts) end as updated_at,
  '2024-03-02' as ingest_date
from (
  select p_partkey as p, p_name, v, (p_partkey + v * 3) % 10 as state
  from (select p_partkey, p_name, @series2 as v from part) as versions
  where p_partkey % 29 <> 0 and (v = 0 or p_partkey % 5 = 0)
) as crawled
"""

_IP_RANGES = f"""
select distinct
  case when c_custkey % 19 = 0 then '2001:db8::' || @s(c_custkey % 10000) else {_dotted('4 * c_custkey')} end as ip_from,
  case when c_custkey % 19 = 0 then '2001:db8::' || @s(c_custkey % 10000) else {_dotted('4 * c_custkey + 2')} end as ip_to,
  'C' || @s(n_nationkey) as country_short,
  n_name as country_long,
  'REGION_' || @s(n_regionkey) as region,
  'CITY_' || @s(c_custkey % 997) as city,
  cast((c_custkey * 7 % 181) - 90 as double) as latitude,
  cast((c_custkey * 11 % 361) - 180 as double) as longitude,
  lpad(@s(c_custkey % 100000), 5, '0') as zipcode,
  '+0' || @s(n_nationkey % 10) || ':00' as timezone,
  c_custkey
from customer join nation on c_nationkey = n_nationkey
where c_custkey % 10 <> 7
"""



def _blocks(group: str, low: str, high: str) -> str:
    """Address blocks around the ranges of so many customers."""
    return f"""
select
  {_dotted(low)}, {_dotted(high)}, 'N' || @s(g), 'BLOCK_{group}', 'REGION_' || @s(g % 7), 'CITY_' || @s(g),
  cast(g % 90 as double), cast(g % 180 as double), lpad(@s(g % 100000), 5, '0'), '+00:00', -g
from (select distinct cast(floor(c_custkey / {group}) as bigint) as g from customer) as groups{group}
"""


# blocks within blocks, and some that cross the next one
_IP_NETWORKS = "union all".join([
    _IP_RANGES,
    _blocks("20", "80 * g", "80 * g + 79"),
    _blocks("200", "800 * g", "800 * g + 760"),
    _blocks("300", "1200 * g + 500", "1200 * g + 1900"),
])

_MANIFEST = """
select
  'lake-' || @s(o_custkey % 3) as bucket,
  case when o_orderkey % 11 = 0 then 'other/'
       else 'raw/shop/' end
    || case o_orderkey % 5 when 0 then 'ip_locations' when 1 then 'products' else 'events' end
    || '/ingest_date=2024-0' || @s(1 + o_orderkey % 3) || '-1' || @s(o_orderkey % 10)
    || case when o_orderkey % 23 = 0 then '-smoke' else '' end || '/'
    || case o_orderkey % 5 when 0 then 'ip_locations.csv.gz' when 1 then 'products.csv.gz'
            else 'events_part-' || lpad(@s(o_orderkey), 8, '0') || case when o_orderkey % 7 = 0 then '.json' else '.ndjson.gz' end end as name,
  case when o_orderkey % 13 = 0 then null else o_orderkey * 1000 end as generation,
  o_orderkey as object_no
from orders
"""

_PAGES = """
select
  page_id, url,
  case when page_id % 35 = 0 then regexp_replace(regexp_replace(html, '<title>[^<]*</title>', '<title> </title>'), '<h1>[^<]*</h1>', '')
       when page_id % 7 = 0 then regexp_replace(html, '<title>[^<]*</title>', '<title> </title>')
       when page_id % 3 = 0 then regexp_replace(html, '<title>', '<meta property="og:title" content="  Social   name ' || @s(page_id) || ' &amp; more "><title>')
       else html end as html
from pages
"""

_CRAWL_LOG = """
select
  @s(p_partkey) as product_id,
  case when p_partkey % 6 = 5 then '' when p_partkey % 7 = 3 then null else p_name end as product_name,
  'https://shop.example/p/' || @s(p_partkey) as source_url,
  cast(case when p_partkey % 9 = 8 then null
            else case p_partkey % 8 when 0 then 403 when 1 then 429 when 2 then 503 when 3 then 404 when 4 then 500 else 200 end
       end as bigint) as status,
  case when p_partkey % 9 = 8 then case when p_partkey % 2 = 0 then 'ConnectTimeout' else 'ConnectionError' end end as exception,
  cast('2024-04-' || lpad(@s(1 + p_partkey % 28), 2, '0') || ' 08:30:00' as @ts) as updated_at
from part
"""

SOURCES = {
    "raw_checkouts": _CHECKOUTS,
    "raw_behaviour": _BEHAVIOUR,
    "raw_ip_locations": _IP_LOCATIONS,
    "raw_products": _PRODUCTS,
    "ip_ranges": _IP_RANGES,
    "ip_networks": _IP_NETWORKS,
    "manifest": _MANIFEST,
    "raw_pages": _PAGES,
    "crawl_log": _CRAWL_LOG,
}


def _fill(text: str, fragments: dict[str, str]) -> str:
    for name, replacement in fragments.items():
        text = re.sub(rf"@{name}\b", lambda _: replacement, text)
    text = re.sub(r"@s\(((?:[^()]|\([^()]*\))*)\)", r"cast(\1 as string)", text)
    return text


def for_spark(name: str) -> str:
    text = _fill(
        SOURCES[name],
        {
            "ts": "timestamp_ntz",
            "series6": "explode(array(0, 1, 2, 3, 4, 5))",
            "series2": "explode(array(0, 1))",
        },
    )
    return re.sub(r"@days\((\w+)\)", r"cast(unix_date(cast(\1 as date)) as bigint)", text)


def for_duckdb(name: str) -> str:
    text = _fill(
        SOURCES[name],
        {
            "ts": "timestamp",
            "series6": "unnest([0, 1, 2, 3, 4, 5])",
            "series2": "unnest([0, 1])",
        },
    )
    return re.sub(r"@days\((\w+)\)", r"date_diff('day', date '1970-01-01', cast(\1 as date))", text)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy view of one derived table."""
    text = for_spark(name)
    used = [t for t in TABLES if re.search(rf"(from|join) {t}\b", text)]
    for t in used:
        text = re.sub(rf"(from|join) {t}\b", rf"\1 {{{t}}}", text)
    # str.format-style placeholders: braces of JSON text must be doubled
    text = re.sub(r"[{}]", lambda m: m.group() * 2, text)
    for t in used:
        text = text.replace(f"{{{{{t}}}}}", f"{{{t}}}")
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, "raw_checkouts").unionByName(derive(spark, sf_dir, "raw_behaviour"))


class RawTables:
    """The three raw tables of one test folder, each written once on first use.

    In use they are stored tables; writing them gives the queries columns to
    prune and filters to push down, as a stored table does. ``events_view`` gives the
    events' rows without a copy of them: columns and filters reach the tables below.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def events_view(self) -> DataFrame:
        return raw_events(self.spark, self.sf_dir)

    @cached_property
    def events(self) -> DataFrame:
        return materialise(raw_events(self.spark, self.sf_dir), "raw-events")

    @cached_property
    def products(self) -> DataFrame:
        return materialise(derive(self.spark, self.sf_dir, "raw_products"), "raw-products")

    @cached_property
    def ip_locations(self) -> DataFrame:
        return materialise(derive(self.spark, self.sf_dir, "raw_ip_locations"), "raw-ips")
