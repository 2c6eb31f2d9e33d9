"""DuckDB twins of the registered queries, built from named WITH parts.

``PARTS`` are the shared intermediate tables, ``FINAL`` the queries. Each final
text is prefixed with exactly the parts it uses.
"""

from __future__ import annotations

import re

from clickloom.plans.collection import PRODUCT_EVENTS
from clickloom.sources.schemas import DECLARED_TYPES, RAW_SCHEMAS, REQUIRED, SEMI_STRUCTURED, declared_type
from harness import raw_tables

PRODUCT_COLLECTIONS = ", ".join(f"'{name}'" for name in PRODUCT_EVENTS)


def _scalar(field: str) -> str:
    return (
        f"case when json_type(el, '$.{field}') in ('OBJECT', 'ARRAY') then null "
        f"else json_extract_string(el, '$.{field}') end"
    )


def _whole(field: str) -> str:
    text = _scalar(field)
    return f"case when regexp_full_match(trim({text}), '[+-]?[0-9]+') then try_cast({text} as bigint) end"


def _number(field: str) -> str:
    return f"try_cast({_scalar(field)} as decimal(38,9))"


def _first(render, *fields: str) -> str:
    return ", ".join(render(f) for f in fields)


def _unit(amount: str, qty: str) -> str:
    """amount / qty half up at 9 decimals, in whole numbers; amounts have 2 decimals."""
    scaled = f"cast(cast({amount} * 100 as bigint) as hugeint) * 20000000"
    return f"case when {qty} <> 0 then cast(({scaled} + {qty}) // (2 * {qty}) as double) / 1e9 end"


def _money(value: str) -> str:
    return f"cast(cast({value} as decimal(18,2)) as double)"


def _label(name: str, rules: list[tuple[str, str]]) -> str:
    tests = " ".join(f"when regexp_matches(lower({name}), '{p}') then '{v}'" for p, v in rules)
    return f"case {tests} else 'Not Defined' end"


_METAL = _label(
    "product_name",
    [
        ("18k|750", "18K Gold - 750"),
        ("14k|585", "14K Gold - 585"),
        ("9k|375", "9K Gold - 375"),
        ("silver|925", "Silver - 925"),
        ("platinum|950", "Platinum - 950"),
    ],
)
_STONE = _label(
    "product_name",
    [
        ("diamond", "Diamond"),
        ("sapphire", "White Sapphire"),
        ("topaz", "White Topaz"),
        ("zirconia", "Zirconia"),
        ("emerald", "Emerald"),
        ("ruby", "Ruby"),
    ],
)
_PAYMENT = (
    "case when lower(is_paypal_raw) in ('true', '1', 'yes') then 'paypal' "
    "when lower(is_paypal_raw) in ('false', '0', 'no') then 'other' else 'unknown' end"
)


def _nulls_first(*columns: str) -> str:
    return ", ".join(f"{c} asc nulls first" for c in columns)


_IP_TIES = _nulls_first(
    *"country_short country_long region city latitude longitude timezone".split()
)
_PRODUCT_TIES = _nulls_first(*"product_name source_url status error ingest_date".split())
_PLACE = "country_short country_name region_name city_name latitude longitude timezone geo_source".split()
_SALES = (
    "date_key customer_key product_key location_key is_paypal event_id line_item_id order_id "
    "order_qty sales_amount unit_price currency_code"
).split()

PARTS: dict[str, str] = {name: raw_tables.for_duckdb(name) for name in raw_tables.SOURCES}
PARTS |= {
    "raw_ev": "select * from raw_checkouts union all select * from raw_behaviour",
    "co": """
        select *, make_timestamp(time_stamp * 1000000) as event_ts,
          cast(make_timestamp(time_stamp * 1000000) as date) as event_date
        from (
          select nullif(regexp_extract(_id, '"\\$oid"\\s*:\\s*"([^"]+)"', 1), '') as event_id,
            coalesce(event_name, collection) as event_type, time_stamp, device_id, user_id_db,
            email_address, ip, order_id, product_id, try_cast(price as decimal(38,9)) as price_raw,
            currency as currency_code, is_paypal as is_paypal_raw, country as country_event,
            city as city_event, cart_products
          from raw_ev where coalesce(event_name, collection) = 'checkout_success'
        ) as typed where event_id is not null""",
    "cart": f"""
        select event_id || '-' || n as line_item_id, event_id, order_id, product_id,
          coalesce(q1, q2, q3, 1) as order_qty, coalesce(a1, a2, a3, price_raw) as line_amount,
          currency_code, n as line_number
        from (
          select *, coalesce({_first(_scalar, "product_id", "productId", "id")}) as product_id,
            {_whole("qty")} as q1, {_whole("quantity")} as q2, {_whole("order_qty")} as q3,
            {_number("price")} as a1, {_number("amount")} as a2, {_number("line_amount")} as a3
          from (
            select event_id, order_id, currency_code, price_raw,
              unnest(json_extract(cart_products, '$[*]')) as el,
              cast(generate_subscripts(json_extract(cart_products, '$[*]'), 1) as bigint) as n
            from co where json_type(cart_products) = 'ARRAY'
          ) as elements
        ) as read where product_id is not null""",
    "fallback": """
        select event_id || '-1' as line_item_id, event_id, order_id, product_id,
          cast(1 as bigint) as order_qty, price_raw as line_amount, currency_code,
          cast(1 as bigint) as line_number
        from co where product_id is not null
          and not exists (select 1 from cart where cart.event_id = co.event_id)""",
    "items": f"""
        select *, {_unit("line_amount", "order_qty")} as unit_price
        from (select * from cart union all select * from fallback) as lines""",
    "prod": f"""
        select product_id, product_name, source_url, status as crawl_status_code,
          error as crawl_error, status = 200 as is_crawl_success, updated_at
        from raw_products
        qualify row_number() over (partition by product_id
          order by updated_at desc nulls last, {_PRODUCT_TIES}) = 1""",
    "ipl": f"""
        select ip, country_short, country_long as country_name, region as region_name,
          city as city_name, case when abs(latitude) <= 90 then latitude end as latitude,
          case when abs(longitude) <= 180 then longitude end as longitude, timezone, updated_at
        from (
          select * from raw_ip_locations
          qualify row_number() over (partition by ip
            order by updated_at desc nulls last, {_IP_TIES}) = 1
        ) as newest""",
    "geo": """
        select event_id, coalesce(country_short, country_event) as country_short,
          coalesce(country_name, country_event) as country_name, region_name,
          coalesce(city_name, city_event) as city_name, latitude, longitude, timezone,
          if(ipl.ip is null, 'event_fallback', 'ip2location') as geo_source
        from co left join ipl on co.ip = ipl.ip""",
    "d_date": """
        select cast(strftime(d, '%Y%m%d') as bigint) as date_key, d as full_date,
          year(d) as year_number, quarter(d) as quarter_number, month(d) as month_number,
          monthname(d) as month_name, cast(strftime(d, '%U') as bigint) as week_of_year,
          day(d) as day_of_month, dayname(d) as day_of_week, dayofweek(d) + 1 as day_of_week_number,
          dayofweek(d) between 1 and 5 as is_weekday, dayofweek(d) in (0, 6) as is_weekend
        from (
          select cast(unnest(generate_series(a, b, interval 1 day)) as date) as d
          from (select min(event_date) as a, max(event_date) as b from co) as span
        ) as days""",
    "d_customer": f"""
        select row_number() over (order by
            {_nulls_first("device_id", "user_id_db", "email_address")}) as customer_key,
          device_id, user_id_db, email_address,
          coalesce(user_id_db, email_address) is not null as is_identified_user
        from (select distinct device_id, user_id_db, email_address from co
              where coalesce(device_id, user_id_db, email_address) is not null) as people""",
    "d_product": """
        select row_number() over (order by product_id) as product_key, product_id, product_name,
          source_url, crawl_status_code, is_crawl_success, updated_at as product_updated_at
        from prod""",
    "d_location": f"""
        select row_number() over (order by {_nulls_first(*_PLACE)}) as location_key, *
        from (select distinct {", ".join(_PLACE)} from geo
              where coalesce(country_name, city_name) is not null) as places""",
    "sales": f"""
        select cast(strftime(co.event_date, '%Y%m%d') as bigint) as date_key, customer_key,
          product_key, location_key, {_PAYMENT} as is_paypal, items.event_id, line_item_id,
          items.order_id, order_qty, line_amount as sales_amount, unit_price, items.currency_code
        from items
          join co on co.event_id = items.event_id
          join d_product on d_product.product_id = items.product_id
          join d_customer as w on w.device_id = co.device_id
            and coalesce(w.user_id_db, '') = coalesce(co.user_id_db, '')
            and coalesce(w.email_address, '') = coalesce(co.email_address, '')
          join geo on geo.event_id = items.event_id
          join d_location as l on coalesce(l.country_short, '') = coalesce(geo.country_short, '')
            and coalesce(l.country_name, '') = coalesce(geo.country_name, '')
            and coalesce(l.region_name, '') = coalesce(geo.region_name, '')
            and coalesce(l.city_name, '') = coalesce(geo.city_name, '')
            and l.geo_source = geo.geo_source""",
    "fact": f"""
        select row_number() over (order by
            {_nulls_first("line_item_id", *[c for c in _SALES if c != "line_item_id"])}
          ) as sales_order_line_key, *
        from sales""",
    "vw": f"""
        select sales_order_line_key, order_id, event_id, order_qty, sales_amount, unit_price,
          currency_code, is_paypal, full_date, year_number, month_number, month_name,
          quarter_number, day_of_week, product_id, product_name, country_name, country_short,
          city_name, region_name, {_METAL} as metal_type, {_STONE} as stone_type
        from fact join d_date using (date_key) join d_product using (product_key)
          join d_location using (location_key)""",
    "product_ev": f"""
        select time_stamp, collection as event_name, product_id, viewing_product_id, current_url,
          referrer_url, device_id, ip
        from raw_ev where collection in ({PRODUCT_COLLECTIONS})""",
    "candidates": """
        select pid as product_id, url as best_url, time_stamp as last_seen_ts
        from (
          select coalesce(product_id, viewing_product_id) as pid,
            coalesce(current_url, referrer_url) as url, time_stamp
          from product_ev
        ) as seen
        where pid is not null and url <> ''
        qualify row_number() over (partition by pid
          order by time_stamp desc nulls last, url desc) = 1""",
    "ips": "select distinct ip from raw_ev where ip <> ''",
    "routed": f"""
        select *,
          case when name similar to 'raw/shop/events/ingest_date=[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}/events_part-[0-9]+[.]ndjson[.]gz' then 'events'
               when name similar to 'raw/shop/ip_locations/ingest_date=[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}/ip_locations[.]csv[.]gz' then 'ip_locations'
               when name similar to 'raw/shop/products/ingest_date=[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}/products[.]csv[.]gz' then 'products'
          end as target,
          substr(sha1(bucket || '/' || name || '@' || coalesce(cast(generation as varchar), '0')), 1, 32) as load_key
        from manifest""",
}

_LOADED = "'shop_load_' || load_key as load_id"


def _line_columns(table: str, unit_price: bool) -> str:
    extra = ", unit_price" if unit_price else ""
    amount = _money("line_amount")
    return (
        f"select line_item_id, event_id, order_id, product_id, order_qty, {amount} as line_amount, "
        f"currency_code, line_number{extra} from {table}"
    )


def _latest(table: str, key: str, columns: list[str], which: str) -> str:
    ties = _nulls_first(*[c for c in columns if c not in (key, "updated_at")])
    return (
        f"select {', '.join(columns)} from {table} where {which} "
        f"qualify row_number() over (partition by {key} order by updated_at desc nulls last, {ties}) = 1"
    )


def _upsert(table: str, key: str) -> str:
    schema = "ip_locations" if key == "ip" else "products"
    columns = RAW_SCHEMAS[schema].names
    shown = ", ".join("cast(updated_at as varchar) as updated_at" if c == "updated_at" else c for c in columns)
    old = "updated_at < timestamp '2024-02-01'"
    fresh = _latest(table, key, columns, f"not coalesce({old}, false)")
    return f"""
        select {shown} from (
          select {', '.join(columns)} from {table} where {old}
            and {key} not in (select {key} from {table} where not coalesce({old}, false))
          union all ({fresh})
        ) as merged"""


def _per_table(render) -> str:
    tables = {"events": "raw_ev", "ip_locations": "raw_ip_locations", "products": "raw_products"}
    return " union all ".join(
        render(source, t, c)
        for t, source in tables.items()
        for c in RAW_SCHEMAS[t].names
        if c not in SEMI_STRUCTURED[t]
    )


_SPARK_TO_SQL = {"string": "varchar", "timestamp_ntz": "timestamp"}


def _cast_check(source: str, table: str, column: str) -> str:
    kind = DECLARED_TYPES[table].get(column, RAW_SCHEMAS[table][column].dataType.simpleString())
    if kind == "boolean":
        bad = f"lower(cast({column} as varchar)) not in ('true', 'false')"
    else:
        bad = f"try_cast(cast({column} as varchar) as {_SPARK_TO_SQL.get(kind, kind)}) is null"
    return (
        f"select '{table}' as table_name, '{column}' as \"column\", '{kind}' as declared_type, "
        f"count(*) filter (where {column} is not null and {bad}) as rows_failing_cast from {source}"
    )


def _metrics(source: str, metrics: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{m}' as metric, cast({e} as varchar) as value from {source}" for m, e in metrics.items()
    )


def _by(dimension: str, *measures: str, name: str | None = None) -> str:
    shown = f"{dimension} as {name}" if name else dimension
    return f"select {shown}, {', '.join(measures)} from vw group by {dimension}"


_REVENUE = f"{_money('sum(sales_amount)')} as revenue"
_ORDERS = "count(distinct order_id) as order_count"
_UNITS = "cast(sum(order_qty) as bigint) as units"

_CHECKED = {
    "stg_checkout_events": "co",
    "stg_products": "prod",
    "stg_ip_locations": "ipl",
    "stg_checkout_line_items": "items",
    "dim_date": "d_date",
    "dim_customer": "d_customer",
    "dim_product": "d_product",
    "dim_location": "d_location",
    "fact_sales_order_detail": "fact",
}
_UNIQUE = """stg_checkout_events.event_id stg_products.product_id stg_ip_locations.ip
    stg_checkout_line_items.line_item_id dim_date.date_key dim_customer.customer_key
    dim_product.product_key dim_product.product_id dim_location.location_key
    fact_sales_order_detail.sales_order_line_key""".split()
_FILLED = _UNIQUE + """stg_checkout_events.event_date stg_checkout_line_items.event_id
    fact_sales_order_detail.date_key fact_sales_order_detail.customer_key
    fact_sales_order_detail.product_key fact_sales_order_detail.location_key""".split()


_FAULTY = {"co": "bad_co", "fact": "bad_fact"}


def _check(target: str, failures: str, faulty: bool = False) -> str:
    model, column = target.split(".")
    part = _CHECKED[model]
    body = failures.format(t=_FAULTY.get(part, part) if faulty else part, c=column)
    return f"select '{model}' as model, '{column}' as column_name, ({body}) as failures"


def _orphans(dimension: str, fact: str = "fact") -> str:
    model, key = f"dim_{dimension}", f"{dimension}_key"
    return (
        f"select 'fact_sales_order_detail' as model, '{key}' as column_name, '{model}' as parent, "
        f"(select count(*) from {fact} where {key} is not null "
        f"and {key} not in (select {key} from d_{dimension})) as failures"
    )


# HTML entities that occur in the test pages' names, the ampersand last
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")]


def _shown(text: str) -> str:
    for entity, character in _ENTITIES:
        text = f"replace({text}, '{entity}', '{character}')"
    return f"nullif(trim(regexp_replace({text}, '[\\s\\p{{Z}}]+', ' ', 'g')), '')"


_BETWEEN = "full_date between date '1996-02-01' and date '1999-10-31'"
_IP_NUMBER = (
    "case when {0} like '%.%' then cast(split_part({0}, '.', 1) as bigint) * 16777216 "
    "+ cast(split_part({0}, '.', 2) as bigint) * 65536 + cast(split_part({0}, '.', 3) as bigint) * 256 "
    "+ cast(split_part({0}, '.', 4) as bigint) else -1 - cast(split_part({0}, '::', 2) as bigint) end"
)

_TWICE = "select count(*) from (select {c} from {t} where {c} is not null group by {c} having count(*) > 1) as twice"

PARTS["bad_co"] = """
    select * replace (case when event_id not like '%1' then event_date end as event_date)
    from (select * from co union all select * from co where event_id like '%0') as doubled"""
PARTS["bad_fact"] = """
    select * replace (
        case when sales_order_line_key % 7 <> 0 then product_key end as product_key,
        case when sales_order_line_key % 11 = 0 then -customer_key else customer_key end as customer_key)
    from (select * from fact union all select * from fact where sales_order_line_key % 13 = 0) as doubled"""

FINAL: dict[str, str] = {
    "q_scan_events": f"select {', '.join(RAW_SCHEMAS['events'].names)} from raw_ev",
    "q_scan_ip_locations": "select ip, country_short, country_long, region, city, latitude, longitude, "
    "zipcode, timezone, cast(updated_at as varchar) as updated_at from raw_ip_locations",
    "q_scan_products": "select product_id, product_name, source_url, status, error, "
    "cast(updated_at as varchar) as updated_at from raw_products",
    "q_route_objects": """
        select bucket, name, generation, object_no, target as "table",
          case target when 'events' then 'append' when 'ip_locations' then 'overwrite' when 'products' then 'overwrite' end as write_mode,
          nullif(regexp_extract(name, '/ingest_date=([0-9]{4}-[0-9]{2}-[0-9]{2})/', 1), '') as ingest_date
        from routed""",
    "q_load_ids": "select object_no, load_key, 'shop_manual_load_' || load_key as load_id from routed",
    "q_pending_loads": f"""
        select target as "table", bucket, name, substr(split_part(name, 'ingest_date=', 2), 1, 10) as ingest_date,
          {_LOADED}, if(target = 'events', 'append', 'overwrite') as write_mode
        from routed where target is not null
          and load_key not in (select load_key from routed where object_no % 3 = 0)
        qualify row_number() over (partition by load_key) = 1""",
    "q_backfill_plan": f"""
        select target as "table", bucket, name,
          if(target = 'events', 'append', 'overwrite') as write_mode, {_LOADED}
        from routed where target is not null and name like '%/ingest_date=2024-02-17/%'""",
    "q_schema_additions": """
        select collection, campaign, count(*) as event_count, count(cat_id) as with_category
        from (select collection, null as campaign, cat_id from raw_ev
              union all select collection, 'c-' || cat_id, null from raw_ev) as whole
        group by collection, campaign""",
    "q_resumed_export": f"""
        select cast((position - 1) // 5000 as integer) as shard, count(*) as row_count,
          min(_id) as first_id, max(_id) as last_id, cast(sum(time_stamp) as bigint) as time_sum
        from (select _id, time_stamp, row_number() over (order by {_nulls_first(*RAW_SCHEMAS['events'].names)}) as position
              from raw_ev) as placed
        group by 1""",
    "q_concurrent_loads": """
        select 'events' as table_name, '2024-03-01' as ingest_date,
          coalesce(event_name, collection) as kind, count(*) as row_count from raw_ev group by 3
        union all select 'products', '2024-03-02', cast(status as varchar), count(*)
        from raw_products group by 3""",
    "q_replaced_table": """
        select status, count(*) as row_count, cast(version as integer) as version
        from raw_products, (values (1), (2)) as v(version) group by status, version""",
    "q_snapshot_rollback": """
        select 'first' as snapshot, country_short, count(*) as row_count
        from raw_ip_locations group by country_short""",
    "q_stream_file_ingest": """
        select 'events' as table_name, '2024-03-01' as ingest_date,
          coalesce(event_name, collection) as kind, count(*) as row_count from raw_ev group by 3
        union all
        select 'ip_locations', '2024-03-01', country_short, count(*) from raw_ip_locations group by 3
        union all
        select 'products', '2024-03-02', cast(status as varchar), count(*) from raw_products group by 3""",
    "q_unique_ips": "select ip from ips",
    "q_product_events": "select * from product_ev",
    "q_product_candidates": "select * from candidates",
    "q_crawl_queue": """
        select product_id, best_url, last_seen_ts
        from (select * from candidates order by last_seen_ts desc nulls last, product_id limit 500) as front
        where product_id not in (select product_id from raw_products)""",
    "q_new_products": """
        select product_id, best_url, last_seen_ts from candidates
        where product_id not in (select product_id from raw_products)""",
    "q_new_ips": """
        select ip from ips where ip not in (select ip from raw_ip_locations) order by ip limit 400""",
    "q_skipped_files": """
        select 'product_id' as column_name, product_id as value, count(*) as rows, true as most_skipped
        from raw_ev where product_id is not null group by product_id order by product_id limit 10""",
    "q_ip_range_enrich": f"""
        select p.ip, country_short, country_long, region, city, latitude, longitude, zipcode, timezone
        from (select ip, {_IP_NUMBER.format("ip")} as at from ips) as p
          left join (select *, {_IP_NUMBER.format("ip_from")} as low, {_IP_NUMBER.format("ip_to")} as high
                     from ip_ranges) as r on p.at between r.low and r.high""",
    "q_ip_nested_enrich": f"""
        select ip, country_short, country_long, region, city, latitude, longitude, zipcode, timezone
        from (
          select p.ip, r.*, row_number() over (
            partition by p.ip order by low desc, high, country_short desc nulls last) as nth
          from (select ip, {_IP_NUMBER.format("ip")} as at from ips) as p
            left join (select *, {_IP_NUMBER.format("ip_from")} as low, {_IP_NUMBER.format("ip_to")} as high
                       from ip_networks) as r on p.at between r.low and r.high) as around
        where nth = 1""",
    "q_crawl_outcome": """
        select product_id, if(error is null, product_name, null) as product_name, source_url,
          if(exception is not null, 0, status) as status, error, cast(updated_at as varchar) as updated_at
        from (
          select *, case when exception is not null then 'request_error:' || exception
            when status in (403, 429, 503) then 'blocked_' || status
            when status >= 400 then 'http_' || status
            when coalesce(product_name, '') = '' then 'no_name_found' end as error
          from crawl_log
        ) as outcome""",
    "q_upsert_products": _upsert("raw_products", "product_id"),
    "q_upsert_ip_locations": _upsert("raw_ip_locations", "ip"),
    "q_upsert_touched_products": _upsert("raw_products", "product_id"),
    "q_upsert_touched_ips": _upsert("raw_ip_locations", "ip"),
    "q_page_names": f"""
        select page_id, url, coalesce(
          {_shown("regexp_extract(html, '<meta property=.og:title. content=.([^>]*?).>', 1)")},
          {_shown("regexp_extract(html, '<title>([^<]*)</title>', 1)")},
          {_shown("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")}) as product_name
        from raw_pages""",
    "q_stage_parity": """
        select *, left_rows = right_rows as equal from (
          select 'unique_ips' as left_stage, 'ip_locations' as right_stage,
            (select count(*) from ips) as left_rows, (select count(*) from raw_ip_locations) as right_rows
          union all
          select 'product_candidates', 'products', (select count(*) from candidates),
            (select count(*) from raw_products)
        ) as stages""",
    "q_stg_checkout_events": f"""
        select event_id, event_type, time_stamp, cast(event_ts as varchar) as event_ts,
          cast(event_date as varchar) as event_date, device_id, user_id_db, email_address, ip,
          order_id, product_id, {_money("price_raw")} as price_raw, currency_code, is_paypal_raw,
          country_event, city_event, cart_products, price_raw is not null as is_price_valid
        from co""",
    "q_stg_products": "select * replace (cast(updated_at as varchar) as updated_at) from prod",
    "q_stg_ip_locations": "select * replace (cast(updated_at as varchar) as updated_at) from ipl",
    "q_line_items_cart": _line_columns("cart", False),
    "q_line_items_fallback": _line_columns("fallback", False),
    "q_stg_line_items": _line_columns("items", True),
    "q_payment_label": f"select event_id, is_paypal_raw, {_PAYMENT} as is_paypal from co",
    "q_metal_type": f"select product_id, product_name, {_METAL} as metal_type from prod",
    "q_stone_type": f"select product_id, product_name, {_STONE} as stone_type from prod",
    "q_event_geo": "select * from geo",
    "q_surrogate_keys": f"""
        select row_number() over (order by {_nulls_first(*"line_item_id event_id order_id product_id order_qty line_amount unit_price currency_code line_number".split())}) as line_key,
          line_item_id, product_id from items""",
    "q_dim_date": "select * replace (cast(full_date as varchar) as full_date) from d_date",
    "q_dim_customer": "select * from d_customer",
    "q_dim_product": "select * replace (cast(product_updated_at as varchar) as product_updated_at) from d_product",
    "q_dim_location": "select * from d_location",
    "q_fact_sales": f"select * replace ({_money('sales_amount')} as sales_amount) from fact",
    "q_vw_sales_performance": f"select * replace ({_money('sales_amount')} as sales_amount, "
    "cast(full_date as varchar) as full_date) from vw",
    "q_month_rebuild": f"select * exclude (sales_order_line_key) replace ({_money('sales_amount')} as sales_amount, "
    "cast(full_date as varchar) as full_date) from vw",
    "q_customer_masked": """
        select customer_key, device_id, user_id_db, is_identified_user,
          sha256(email_address) as email_hash from d_customer""",
    "q_customer_seen_dates": """
        select customer_key, cast(min(event_date) as varchar) as first_seen_date,
          cast(max(event_date) as varchar) as last_seen_date
        from d_customer as w join co on w.device_id is not distinct from co.device_id
          and w.user_id_db is not distinct from co.user_id_db
          and w.email_address is not distinct from co.email_address
        group by customer_key""",
    "q_dim_payment_method": f"""
        select m.payment_method_key, m.payment_method, count(co.event_id) as checkouts
        from (values (cast(1 as bigint), 'paypal'), (2, 'other'), (3, 'unknown'))
          as m(payment_method_key, payment_method)
          left join co on {_PAYMENT} = m.payment_method
        group by 1, 2""",
    "q_dim_geo_hashed": """
        select sha256(ip) as ip_hash, country_short, country_name, region_name, city_name from ipl""",
    "q_bi_scorecards": f"""
        select total_revenue, total_quantity, order_count,
          total_revenue / cast(sales_days as double) as daily_avg_revenue,
          cast(total_quantity as double) / cast(sales_days as double) as daily_avg_quantity,
          total_revenue / cast(order_count as double) as avg_order_value
        from (select {_money("sum(sales_amount)")} as total_revenue,
                cast(sum(order_qty) as bigint) as total_quantity, {_ORDERS},
                count(distinct full_date) as sales_days from vw) as totals""",
    "q_bi_revenue_by_day": f"select cast(full_date as varchar) as full_date, {_REVENUE} from vw group by 1",
    "q_bi_orders_by_day": f"select cast(full_date as varchar) as full_date, {_ORDERS} from vw group by 1",
    "q_bi_orders_united": " union all ".join(
        f"select '{level}' as level, {label} as label, {_ORDERS} from vw group by 2"
        for level, label in {
            "day": "cast(full_date as varchar)",
            "week": "cast(cast(date_trunc('week', full_date) as date) as varchar)",
            "month": "cast(cast(date_trunc('month', full_date) as date) as varchar)",
            "country": "country_name",
            "all": "'all'",
        }.items()
    ),
    "q_bi_trend_by_week": f"""
        select cast(cast(date_trunc('week', full_date) as date) as varchar) as period_start, {_REVENUE}, {_ORDERS}
        from vw group by 1""",
    "q_bi_trend_by_month": f"""
        select cast(cast(date_trunc('month', full_date) as date) as varchar) as period_start, {_REVENUE}, {_ORDERS}
        from vw group by 1""",
    "q_bi_top_stones": f"{_by('stone_type', _REVENUE)} order by sum(sales_amount) desc nulls last, 1 nulls first limit 5",
    "q_bi_top_products": f"{_by('product_name', _REVENUE)} order by sum(sales_amount) desc nulls last, 1 nulls first limit 5",
    "q_bi_metal_share": f"""
        select metal_type, revenue, revenue / (select {_money("sum(sales_amount)")} from vw) as share
        from ({_by("metal_type", _REVENUE)}) as parts""",
    "q_bi_revenue_by_country": _by("country_name", _REVENUE),
    "q_bi_geo_country_city": _by("country_name, city_name", _REVENUE, _ORDERS),
    "q_bi_product_performance": _by("product_id, product_name", _REVENUE, _UNITS),
    "q_bi_payment_breakdown": _by("is_paypal", _REVENUE, _ORDERS, _UNITS),
    "q_bi_filtered_sales": f"""
        select country_name, year_number, {_REVENUE}, {_ORDERS}, {_UNITS} from vw
        where country_name in ('NATION_3', 'NATION_8', 'NATION_21') and is_paypal = 'paypal' and {_BETWEEN}
        group by country_name, year_number""",
    "q_profile_events_kpi": _metrics(
        "raw_ev",
        {
            "row_count": "count(*)",
            "partition_dates_covered": "count(distinct ingest_date)",
            "distinct_event_names": "count(distinct coalesce(event_name, collection))",
            "distinct_product_ids": "count(distinct product_id)",
            "distinct_device_ids": "count(distinct device_id)",
            "distinct_ips": "count(distinct ip)",
            "min_time_stamp": "min(time_stamp)",
            "max_time_stamp": "max(time_stamp)",
        },
    ),
    "q_profile_ip_kpi": _metrics(
        "raw_ip_locations",
        {
            "row_count": "count(*)",
            "distinct_ip": "count(distinct ip)",
            "distinct_country": "count(distinct country_short)",
            "min_latitude": "min(latitude)",
            "max_latitude": "max(latitude)",
            "min_longitude": "min(longitude)",
            "max_longitude": "max(longitude)",
            "min_updated_at": "min(updated_at)",
            "max_updated_at": "max(updated_at)",
        },
    ),
    "q_profile_products_kpi": _metrics(
        "raw_products",
        {
            "row_count": "count(*)",
            "distinct_product_id": "count(distinct product_id)",
            "rows_with_product_name": "count(*) filter (where product_name <> '')",
            "rows_with_error": "count(*) filter (where error <> '')",
            "distinct_status_codes": "count(distinct status)",
            "min_updated_at": "min(updated_at)",
            "max_updated_at": "max(updated_at)",
        },
    ),
    "q_profile_nulls": _per_table(
        lambda source, t, c: f"select '{t}' as table_name, '{c}' as \"column\", "
        f"count(*) - count({c}) as null_count from {source}"
    ),
    "q_profile_approx_distinct": _per_table(
        lambda source, t, c: f"select '{t}' as table_name, '{c}' as \"column\", "
        f"count(*) - count({c}) as null_count, true as within_bound from {source}"
    ),
    "q_profile_incremental": _per_table(
        lambda source, t, c: f"select '{t}' as table_name, '{c}' as \"column\", "
        f"count(*) - count({c}) as null_count, true as within_bound from {source}"
    ),
    "q_profile_distinct": _per_table(
        lambda source, t, c: f"select '{t}' as table_name, '{c}' as \"column\", "
        f"count(distinct {c}) as distinct_count from {source}"
    ),
    "q_profile_type_check": _per_table(_cast_check),
    "q_top_event_types": """
        select coalesce(event_name, collection) as event_type, count(*) as event_count
        from raw_ev group by 1 order by 2 desc, 1 nulls first limit 5""",
    "q_raw_row_counts": """
        select 'events' as table_name, count(*) as row_count from raw_ev
        union all select 'ip_locations', count(*) from raw_ip_locations
        union all select 'products', count(*) from raw_products""",
    "q_ip_match_ratio": """
        select event_count, matched_count, event_count - matched_count as unmatched_count,
          cast(matched_count as double) / event_count as match_ratio
        from (select count(*) as event_count, count(*) filter (where ip in
                (select ip from raw_ip_locations)) as matched_count from raw_ev) as totals""",
    "q_test_unique": " union all ".join(_check(x, _TWICE) for x in _UNIQUE),
    "q_test_faults": " union all by name ".join(
        f"select *, '{test}' as test from ({body})"
        for test, bodies in {
            "unique": [_check(x, _TWICE, True) for x in _UNIQUE],
            "not_null": [_check(x, "select count(*) from {t} where {c} is null", True) for x in _FILLED],
            "relationship": [_orphans(d, "bad_fact") for d in ("date", "customer", "product", "location")],
        }.items()
        for body in bodies
    ),
    "q_profile_schema": " union all ".join(
        f"select '{t}' as table_name, '{c}' as \"column\", '{declared_type(t, c)}' as type, "
        f"'{'REQUIRED' if c in REQUIRED[t] else 'NULLABLE'}' as mode, "
        f"'{'skipped (semi-structured)' if c in SEMI_STRUCTURED[t] else 'profiled'}' as profile, "
        + ("cast(null as bigint)" if c in SEMI_STRUCTURED[t] else f"(select count(*) - count({c}) from {source})")
        + " as null_count"
        for t, source in (("events", "raw_ev"), ("ip_locations", "raw_ip_locations"), ("products", "raw_products"))
        for c in RAW_SCHEMAS[t].names
    ),
    "q_test_not_null": " union all ".join(
        _check(x, "select count(*) from {t} where {c} is null") for x in _FILLED
    ),
    "q_test_relationships": " union all ".join(
        _orphans(d) for d in ("date", "customer", "product", "location")
    ),
    "q_debug_event_ids": """
        select count(*) as n_checkout_success, count(json_extract_string(_id, '$.oid')) as n_oid_plain,
          count(json_extract_string(_id, '$."$oid"')) as n_oid_dollar,
          count(json_extract_string(_id, '$."$oid"')) as n_event_id_ok
        from raw_ev where coalesce(event_name, collection) = 'checkout_success'""",
    "q_debug_line_items": """
        select count(*) as n_checkout_success, count(product_id) as n_top_level_product_id,
          count(cart_products) as n_has_cart_products,
          count(*) filter (where json_type(cart_products) = 'ARRAY') as n_cart_is_array,
          count(*) filter (where json_array_length(cart_products) > 0) as n_cart_nonempty_array
        from co""",
    "q_explore_cart": """
        select cart_products, order_id, product_id, price, currency from raw_ev
        where coalesce(event_name, collection) = 'checkout_success' and cart_products is not null
        order by order_id nulls first, cart_products, product_id nulls first, price nulls first limit 20""",
}


def _uses(text: str) -> list[str]:
    return [name for name in PARTS if re.search(rf"\b{name}\b", text)]


def _closure(text: str) -> list[str]:
    """Parts that ``text`` needs, each after the parts it needs itself."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for needed in _uses(PARTS[name]):
                if needed != name:
                    visit(needed)
            order.append(name)

    for name in _uses(text):
        visit(name)
    return order


def all_sql() -> dict[str, str]:
    statements = {}
    for key, text in FINAL.items():
        parts = ",\n".join(f"{name} as materialized (\n{PARTS[name]}\n)" for name in _closure(text))
        statements[key] = f"with {parts}\n{text}"
    return statements
