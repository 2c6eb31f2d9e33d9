"""Profiles of the raw tables: one aggregate pass per report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import non_empty
from clickloom.plans.staging import event_type
from clickloom.sources.schemas import RAW_SCHEMAS, REQUIRED, SEMI_STRUCTURED, declared_type

# Logical foreign keys between the raw tables.
KNOWN_JOINS = [
    ("events.product_id", "products.product_id"),
    ("events.ip", "ip_locations.ip"),
]


def scalar_columns(table: str) -> list[str]:
    """Columns with single values; JSON columns are not profiled."""
    return [c for c in RAW_SCHEMAS[table].names if c not in SEMI_STRUCTURED[table]]


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _long(one_row: DataFrame, key: str, value_names: list[str], entries: dict) -> DataFrame:
    """Turn the one row of an aggregate into a row per entry.

    ``entries`` maps a label to the expressions of its values over that row.
    """
    structs = [
        F.struct(F.lit(label).alias(key), *[e.alias(n) for e, n in zip(exprs, value_names)])
        for label, exprs in entries.items()
    ]
    return one_row.select(F.explode(F.array(*structs)).alias("_entry")).select("_entry.*")


def null_counts(df: DataFrame, table: str) -> DataFrame:
    columns = scalar_columns(table)
    row = df.agg(*[F.count_if(_c(c).isNull()).alias(f"n_{c}") for c in columns])
    return _long(row, "column", ["null_count"], {c: [_c(f"n_{c}")] for c in columns})


def null_distinct_row(df: DataFrame, table: str, log2_buckets: int = 12) -> DataFrame:
    """``n_<column>`` (NULLs) and ``d_<column>`` (distinct) of all scalar columns, in one row.

    A distinct sketch is one small buffer per column and merges across tasks,
    however many columns there are; 2^12 buckets give about 1.6 % error.
    """
    aggregates = []
    for c in scalar_columns(table):
        sketch = F.hll_sketch_agg(_c(c).cast("string"), log2_buckets)
        distinct = F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0))
        aggregates += [
            F.count_if(_c(c).isNull()).alias(f"n_{c}"),
            distinct.alias(f"d_{c}"),
        ]
    return df.agg(*aggregates)


def null_and_approx_distinct(df: DataFrame, table: str) -> DataFrame:
    """NULLs and estimated distinct values, a row per scalar column, from one scan."""
    entries = {c: [_c(f"n_{c}"), _c(f"d_{c}")] for c in scalar_columns(table)}
    row = null_distinct_row(df, table)
    return _long(row, "column", ["null_count", "approx_distinct"], entries)


def approx_distinct_check(df: DataFrame, table: str) -> DataFrame:
    """NULLs per column, and whether the estimate lies within four standard errors of the exact count."""
    return within_bound(null_and_approx_distinct(df, table), exact_distinct(df, table))


def within_bound(estimate: DataFrame, exact: DataFrame) -> DataFrame:
    """Estimates beside exact counts: within four standard errors?"""
    off = F.abs(F.col("approx_distinct") - F.col("distinct_count"))
    bound = F.greatest(F.lit(2.0), 4 * 0.0163 * F.col("distinct_count"))
    return estimate.join(exact, "column").select(
        "column", "null_count", (off <= bound).alias("within_bound")
    )


def exact_distinct(df: DataFrame, table: str) -> DataFrame:
    """Exact distinct values per scalar column.

    Columns become (column, value) rows and are grouped twice. Repeated values
    combine before the shuffle, and a column's values spread over all reducers,
    which a set of ``count(distinct)`` aggregates would not do better.
    """
    columns = scalar_columns(table)
    pairs = [F.struct(F.lit(c).alias("column"), _c(c).cast("string").alias("value")) for c in columns]
    values = df.select(F.explode(F.array(*pairs)).alias("_pair")).select("_pair.*").distinct()
    return values.groupBy("column").agg(F.count("value").alias("distinct_count"))


def _fails(table: str, column: str) -> Column:
    """True where a value's text does not cast to the column's declared type."""
    text = _c(column).cast("string")
    kind = declared_type(table, column)
    if kind == "boolean":
        bad = ~F.lower(text).isin("true", "false")
    else:
        bad = text.try_cast(kind).isNull()
    return text.isNotNull() & bad


def type_check(df: DataFrame, table: str) -> DataFrame:
    """Rows per column that fail the cast to the declared type, in one scan."""
    columns = scalar_columns(table)
    row = df.agg(*[F.count_if(_fails(table, c)).alias(f"bad_{c}") for c in columns])
    entries = {c: [F.lit(declared_type(table, c)), _c(f"bad_{c}")] for c in columns}
    return _long(row, "column", ["declared_type", "rows_failing_cast"], entries)


def _distinct(value: Column) -> Column:
    return F.count_distinct(value)


def _metrics(table: str) -> dict[str, Column]:
    rows = {"row_count": F.count(F.lit(1))}
    if table == "events":
        return rows | {
            "partition_dates_covered": _distinct(F.col("ingest_date")),
            "distinct_event_names": _distinct(event_type()),
            "distinct_product_ids": _distinct(F.col("product_id")),
            "distinct_device_ids": _distinct(F.col("device_id")),
            "distinct_ips": _distinct(F.col("ip")),
            "min_time_stamp": F.min("time_stamp"),
            "max_time_stamp": F.max("time_stamp"),
        }
    if table == "ip_locations":
        return rows | {
            "distinct_ip": _distinct(F.col("ip")),
            "distinct_country": _distinct(F.col("country_short")),
            "min_latitude": F.min("latitude"),
            "max_latitude": F.max("latitude"),
            "min_longitude": F.min("longitude"),
            "max_longitude": F.max("longitude"),
            "min_updated_at": F.min("updated_at"),
            "max_updated_at": F.max("updated_at"),
        }
    return rows | {
        "distinct_product_id": _distinct(F.col("product_id")),
        "rows_with_product_name": F.count_if(non_empty(F.col("product_name"))),
        "rows_with_error": F.count_if(non_empty(F.col("error"))),
        "distinct_status_codes": _distinct(F.col("status")),
        "min_updated_at": F.min("updated_at"),
        "max_updated_at": F.max("updated_at"),
    }


def kpis(df: DataFrame, table: str) -> DataFrame:
    """(metric, value) rows of a raw table; all metrics share one scan."""
    metrics = _metrics(table)
    row = df.agg(*[e.alias(name) for name, e in metrics.items()])
    return _long(row, "metric", ["value"], {m: [F.col(m).cast("string")] for m in metrics})


def schema_report(df: DataFrame, table: str) -> DataFrame:
    """Columns of the raw table with declared type, nullability and NULLs found.

    JSON columns are not profiled: they are listed as skipped, without a count.
    """
    rows = [
        (
            n,
            declared_type(table, n),
            "REQUIRED" if n in REQUIRED[table] else "NULLABLE",
            "skipped (semi-structured)" if n in SEMI_STRUCTURED[table] else "profiled",
        )
        for n in RAW_SCHEMAS[table].names
    ]
    declared = df.sparkSession.createDataFrame(rows, "column string, type string, mode string, profile string")
    return declared.join(null_counts(df, table), "column", "left")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of rows of each raw table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    whole = counts[0]
    for count in counts[1:]:
        whole = whole.unionByName(count)
    return whole


def top_event_types(events: DataFrame, n: int = 20) -> DataFrame:
    return (
        events.groupBy(event_type().alias("event_type"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("event_count"), F.asc_nulls_first("event_type"))
        .limit(n)
    )


def ip_match_ratio(events: DataFrame, ip_locations: DataFrame) -> DataFrame:
    """How many events have a known IP.

    Events are counted per IP first, so the join sees one row per address.
    """
    per_ip = events.groupBy("ip").agg(F.count(F.lit(1)).alias("n"))
    known = ip_locations.select("ip").distinct().withColumn("_known", F.lit(True))
    matched = F.sum(F.when(F.col("_known"), F.col("n")).otherwise(0))
    totals = per_ip.join(known, "ip", "left").agg(
        F.sum("n").alias("event_count"), matched.alias("matched_count")
    )
    return totals.select(
        "event_count",
        "matched_count",
        (F.col("event_count") - F.col("matched_count")).alias("unmatched_count"),
        F.try_divide(F.col("matched_count").cast("double"), F.col("event_count")).alias("match_ratio"),
    )
