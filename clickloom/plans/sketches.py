"""Stored sketches of a profile: one small row per ingest date and column.

Sketches merge, so a report over any dates unites stored rows and scans no events; a new
date costs a scan of that date alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.plans.profiling import scalar_columns
from clickloom.sources.versions import VersionedTable

#: 2 ** 12 buckets: about 1.6 % standard error, a few kilobytes per row.
LOG2_BUCKETS = 12


def sketch_rows(df: DataFrame, table: str) -> DataFrame:
    """``ingest_date``, ``column``, ``row_count``, ``null_count`` and the ``sketch`` of values.

    One scan and one buffer per column and date in a task, however many rows. A text is
    sketched by its bytes: the same sketch, without decoding them first.
    """
    columns = scalar_columns(table)
    aggregates = []
    for k, name in enumerate(columns):
        value = F.col(f"`{name}`")
        aggregates += [
            F.count_if(value.isNull()).alias(f"n{k}"),
            F.hll_sketch_agg(value.cast("string").cast("binary"), LOG2_BUCKETS).alias(f"s{k}"),
        ]
    wide = df.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("row_count"), *aggregates)
    entries = [
        F.struct(
            F.lit(name).alias("column"), F.col(f"n{k}").alias("null_count"), F.col(f"s{k}").alias("sketch")
        )
        for k, name in enumerate(columns)
    ]
    return wide.select("ingest_date", "row_count", F.explode(F.array(*entries)).alias("e")).select(
        "ingest_date", "row_count", "e.*"
    )


class ProfileStore:
    """The stored rows of one raw table."""

    def __init__(self, spark: SparkSession, path: str, table: str):
        self.table = table
        self._stored = VersionedTable(spark, path)

    def rows(self) -> DataFrame:
        return self._stored.read()

    def missing_dates(self, df: DataFrame) -> list[str]:
        """Dates of ``df`` that have no stored rows; a date is a partition, so few."""
        dates = df.select("ingest_date").where("ingest_date IS NOT NULL").distinct()
        if self._stored.current():
            dates = dates.join(self.rows().select("ingest_date").distinct(), "ingest_date", "left_anti")
        return sorted(r.ingest_date for r in dates.collect())

    def add(self, df: DataFrame, again: list[str] = ()) -> list[str]:
        """Sketch the dates that are missing, and those to be taken ``again``; returns them.

        Only their partitions are scanned. Rows of other dates are carried over.
        """
        dates = sorted({*self.missing_dates(df), *again})
        if dates:
            added = sketch_rows(df.where(F.col("ingest_date").isin(dates)), self.table)
            if self._stored.current():
                added = added.unionByName(self.rows().where(~F.col("ingest_date").isin(dates)))
            self._stored.publish(added.coalesce(8))
        return dates

    def report(self, first_date: str | None = None, last_date: str | None = None) -> DataFrame:
        """``column``, ``null_count``, ``approx_distinct`` over all dates or a range of them."""
        rows = self.rows()
        if first_date:
            rows = rows.where(F.col("ingest_date") >= first_date)
        if last_date:
            rows = rows.where(F.col("ingest_date") <= last_date)
        united = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
        return rows.groupBy("column").agg(
            F.sum("null_count").alias("null_count"),
            F.coalesce(united, F.lit(0)).alias("approx_distinct"),
        )
