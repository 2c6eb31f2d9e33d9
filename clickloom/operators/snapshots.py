"""Keyed upsert for plain Parquet: old and new merge into a new snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.latest import latest_per_key


def upsert(old: DataFrame, new: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """``old`` with the rows of ``new`` put in place of those with the same key.

    Of several new rows for a key the last write wins. Write the result to a new
    path; a table must not be overwritten while the plan reads it.
    """
    fresh = latest_per_key(new, keys, newest_first)
    kept = old.join(fresh.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


