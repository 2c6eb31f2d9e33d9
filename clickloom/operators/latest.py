"""One row per key: the latest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """First row of each key group in ``newest_first`` order.

    Spark keeps one row per key and task before the shuffle (window group limit),
    so a key that holds most of the table still sends few rows to its reducer.
    Columns not named in the order break ties, which makes the choice repeatable.
    """
    ties = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*newest_first, *ties)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
