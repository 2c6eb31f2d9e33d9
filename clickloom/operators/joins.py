"""Look-up joins that stay balanced when a few keys hold much of the fact side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more rows than this is too much for one task; at most 1 / HOT_SHARE keys are salted.
HOT_ROWS = 1_000_000
HOT_SHARE = 0.00001
SALTS = 64


def hot_keys(
    df: DataFrame, keys: list[str], share: float | None = None, min_rows: int | None = None
) -> DataFrame | None:
    """The keys with more than ``min_rows`` rows, or None.

    The limit is what one task can take, whatever the table's size. Of more than
    ``1 / share`` such keys the most frequent are kept: each key with more than
    ``share`` of all rows is among them, and the list fits the driver and a broadcast.
    The others are joined all the same, but unsalted. The defaults are ``HOT_SHARE``
    and ``HOT_ROWS``.
    """
    share = HOT_SHARE if share is None else share
    min_rows = HOT_ROWS if min_rows is None else min_rows
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    most = counted.where(F.col("_n") > min_rows).orderBy(F.desc("_n")).limit(round(1 / share))
    rows = most.select(*keys).collect()
    if not rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.select(*keys).schema)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    row_id: str | None = None,
    share: float | None = None,
    min_rows: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Equi join of a large ``left`` with a ``right`` that has few rows per key.

    Without hot keys this is a plain join: Spark broadcasts ``right`` if its
    measured size is below the threshold and shuffles both sides otherwise. With
    hot keys only those are salted: their left rows are spread over ``salts``
    reducers by ``row_id`` and only their right rows are repeated. ``left`` should
    be a written table, as its keys are counted first. ``row_id`` must be a
    deterministic per-row number; without it the hash of the row is used.
    """
    hot = hot_keys(left, keys, share, min_rows)
    if hot is None:
        return left.join(right, keys, how)
    marks = F.broadcast(hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot")))

    def marked(side: DataFrame) -> DataFrame:
        on = F.lit(True)
        for k in keys:
            on = on & side[k].eqNullSafe(marks[f"_hot_{k}"])
        return side.join(marks, on, "left").drop(*[f"_hot_{k}" for k in keys])

    number = F.col(row_id) if row_id else F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    salted_left = marked(left).withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(number, F.lit(salts))).otherwise(0).cast("int")
    )
    all_salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_right = marked(right).withColumn("_salt", F.explode(all_salts)).drop("_hot")
    joined = salted_left.drop("_hot").join(salted_right, [*keys, "_salt"], how)
    return joined.drop("_salt")


def spread_nulls(key: Column, row_id: Column) -> Column:
    """Text key in which each NULL becomes a value of its own that matches nothing.

    In an outer join all NULL keys would otherwise meet in one reducer.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), row_id.cast("string")))
