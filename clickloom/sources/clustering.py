"""Tables laid out by several keys at once, and what a filter skips of them.

Files sorted by (a, b, c) skip nothing for a filter on c alone. Here rows follow a
space-filling order: the keys' ranks with their bits interleaved, so that each key
narrows every file by about the same number of bits.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.keys import with_dense_key
from clickloom.workspace import freed_shuffles

#: Bits of a key's rank; a table has at most ``2 ** RANK_BITS - 1`` bounds per key on the driver.
RANK_BITS = 8


def rank_bounds(df: DataFrame, column: str) -> list[Any]:
    """Values that cut the column's distinct values into even runs, in order.

    Exact and computed in Spark over all rows; only the bounds, at most 255, are collected.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    numbered = with_dense_key(values, "_rank", [F.asc(column)], name=f"values-{column}")
    most = numbered.agg(F.max("_rank")).first()[0] or 0
    run = -(-most // (2**RANK_BITS - 1)) or 1
    return [r[0] for r in numbered.where(F.col("_rank") % run == 1 % run).orderBy("_rank").select(column).collect()]


def coarse_rank(column: str, bounds: list[Any]) -> Column:
    """How many bounds a value reaches, spread over the whole range of ``RANK_BITS``; NULL is 0."""
    if not bounds:
        return F.lit(0)
    listed, n = F.array(*[F.lit(b) for b in bounds]), len(bounds)
    steps = F.array(*[F.lit(2**k) for k in reversed(range(RANK_BITS))])
    reached = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= n) & (F.element_at(listed, F.least(at + step, F.lit(n))) <= F.col(column)), at + step
        ).otherwise(at),
    )
    return (reached * (2**RANK_BITS - 1) / n).cast("int")


def interleaved(ranks: list[str]) -> Column:
    """The bits of the ranks in turns, highest first, as one number."""
    bits = [
        F.shiftleft(F.shiftright(F.col(rank), bit).bitwiseAND(1).cast("bigint"), bit * len(ranks) + len(ranks) - 1 - k)
        for k, rank in enumerate(ranks)
        for bit in range(RANK_BITS)
    ]
    return reduce(Column.__add__, bits)


def recluster_interleaved(
    df: DataFrame, keys: list[str], path: str, files: int | None = None, partition_by: str = "ingest_date"
) -> None:
    """Rewrite a stored table so that a filter on any one of up to seven keys skips most files.

    The row number at the end of the order lets rows that agree on all keys fall into
    several files, so no value makes a large one. ``df`` must be a scan, or a narrow plan
    over one, so that a repeated task numbers its rows alike. ``files``: how many ranges to
    cut the order into (default: as Spark sees fit).
    """
    if not 0 < len(keys) * RANK_BITS < 63:
        raise ValueError("one to seven keys")
    ranks = {f"_rank_{k}": coarse_rank(key, rank_bounds(df, key)) for k, key in enumerate(keys)}
    placed = (
        df.withColumn("_row", F.monotonically_increasing_id())
        .withColumns(ranks)
        .withColumn("_cell", interleaved(list(ranks)))
        .drop(*ranks)
    )
    order = [partition_by, "_cell", *keys, "_row"]
    ranged = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    writer = (
        ranged.sortWithinPartitions(*order)
        .drop("_cell", "_row")
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .partitionBy(partition_by)
    )
    with freed_shuffles(df.sparkSession):
        writer.parquet(path)


def skipped_files(stored: DataFrame, filters: list[tuple[str, Any]]) -> DataFrame:
    """For each filter ``column = value`` on a stored table: what the files' statistics leave to read.

    ``column_name``, ``value``, ``rows``: how many match; ``files``: of the table;
    ``files_read``: those whose smallest and largest value admit a match. One scan of the
    filters' columns, one row per file, whatever the number of filters.
    """
    per_file, total, rows = [], [F.count(F.lit(1)).alias("files")], []
    for k, (column, value) in enumerate(filters):
        here = F.col(column)
        per_file += [
            F.count_if(here == value).alias(f"rows{k}"),
            ((F.min(here) <= value) & (F.max(here) >= value)).alias(f"hit{k}"),
        ]
        total += [F.sum(f"rows{k}").alias(f"rows{k}"), F.count_if(f"hit{k}").alias(f"read{k}")]
        rows.append(
            F.struct(
                F.lit(column).alias("column_name"),
                F.lit(str(value)).alias("value"),
                F.coalesce(f"rows{k}", F.lit(0)).alias("rows"),
                "files",
                F.col(f"read{k}").alias("files_read"),
            )
        )
    by_file = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(*per_file)
    return by_file.agg(*total).select(F.inline(F.array(*rows)))
