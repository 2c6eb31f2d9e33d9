"""Dense, ordered surrogate keys without a single-partition window."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from clickloom.workspace import materialise

_ID_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits
_PIECE_BITS = 20  # partitions of one piece of a table that is put in order piece by piece


def with_dense_key(
    df: DataFrame,
    key: str,
    order_by: list[Column],
    spread: Column | None = None,
    name: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Number all rows 1..n in ``order_by`` order, as ``row_number() over (order by ...)``.

    1. range-partition and sort by the order, so partition i precedes partition i+1;
    2. record partition and position of each row and write the table, so that
       every later pass sees the same bounds even after an executor is lost;
    3. count rows per partition (one row per partition), turn the counts into
       offsets, and add them.

    The only single-partition step sees one row per partition. ``order_by`` should
    be unique but for full copies of a row; ``spread`` may add a deterministic
    per-row value that lets such copies fall into different partitions. ``keep`` names the
    columns that are wanted beside the key: the others only order the rows and aren't written.
    """
    columns = keep or df.columns
    written = materialise(in_order(df, order_by, spread, columns), name or key)
    return numbered(written, key, columns)


def in_order(
    df: DataFrame, order_by: list[Column], spread: Column | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Rows in order, each with its partition ``_part`` and its ``_place``, which ascends over all.

    To be written before it is read: the bounds of another run may differ.
    """
    bounds = [*order_by, spread] if spread is not None else list(order_by)
    return placed(df.repartitionByRange(*bounds), order_by, keep or df.columns)


def placed(ranged: DataFrame, order_by: list[Column], keep: list[str]) -> DataFrame:
    """``in_order`` of rows that are range-partitioned by the order already."""
    return (
        ranged.sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id())
        .select(*keep, "_place", F.shiftright("_place", _ID_BITS).alias("_part"))
    )


def offsets(written: DataFrame) -> DataFrame:
    """How many rows of a written ``in_order`` each partition has, and those before it."""
    by_part = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        written.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", "_rows", F.coalesce(F.sum("_rows").over(by_part), F.lit(0)).alias("_before"))
    )


def numbered(
    written: DataFrame, key: str, columns: list[str], parts: DataFrame | None = None
) -> DataFrame:
    """A written ``in_order`` with its rows' numbers from 1, by its ``offsets``."""
    parts = offsets(written) if parts is None else parts
    within = F.col("_place") - F.shiftleft("_part", _ID_BITS)
    joined = written.join(F.broadcast(parts.select("_part", "_before")), "_part")
    return joined.withColumn(key, within + F.col("_before") + 1).select(key, *columns)


def place_of(number: int, counted: list[Row]) -> int:
    """The ``_place`` of the row with this number, by the ``offsets`` in order."""
    part = counted[bisect_right(counted, number - 1, key=lambda r: r._before) - 1]
    return (part._part << _ID_BITS) + number - 1 - part._before


def piece_places(piece: int) -> list[Column]:
    """``_place`` and ``_part`` of an ``in_order`` piece that follows the pieces before it."""
    part = F.col("_part") + F.lit(piece << _PIECE_BITS)
    return [(F.col("_place") + F.lit(piece << (_ID_BITS + _PIECE_BITS))).alias("_place"), part.alias("_part")]


def part_of(place: int) -> int:
    """The ``_part`` in which a ``_place`` lies."""
    return place >> _ID_BITS
