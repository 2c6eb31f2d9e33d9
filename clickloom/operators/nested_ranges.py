"""Point-in-range look-up for ranges that lie within each other or overlap."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.joins import lookup_join
from clickloom.operators.keys import with_dense_key
from clickloom.workspace import materialise

_START, _POINT, _END = 0, 1, 2


def locate_innermost(points: DataFrame, point: str, ranges: DataFrame, low: str, high: str) -> DataFrame:
    """Left look-up: each point with the columns of the innermost range that contains it.

    Of the ranges around a point the one that starts last counts, of several the
    shortest, of several of those the last in the order of their other columns; so with
    blocks within blocks it is the innermost, and crossing ranges have a defined answer
    too. Ranges are numbered in this order, and the greatest number around a point wins.

    Starts, distinct points and ends lie on one range-partitioned axis. The winner is the
    greatest of three: of the ranges that start in the point's own partition, by a stack of
    those still open; of those that start before the partition and end in it, by the
    greatest number over the ends that follow; of those that reach over the whole
    partition, by one number per partition. So nothing is carried from partition to
    partition but one row each, however deep the nesting is, and a task holds no more than
    the open ranges that start in its own partition.

    Both ends are inclusive. Ranges without an end or a start, and those that end before
    they start, hold no point. NULL points match nothing. Range columns must be orderable.
    """
    rest = [c for c in ranges.columns if c not in (low, high)]
    order = [F.col(f"`{low}`").asc(), F.col(f"`{high}`").desc(), *[F.col(f"`{c}`").asc_nulls_first() for c in rest]]
    spans = ranges.where(F.col(low) <= F.col(high)).distinct()
    numbered = materialise(with_dense_key(spans, "_rank", order, name="ranges"), "ranges-numbered")
    rows = materialise(points, "range-points").withColumn("_row", F.monotonically_increasing_id())

    values = rows.select(F.col(point).alias("_pos")).where("_pos IS NOT NULL").distinct()
    axis = (
        values.withColumn("_kind", F.lit(_POINT))
        .unionByName(_edges(numbered, low, _START), allowMissingColumns=True)
        .unionByName(_edges(numbered, high, _END), allowMissingColumns=True)
        .repartitionByRange("_pos", "_kind", "_rank")
        .sortWithinPartitions("_pos", "_kind", "_rank")
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", 33))
    )
    written = materialise(axis, "range-axis")
    parts = F.broadcast(materialise(_by_part(written), "range-parts"))

    backwards = Window.partitionBy("_part").orderBy(F.desc("_place")).rowsBetween(Window.unboundedPreceding, 0)
    from_before = F.when((F.col("_kind") == _END) & (F.col("_rank") <= F.col("_before")), F.col("_rank"))
    entries = (
        written.join(parts, "_part")
        .withColumn("_ending", F.max(from_before).over(backwards))
        .select("_pos", "_kind", "_rank", "_part", "_place", "_ending", "_over")
        .sortWithinPartitions("_part", "_place")
    )
    schema = entries.select("_pos", "_ending", "_over", F.col("_rank").alias("_own")).schema
    winners = entries.mapInArrow(_innermost_open, schema).select(
        F.col("_pos").alias(point), F.greatest("_own", "_ending", "_over").alias("_rank")
    )
    held = materialise(winners.where("_rank IS NOT NULL"), "range-winners")
    payload = numbered.select("_rank", F.struct(*[F.col(f"`{c}`") for c in ranges.columns]).alias("_hit"))
    located = lookup_join(held, payload, ["_rank"]).select(point, "_hit")
    return lookup_join(rows, located, [point], "left", "_row").select(
        *points.columns, *[F.col(f"_hit.`{c}`").alias(c) for c in ranges.columns]
    )


def _edges(numbered: DataFrame, column: str, kind: int) -> DataFrame:
    return numbered.select(F.col(f"`{column}`").alias("_pos"), F.lit(kind).alias("_kind"), "_rank")


def _by_part(written: DataFrame) -> DataFrame:
    """Per partition: the last range that starts before it, and the winner of those that reach over it.

    Ranges are reduced to one per pair of partitions they start and end in, so what is
    spread over the partitions between grows with the partitions, not with the ranges.
    """
    part_of = {k: F.max(F.when(F.col("_kind") == k, F.col("_part"))) for k in (_START, _END)}
    reaching = (
        written.where(F.col("_kind") != _POINT)
        .groupBy("_rank")
        .agg(part_of[_START].alias("first"), part_of[_END].alias("last"))
        .where("last - first > 1")
        .groupBy("first", "last")
        .agg(F.max("_rank").alias("_rank"))
    )
    over = (
        reaching.select(F.explode(F.sequence(F.col("first") + 1, F.col("last") - 1)).alias("_part"), "_rank")
        .groupBy("_part")
        .agg(F.max("_rank").alias("_over"))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    started = written.groupBy("_part").agg(F.max(F.when(F.col("_kind") == _START, F.col("_rank"))).alias("_last"))
    return started.select(
        "_part", F.coalesce(F.max("_last").over(earlier), F.lit(0)).alias("_before")
    ).join(over, "_part", "left")


def _innermost_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Points, in axis order, with the last range opened in their partition and not closed yet."""
    part, opened, closed = None, [], set()
    for batch in batches:
        own = []
        kinds, ranks, parts = (batch.column(c).to_pylist() for c in ("_kind", "_rank", "_part"))
        for kind, rank, here in zip(kinds, ranks, parts):
            if here != part:
                part, opened, closed = here, [], set()
            if kind == _START:
                opened.append(rank)
            elif kind == _POINT:
                own.append(opened[-1] if opened else None)
            elif opened and rank >= opened[0]:  # numbers ascend: a smaller one began before the partition
                closed.add(rank)
                while opened and opened[-1] in closed:
                    closed.remove(opened.pop())
        points = batch.filter(pa.array([k == _POINT for k in kinds], pa.bool_()))
        columns = [points.column(c) for c in ("_pos", "_ending", "_over")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(own, pa.int64())], ["_pos", "_ending", "_over", "_own"])
