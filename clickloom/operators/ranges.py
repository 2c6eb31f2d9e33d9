"""Point-in-range look-up for disjoint ranges, and nearest start at or before a point."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.joins import lookup_join
from clickloom.workspace import materialise


def locate_in_ranges(
    points: DataFrame, point: str, ranges: DataFrame, low: str, high: str, to_next: bool = False
) -> DataFrame:
    """Left look-up: each point with the columns of the range that contains it.

    The distinct points and the ranges are put on one axis and range-partitioned, so
    work follows the data and neither wide ranges nor dense address blocks make a hot
    bucket. Within a partition the nearest range start at or before a point is carried
    forward; where a partition has none yet, it comes from the partitions before
    (one row per partition). A point matches if that range has not ended. The points'
    rows then meet their distinct values in a look-up that spreads frequent ones.

    Both ends are inclusive. Ranges without an end or a start, and those that end
    before they start, hold no point. Two ranges with a point in common raise
    ``ValueError``, copies of a range included: no single answer would be right. No pair
    of point and range is ever formed beyond the one that is kept. NULL points match
    nothing. With ``to_next`` a range reaches up to the next one's start, whatever its end;
    starts must differ.
    """
    rows = materialise(points, "range-points").withColumn("_row", F.monotonically_increasing_id())
    payload = F.struct(*[F.col(f"`{c}`") for c in ranges.columns])
    starts = ranges.where(F.col(low) <= F.col(high)).select(
        F.col(low).alias("_pos"), F.lit(0).alias("_kind"), F.col(high).alias("_high"), payload.alias("_range")
    )
    values = (
        rows.select(F.col(point).alias("_pos"))
        .where("_pos IS NOT NULL")
        .distinct()
        .withColumn("_kind", F.lit(1))
    )
    axis = (
        starts.unionByName(values, allowMissingColumns=True)
        .repartitionByRange("_pos", "_kind")
        .sortWithinPartitions("_pos", "_kind")
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", 33))
    )
    written = materialise(axis, "range-axis")

    # one row per partition: the last range that starts in the partitions before it,
    # and the furthest end of all that do
    start_place = F.when(F.col("_kind") == 0, F.col("_place"))
    parts = written.groupBy("_part").agg(
        F.max_by("_range", start_place).alias("_last"), F.max("_high").alias("_end")
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = materialise(
        parts.select(
            "_part",
            F.last("_last", ignorenulls=True).over(earlier).alias("_carried"),
            F.max("_end").over(earlier).alias("_reach"),
        ),
        "range-carried",
    )
    in_order = Window.partitionBy("_part").orderBy("_place")

    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    overlapping = None if to_next else (
        written.where("_kind = 0")
        .withColumn("_so_far", F.max("_high").over(before))
        .join(F.broadcast(carried), "_part")
        .where(F.col("_pos") <= F.greatest("_so_far", "_reach"))
        .select("_pos")
        .first()
    )
    if overlapping is not None:
        raise ValueError(f"ranges overlap at {overlapping[0]!r}")

    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    nearest = (
        written.withColumn("_here", F.last("_range", ignorenulls=True).over(so_far))
        .where("_kind = 1")
        .join(F.broadcast(carried), "_part")
        .withColumn("_near", F.coalesce("_here", "_carried"))
    )
    hit = F.col("_near")
    if not to_next:
        hit = F.when(F.col("_pos") <= F.col(f"_near.{high}"), hit)
    located = nearest.where(hit.isNotNull()).select(F.col("_pos").alias(point), hit.alias("_hit"))
    return lookup_join(rows, located, [point], "left", "_row").select(
        *points.columns, *[F.col(f"_hit.{c}").alias(c) for c in ranges.columns]
    )
