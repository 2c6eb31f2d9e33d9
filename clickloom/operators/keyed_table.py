"""Keyed tables whose upserts rewrite only the files that they touch.

Files hold disjoint ranges of the key; a manifest, itself a versioned table, has one row
per file with its first and last key. A batch finds the files that its keys belong to,
merges with those alone, and publishes a manifest of the new files and the untouched ones.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.operators.latest import latest_per_key
from clickloom.operators.ranges import locate_in_ranges
from clickloom.operators.snapshots import upsert
from clickloom.sources.versions import VersionedTable
from clickloom.workspace import materialise

ROWS_PER_FILE = 1_000_000


@dataclass(frozen=True)
class Merge:
    """What an upsert did: files read again, files written, files left as they are."""

    rewritten: int
    written: int
    kept: int


class KeyedTable:
    """A table below ``path`` in files by ranges of the column ``key``.

    Rows without a key are kept in a file of their own; they match nothing, as in ``upsert``.
    The driver holds one name per file that a read or a merge takes part in, as Spark does.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.rows_per_file = rows_per_file
        self._manifest = VersionedTable(spark, f"{self.path}/manifest")

    def files(self) -> DataFrame:
        """One row per file: ``file``, ``low``, ``high``, ``rows``."""
        return self._manifest.read()

    def read(self) -> DataFrame:
        """The table as it is now."""
        return self._read(self.files())

    def _read(self, files: DataFrame) -> DataFrame:
        names = [row.file for row in files.select("file").toLocalIterator()]
        if names:
            return self.spark.read.parquet(*names)
        first = self.files().select("file").first()  # of the same columns
        return self.spark.read.parquet(first.file).limit(0)

    def replace(self, rows: DataFrame) -> None:
        """Write the whole table; keys must be unique (see ``upsert`` for batches)."""
        # the owner is written, too: as a constant it would be left out of the ranges
        source = materialise(rows.withColumn("_owner", F.lit(0).cast("long")), "keyed-table")
        self._manifest.publish(self._written(source))

    def _written(self, rows: DataFrame) -> DataFrame:
        """Write rows with the number of the file they go for, and describe the files made.

        Rows lie in ranges of owner and key and a file never mixes owners, so new files
        lie where their owner lay. A task writes as many files as its rows make, the rows
        of a key all into one.
        """
        folder = f"{self.path}/data/{uuid.uuid4().hex[:16]}"
        count = max(1, -(-rows.count() // self.rows_per_file))
        tasks = min(count, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        file = F.min("_nth").over(Window.partitionBy("_owner", self.key))
        (
            rows.repartitionByRange(tasks, "_owner", self.key)
            .sortWithinPartitions("_owner", self.key)
            .withColumn("_nth", within)
            .withColumn("_file", F.floor(file / self.rows_per_file))
            .drop("_nth")
            .sortWithinPartitions("_owner", "_file", self.key)
            .write.partitionBy("_owner", "_file")
            .parquet(folder)
        )
        if not rows.columns or rows.isEmpty():  # a table without rows keeps its columns
            rows.drop("_owner").limit(0).coalesce(1).write.mode("overwrite").parquet(folder)
            name = self.spark.read.parquet(folder).inputFiles()[0]
            return self.spark.createDataFrame([(name,)], "file string").select(
                "file",
                F.lit(None).cast(rows.schema[self.key].dataType).alias("low"),
                F.lit(None).cast(rows.schema[self.key].dataType).alias("high"),
                F.lit(0).cast("long").alias("rows"),
            )
        written = self.spark.read.schema(rows.drop("_owner").schema).parquet(folder)
        return written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.min(self.key).alias("low"),
            F.max(self.key).alias("high"),
            F.count(F.lit(1)).alias("rows"),
        )

    def upsert(self, batch: DataFrame, newest_first: list[Column]) -> Merge:
        """Put a batch in place of the rows with its keys; of several for a key the newest.

        A key belongs to the file with the greatest first key up to it (before all files:
        to the first one), so the ranges stay disjoint whatever is inserted.
        """
        fresh = materialise(latest_per_key(batch, [self.key], newest_first), "fresh")
        files = materialise(self.files().withColumn("_owner", F.xxhash64("file")), "files")
        ranged = files.where("low IS NOT NULL").select(F.col("low").alias("_low"), F.col("_owner").alias("_file"))
        first = ranged.agg(F.min_by("_file", "_low")).first()[0]
        located = locate_in_ranges(fresh, self.key, ranged, "_low", "_low", to_next=True)
        owner = F.coalesce(F.when(F.col(self.key).isNotNull(), F.coalesce("_file", F.lit(first))), F.lit(0))
        placed = materialise(located.withColumn("_owner", owner.cast("long")).drop("_low", "_file"), "placed")
        touched = placed.select("_owner").distinct()
        hit = materialise(files.join(touched, "_owner", "left_semi"), "files-hit")
        names = F.broadcast(hit.select(F.col("file").alias("_name"), "_owner"))
        old = self._read(hit).withColumn("_name", F.col("_metadata.file_path"))
        # every old row goes for its own file again; the hit list is as long as what is read
        merged = upsert(old.join(names, "_name").drop("_name"), placed, [self.key], newest_first)
        written = materialise(self._written(materialise(merged, "merged")), "files-written")
        kept = files.join(touched, "_owner", "left_anti").drop("_owner").where("rows > 0")
        self._manifest.publish(kept.unionByName(written))
        return Merge(hit.count(), written.count(), kept.count())
