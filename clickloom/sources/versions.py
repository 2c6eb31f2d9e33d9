"""Tables that are replaced without a gap.

Every publication writes a folder of its own. What makes it the table is one empty file
whose name holds the publication's number and folder: readers take the highest number.
The file appears at once or not at all, so there is always a whole table, and a
publication that fails midway leaves the one before.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clickloom.sources.files import Files
from clickloom.workspace import freed_shuffles


class VersionedTable:
    """One published table below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._files = Files(spark, self.path)

    def _published(self) -> list[tuple[int, str]]:
        """Numbers and folders of all publications that are still kept, oldest first."""
        names = [name.split("__", 1) for name, _ in self._files.names("published")]
        return sorted((int(number), folder) for number, folder in names)

    def current(self) -> str | None:
        """The folder of the table as it is now."""
        published = self._published()
        return f"{self.path}/versions/{published[-1][1]}" if published else None

    def read(self) -> DataFrame:
        """The table as it is now; a plan made from it goes on reading this version."""
        folder = self.current()
        if folder is None:
            raise FileNotFoundError(f"{self.path}: nothing is published yet")
        return self.spark.read.parquet(folder)

    def new_folder(self) -> str:
        """A folder for a version that ``point_to`` may publish."""
        return f"{self.path}/versions/{uuid.uuid4().hex[:16]}"

    def point_to(self, folder: str) -> None:
        """Make a written folder the table. Of two at the same moment one is, for all readers."""
        published = self._published()
        number = published[-1][0] + 1 if published else 1
        self._files.create(f"published/{number:08d}__{folder.rsplit('/', 1)[-1]}")

    def publish(self, df: DataFrame, *partition_by: str) -> None:
        """Replace the table. ``df`` may read the version that it replaces."""
        folder = self.new_folder()
        try:
            with freed_shuffles(self.spark):
                writer = df.write.mode("errorifexists").option("compression", "zstd")
                writer.partitionBy(*partition_by).parquet(folder)
        except Exception:
            self._files.delete(f"versions/{folder.rsplit('/', 1)[-1]}")
            raise
        self.point_to(folder)

    def vacuum(self, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` versions, once no plan reads them any more."""
        for number, folder in self._published()[:-keep]:
            self._files.delete(f"published/{number:08d}__{folder}")
            self._files.delete(f"versions/{folder}")
