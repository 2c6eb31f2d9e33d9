"""Where intermediate tables live.

Plans that must not be recomputed (a table read by several later steps, or an
operator whose second pass has to see exactly the rows of its first pass) are
written as Parquet below the folder the cluster names in ``spark.checkpoint.dir``.
A written table survives the loss of any executor and cuts the lineage.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_base: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder of this application below ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then gets a
    temporary folder, since driver and tasks are the same machine.
    """
    app_id = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors share"
            )
        base = _local_base.setdefault(app_id, tempfile.mkdtemp(prefix="clickloom-"))
    return f"{base.rstrip('/')}/clickloom/{app_id}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Spark's setting by which a query that ended deletes what it shuffled.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written in this block deletes its shuffle files when it ends.

    Otherwise they stay on the executors' disks until the driver's garbage collector finds
    them. A write's plan is never run again, unlike that of a collected DataFrame.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def materialise(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table.

    The columns to partition by must be the last ones. Ids and digests, which no dictionary
    shortens, take half the room by zstd.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    with freed_shuffles(spark):
        writer.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame, folder: str = "") -> None:
    """Delete the written tables that ``df`` reads, or a folder of them, once what was made of them is written.

    Only for tables that no other plan reads: those a caller wrote for itself.
    """
    spark = df.sparkSession
    below = f"/clickloom/{spark.sparkContext.applicationId}/"
    tables = {file.split(below, 1)[1].split("/", 1)[0] for file in df.inputFiles() if below in file}
    for table in tables:
        _delete(spark, f"{shared_dir(spark)}/{table}/{folder}".rstrip("/"))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete everything this application wrote below the shared folder."""
    _delete(spark, shared_dir(spark))
