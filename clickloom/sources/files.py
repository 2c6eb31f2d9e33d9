"""Names in a shared file system: create if absent, list, rename. No data passes here."""

from __future__ import annotations

import time
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The file system that Spark itself uses for a path, by the driver's Hadoop client."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        # looked up once: every part of a Java name is a call of its own
        self._path_class = self._jvm.org.apache.hadoop.fs.Path
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._path_class(f"{self.root}/{name}".rstrip("/"))

    def create(self, name: str) -> bool:
        """Create an empty file, with its folders; False if it is there already. Atomic."""
        path = self._path(name)
        self._fs.mkdirs(path.getParent())
        try:
            if self._fs.getScheme() == "file":  # Hadoop's local client looks first, then creates
                local = self._fs.makeQualified(path).toUri().getPath()
                plain = self._jvm.java.io.File(local)
                return plain.createNewFile()
            self._fs.create(path, False).close()
            return True
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def names(self, folder: str) -> Iterator[tuple[str, float]]:
        """Name and age in seconds of what lies in a folder; nothing if there is none."""
        if not self.exists(folder):
            return
        found, now = self._fs.listStatusIterator(self._path(folder)), time.time()
        while found.hasNext():
            status = found.next()
            yield status.getPath().getName(), now - status.getModificationTime() / 1000

    def matching(self, pattern: str) -> list[str]:
        """Paths below the root that match a pattern with ``*``, by one listing."""
        found = self._fs.globStatus(self._path(pattern)) or []
        above = self._path(pattern).depth() - pattern.count("/") - 1
        return ["/".join(status.getPath().toUri().getPath().split("/")[above + 1 :]) for status in found]

    def rename(self, name: str, new: str) -> None:
        target = self._path(new)
        if "/" in new or "/" not in name:
            self._fs.mkdirs(target.getParent())
        if not self._fs.rename(self._path(name), target):
            raise OSError(f"{self.root}: {name} can't become {new}")

    def touch(self, name: str) -> None:
        self._fs.setTimes(self._path(name), int(time.time() * 1000), -1)

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
