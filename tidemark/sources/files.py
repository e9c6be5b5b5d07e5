"""Folder names and moves; no data is read."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """A thin view on the file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names of what lies in a folder, sorted; none if there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(path)))

    def values(self, path: str, column: str) -> list[str]:
        """Values of a partition column, by folder names."""
        return [n.split("=", 1)[1] for n in self.names(path) if n.startswith(f"{column}=")]

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
