"""Listing and deleting folders on any storage Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(path)]

    def exists(self, folder: str) -> bool:
        return self._fs.exists(self._path(folder))

    def make(self, folder: str) -> None:
        self._fs.mkdirs(self._path(folder))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
