"""Where the keys of a partitioned table lie, and how far it has been filled, without reading it.

``KeyIndex`` holds (key, partition) pairs in folders by the key's hash bucket.  It is written ahead of
the table and only ever added to, so it names every partition that may hold a key and sometimes one
that no longer does, which costs a read and changes nothing.  ``Mark`` holds the greatest value of a
column and is written after the table: after a crash it is too low, and what lies above it is merged
again.

Each write is a folder of its own that later ones do not touch; readers take all of them.  When there
are many they are written as one, and the old ones are deleted after that.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.session import materialize
from wardflow.sources.files import Files

# Hash buckets of the keys; a lookup opens those of its keys.
BUCKETS = 64

# Folders after which an index is written as one.
MOST_FOLDERS = 48


class Folders:
    """A table in folders ``write=<id>``, each complete or absent."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema
        self._files = Files(spark, path)

    def folders(self) -> list[str]:
        """Finished writes: Spark puts its marker last."""
        names = [n for n in self._files.names(self.path) if n.startswith("write=")]
        return [n for n in names if self._files.exists(f"{self.path}/{n}/_SUCCESS")]

    def exists(self) -> bool:
        return bool(self.folders())

    def rows(self) -> DataFrame:
        paths = [f"{self.path}/{n}" for n in self.folders()]
        rows = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths)
        return rows.select(*self.schema.fieldNames())

    def add(self, rows: DataFrame, by: str | None = None) -> str:
        name = f"write={uuid.uuid4().hex}"
        writer = rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        (writer.partitionBy(by) if by else writer).parquet(f"{self.path}/{name}")
        return name

    def keep_only(self, name: str) -> None:
        for other in self.folders():
            if other != name:
                self._files.delete(f"{self.path}/{other}")


class KeyIndex:
    """(key, part) pairs of a table whose keys do not tell their partition."""

    def __init__(self, spark: SparkSession, path: str, keys: list[T.StructField], part: str):
        self.keys, self.part = [k.name for k in keys], part
        schema = T.StructType([*keys, T.StructField(part, T.StringType()), T.StructField("_bucket", T.IntegerType())])
        self._stored = Folders(spark, path, schema)

    def exists(self) -> bool:
        return self._stored.exists()

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(BUCKETS)).cast("int"))

    def _opened(self, wanted: DataFrame) -> DataFrame:
        """The stored pairs in the buckets of bucketed keys."""
        buckets = [r[0] for r in wanted.select("_bucket").distinct().collect()]  # BUCKETS at most
        return self._stored.rows().filter(F.col("_bucket").isin(buckets))

    def _found(self, source: DataFrame) -> DataFrame:
        wanted = self._bucketed(source.select(*self.keys))
        return self._opened(wanted).join(wanted, ["_bucket", *self.keys], "left_semi")

    def find(self, source: DataFrame) -> DataFrame:
        """Pairs of the keys of ``source``; only their buckets are opened."""
        return self._found(source).select(*self.keys, self.part).distinct()

    def parts_of(self, source: DataFrame) -> list[str]:
        """The partitions that may hold keys of ``source``; keys are not shuffled to tell them apart."""
        return [r[0] for r in self._found(source).select(self.part).distinct().collect()]

    def missing(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` that are not stored yet."""
        wanted = self._bucketed(pairs.select(*self.keys, self.part))
        on = ["_bucket", *self.keys, self.part]
        return wanted.join(self._opened(wanted), on, "left_anti").select(*self.keys, self.part)

    def add(self, pairs: DataFrame) -> None:
        """Name more places.  Nothing is written where there are none."""
        pairs = materialize(self._bucketed(pairs.select(*self.keys, self.part)))
        if not pairs.isEmpty() or not self.exists():
            self._stored.add(pairs.hint("rebalance", "_bucket"), by="_bucket")
        if len(self._stored.folders()) > MOST_FOLDERS:
            self.replace(self._stored.rows().drop("_bucket").distinct())

    def replace(self, pairs: DataFrame) -> None:
        """Name these places and, once they are written, no others."""
        rows = self._bucketed(pairs.select(*self.keys, self.part)).hint("rebalance", "_bucket")
        self._stored.keep_only(self._stored.add(rows, by="_bucket"))


class Mark:
    """The greatest value of a column that a table was given."""

    def __init__(self, spark: SparkSession, path: str, column: T.StructField):
        self.column = column.name
        self._stored = Folders(spark, path, T.StructType([column]))

    def exists(self) -> bool:
        return self._stored.exists()

    def value(self):
        return self._stored.rows().agg(F.max(self.column)).first()[0]

    def raise_to(self, rows: DataFrame) -> None:
        """The greatest value of ``rows``, if it is above the mark."""
        top = rows.agg(F.max(self.column).alias(self.column))
        if self.exists():
            top = top.unionByName(self._stored.rows()).agg(F.max(self.column).alias(self.column))
        self._stored.keep_only(self._stored.add(materialize(top)))

    def replace(self, rows: DataFrame) -> None:
        self._stored.keep_only(self._stored.add(rows.agg(F.max(self.column).alias(self.column))))
