"""Parquet tables: an append-only log, and keyed tables with upsert.

Both are ordinary Spark output in partition folders.  Where Delta Lake or Iceberg is on the
cluster, ``merge_statement`` gives the MERGE that does what ``KeyedTable.upsert`` does here with
staged partitions and Spark's dynamic partition overwrite.  One writer per table at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.upsert import merge_rows, newest_rows
from wardflow.schemas import enforce_schema
from wardflow.session import materialize, work_tables
from wardflow.sources.files import Files
from wardflow.sources.key_index import KeyIndex, Mark


class TableMissing(LookupError):
    """The table has not been written yet."""


@dataclass(frozen=True)
class MergeMetrics:
    source_rows: int
    num_target_rows_updated: int
    num_target_rows_inserted: int

    def as_dict(self) -> dict[str, int]:
        return asdict(self)


def merge_statement(
    table: str, source: str, keys: tuple[str, ...], newest: str | None = None
) -> str:
    """MERGE of a view into a Delta or Iceberg table; with ``newest`` no older row wins."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    newer = f" AND s.{newest} >= t.{newest}" if newest else ""
    return (
        f"MERGE INTO {table} t USING {source} s ON {on} "
        f"WHEN MATCHED{newer} THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


class AppendLog:
    """Append-only table.  A batch id makes an append repeatable: a replay replaces itself."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, day: str | None = None):
        self.spark, self.path, self.schema, self.day = spark, path, schema, day

    def exists(self) -> bool:
        return any(n.startswith("batch=") for n in Files(self.spark, self.path).names(self.path))

    def read(self) -> DataFrame:
        if not self.exists():
            raise TableMissing(self.path)
        return self.spark.read.schema(self._stored()).parquet(self.path).drop("batch")

    def _stored(self) -> T.StructType:
        """The schema with the columns that folder names carry."""
        layout = [T.StructField("batch", T.StringType())]
        if self.day:
            layout.append(T.StructField("_day", T.DateType()))
        return T.StructType(self.schema.fields + layout)

    def rows(self) -> DataFrame:
        return self.read().select(*self.schema.fieldNames())

    def batch(self, batch_id: str) -> DataFrame:
        """Rows of one append; reads that folder only."""
        if not self.exists():
            raise TableMissing(self.path)
        rows = self.spark.read.schema(self._stored()).parquet(self.path)
        return rows.filter(F.col("batch") == batch_id).select(*self.schema.fieldNames())

    def since(self, column: str, watermark) -> DataFrame:
        """Rows with ``column`` strictly above ``watermark``; prunes whole days by folder."""
        df = self.read()
        if self.day == column:
            df = df.filter(F.col("_day") >= F.lit(watermark).cast("date"))
        return df.filter(F.col(column) > F.lit(watermark)).select(*self.schema.fieldNames())

    def clear(self) -> None:
        """Drop all batches."""
        files = Files(self.spark, self.path)
        for name in files.names(self.path):
            if name.startswith("batch="):
                files.delete(f"{self.path}/{name}")

    def append(self, rows: DataFrame, batch_id: str | None = None) -> int:
        """Write one batch and return its row count; an empty one writes no rows.

        The count is read back from the file footers, which a retried task cannot inflate.
        """
        out = enforce_schema(rows, self.schema)
        if self.day:
            out = out.withColumn("_day", F.to_date(self.day)).hint("rebalance", "_day")
        target = f"{self.path}/batch={batch_id or uuid.uuid4().hex}"
        writer = out.write.mode("overwrite")
        (writer.partitionBy("_day") if self.day else writer).parquet(target)
        return self.spark.read.schema(self.schema).parquet(target).count()


class KeyedTable:
    """One row per key, in partition folders; an upsert reads and rewrites only those it touches.

    ``partition`` is an expression over the columns ``partition_on`` (say, the day of a
    timestamp).  Where those are part of the key, rows of arriving keys can only lie in the
    arriving partitions; elsewhere an index beside the table names the partitions of each key.
    With ``newest``, a column, an arriving row replaces only a row that is not newer, and the
    greatest value stored is kept beside the table too.

    New partitions are staged in the shared folder first and then put in place by a dynamic
    partition overwrite.  A job that dies in between leaves some partitions old and some new;
    the same upsert run again completes it.
    """

    PART = "_part"

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: tuple[str, ...],
        partition: str | None = None,
        partition_on: tuple[str, ...] = (),
        newest: str | None = None,
    ):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, list(keys)
        self.partition: Column = F.expr(partition).cast("string") if partition else F.lit("all")
        self.partition_on, self.newest = set(partition_on), newest
        # without a partition there is one folder for all keys
        self.known = bool(partition_on) or partition is None
        self._files = Files(spark, path)
        fields = [schema[k] for k in keys]
        told = partition is None or bool(partition_on) and self.partition_on <= set(keys)
        self.index = None if told else KeyIndex(spark, f"{path}_keys", fields, self.PART)
        self.mark = Mark(spark, f"{path}_mark", schema[newest]) if newest else None

    def parts(self) -> list[str]:
        """The partition values that hold rows; one folder each, so a short list."""
        prefix = f"{self.PART}="
        names = self._files.names(self.path)
        return sorted(n[len(prefix) :] for n in names if n.startswith(prefix))

    def exists(self) -> bool:
        return self._files.exists(self.path)

    def read(self, parts: list[str] | None = None) -> DataFrame:
        return self._load(parts).select(*self.schema.fieldNames())

    def _load(self, parts: list[str] | None = None) -> DataFrame:
        """Rows with their partition; ``parts`` prunes the folders."""
        if not self.exists():
            raise TableMissing(self.path)
        stored = T.StructType([*self.schema.fields, T.StructField(self.PART, T.StringType())])
        rows = self.spark.read.schema(stored).parquet(self.path)
        return rows if parts is None else rows.filter(F.col(self.PART).isin(parts))

    def rows_of(self, parts: list[str] | None = None) -> DataFrame:
        """Rows with the column ``PART``, of some partitions or all; other folders are not opened."""
        return self._load(parts)

    def stage(self, rows: DataFrame) -> DataFrame:
        """``rows`` as a work table with their partition, which ``upsert`` takes as it is."""
        return materialize(self._placed(rows))

    def newest_value(self):
        """The greatest value of ``newest`` among the rows, null for an empty table.

        It is read from the table only where no upsert has noted it yet.
        """
        if self.mark.exists():
            return self.mark.value()
        return self.read().agg(F.max(self.newest)).first()[0]

    def _placed(self, rows: DataFrame) -> DataFrame:
        return enforce_schema(rows.drop(self.PART), self.schema).withColumn(
            self.PART, self.partition
        )

    def _values(self, rows: DataFrame) -> list[str]:
        """Partition values of rows: as many as folders."""
        return [r[0] for r in rows.select(self.PART).distinct().collect()]

    def _put(self, rows: DataFrame) -> None:
        """Replace the partitions of ``rows``.

        The rebalance hint lets adaptive execution split a partition that holds most of the
        rows over several tasks, and merge tiny ones.
        """
        self._files.make(self.path)  # an empty table has a folder too
        (
            rows.hint("rebalance", self.PART)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.PART)
            .parquet(self.path)
        )

    def replace(self, rows: DataFrame) -> int:
        """Make ``rows`` the whole table; returns their number."""
        with work_tables(self.spark):
            staged = rows if self.PART in rows.columns else self.stage(rows)
            known = self.parts()
            self._note_places(staged)
            self._put(staged)
            self._drop(set(known) - set(self._values(staged)))
            if self.index is not None:
                self.index.replace(staged)
            if self.mark is not None:
                self.mark.replace(staged)
            return staged.count()

    def _note_places(self, staged: DataFrame) -> None:
        """Adds to the index, ahead of the table, where these rows will be."""
        if self.index is None:
            return
        pairs = staged.select(*self.keys, self.PART)
        if self.index.exists():
            pairs = self.index.missing(pairs)
        self.index.add(pairs)

    def _drop(self, parts: set[str]) -> None:
        for part in parts:
            self._files.delete(f"{self.path}/{self.PART}={part}")

    def _parts_of(self, values: DataFrame) -> list[str] | None:
        """Partitions in which rows with these values can lie, if the values tell."""
        if not self.known or not self.partition_on <= set(values.columns):
            return None
        return self._values(values.withColumn(self.PART, self.partition))

    def locate(self, source: DataFrame, *columns: str) -> DataFrame:
        """Key, partition and ``columns`` of the stored rows whose key arrives."""
        names = [*self.keys, self.PART, *columns, *([self.newest] if self.newest else [])]
        names = list(dict.fromkeys(names))
        if not self.exists():
            full = T.StructType([*self.schema.fields, T.StructField(self.PART, T.StringType())])
            return self.spark.createDataFrame([], full).select(*names)
        parts = self._parts_of(source.select(*self.keys))
        if self.index is not None:
            if not self.index.exists():  # a table written without one
                self.index.replace(self._load())
            parts = self.index.parts_of(source)
        rows = self._load(parts).select(*names)
        return materialize(rows.join(source.select(*self.keys), self.keys, "left_semi"))

    def upsert(
        self,
        source: DataFrame,
        prune: bool = False,
        replacing: DataFrame | None = None,
        located: DataFrame | None = None,
        unique: bool = False,
    ) -> MergeMetrics:
        """Insert new keys, replace the rows of known ones; the rest stays.

        ``replacing`` names further rows to drop, by values of some of the columns: say, the
        documents that were chunked anew.  With ``prune`` the source is the complete table
        and every key it lacks is dropped.  ``located`` is the result of ``locate`` where the
        caller has it already, and ``source`` may be that of ``stage``.  ``unique`` says that no
        key repeats in it; otherwise, without ``newest``, that is checked.
        """
        with work_tables(self.spark):
            return self._upsert(source, prune, replacing, located, unique)

    def _upsert(
        self,
        source: DataFrame,
        prune: bool,
        replacing: DataFrame | None,
        located: DataFrame | None,
        unique: bool,
    ) -> MergeMetrics:
        source = source if self.PART in source.columns else self.stage(source)
        source_rows = source.count()  # from the file footers
        if self.newest is None and not unique:
            self._refuse_repeats(source)
        if not self.exists():
            self._note_places(source)
            self._put(source)
            if self.mark is not None:
                self.mark.raise_to(source)
            return MergeMetrics(source_rows, 0, source_rows)
        if not source_rows and not prune and replacing is None:
            return MergeMetrics(0, 0, 0)
        located = self.locate(source) if located is None else located
        updated, older = self._matches(located, source)
        if prune:
            self.replace(source)
            return MergeMetrics(source_rows, updated, source_rows - updated - older)
        touched = set(self._values(source)) | set(self._values(located))
        if replacing is not None:
            parts = self._parts_of(replacing)
            if parts is None:
                dropped = self._load().join(replacing, replacing.columns, "left_semi")
                parts = self._values(dropped)
            touched |= set(parts)
        affected = self._load(sorted(touched))
        if replacing is not None:
            affected = affected.join(replacing, replacing.columns, "left_anti")
        if self.newest is None:
            merged = merge_rows(affected, source, self.keys)
        else:
            merged = newest_rows(affected, source, self.keys, self.newest)
        staged = materialize(merged)
        self._note_places(source)
        self._put(staged)
        self._drop(touched - set(self._values(staged)))
        if self.mark is not None:
            self.mark.raise_to(source)
        return MergeMetrics(source_rows, updated, source_rows - updated - older)

    def _matches(self, located: DataFrame, source: DataFrame) -> tuple[int, int]:
        """Stored rows that are replaced, and those that stay as they are newer."""
        if self.newest is None:
            return located.count(), 0
        newest = self.newest
        arriving = source.groupBy(*self.keys).agg(F.max(newest).alias("_arriving"))
        newer = F.count_if(F.col(newest) > F.col("_arriving"))
        row = located.join(arriving, self.keys).agg(F.count(F.lit(1)), newer).first()
        return row[0] - row[1], row[1]

    def _refuse_repeats(self, source: DataFrame) -> None:
        repeated = source.groupBy(*self.keys).count().filter("count > 1")
        if not repeated.isEmpty():
            raise ValueError(f"source repeats a key {self.keys}")
