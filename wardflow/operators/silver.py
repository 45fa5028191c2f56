"""Silver: one current row per reading."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.functions.times import hour_floor, instant
from wardflow.schemas import BRONZE, SILVER
from wardflow.sources.tables import AppendLog, KeyedTable, MergeMetrics

KEYS = ("reading_id",)


def latest_per_key(rows: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """The first row of each key in the given order, which must be total within a key.

    ``row_number() = 1`` is planned as a group limit on both sides of the shuffle: each task
    sends at most one row per key, so a key with a third of all rows costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    ranked = rows.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest_readings(bronze: DataFrame) -> DataFrame:
    """Latest version of each reading by ingestion time; ties go to the later Kafka position."""
    order = [F.col(c).desc() for c in ("ingested_at", "kafka_partition", "kafka_offset")]
    return latest_per_key(bronze, list(KEYS), order)


def shape_silver(bronze: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Bronze rows as Silver rows: deduplicated, with the hour bucket and the run's stamp."""
    return (
        latest_readings(bronze)
        .withColumns({"recorded_hour": hour_floor(F.col("recorded_at")), "updated_at": instant(as_of)})
        .select(*SILVER.fieldNames())
    )


def newest_ingested(rows: DataFrame) -> datetime | None:
    return rows.agg(F.max("ingested_at")).first()[0]


def watermark(silver: KeyedTable) -> datetime | None:
    """Newest ingestion time already merged, as noted beside the table."""
    return silver.newest_value() if silver.exists() else None


def newer_than(bronze: DataFrame, mark: datetime | None) -> DataFrame:
    """Rows ingested strictly after ``mark``; all of them when there is none.

    ``mark`` is a literal, so the parquet reader can skip row groups by it.
    """
    return bronze if mark is None else bronze.filter(F.col("ingested_at") > F.lit(mark))


def after_offsets(bronze: DataFrame, seen: dict[int, int]) -> DataFrame:
    """Rows beyond the last merged offset of their partition (late arrivals included).

    ``seen`` has one entry per topic partition.
    """
    if not seen:
        return bronze
    entries = [F.lit(x) for pair in seen.items() for x in pair]
    last = F.try_element_at(F.create_map(*entries), F.col("kafka_partition"))
    return bronze.filter(last.isNull() | (F.col("kafka_offset") > last))


def last_offsets(bronze: DataFrame) -> dict[int, int]:
    """Highest offset per topic partition."""
    rows = bronze.groupBy("kafka_partition").agg(F.max("kafka_offset").alias("last")).collect()
    return {r["kafka_partition"]: r["last"] for r in rows}


def bronze_table(spark, settings) -> AppendLog:
    return AppendLog(spark, settings.bronze_path, BRONZE, day="ingested_at")


def silver_table(spark, settings) -> KeyedTable:
    return KeyedTable(
        spark,
        settings.silver_path,
        SILVER,
        KEYS,
        partition="to_date(recorded_at)",
        partition_on=("recorded_at",),
        newest="ingested_at",
    )


def build_silver(
    bronze: AppendLog,
    silver: KeyedTable,
    *,
    mode: str = "incremental",
    seen_offsets: dict[int, int] | None = None,
    as_of: datetime | str | None = None,
) -> MergeMetrics:
    """Bring Silver up to date with Bronze.

    ``incremental`` merges rows ingested after the newest merged one; a row that lands later
    with an equal or older stamp is missed.  ``offsets`` merges everything beyond
    ``seen_offsets`` and misses nothing; a row older than the stored one
    does not replace it.  ``remerge`` merges all of Bronze and keeps Silver
    rows Bronze lacks; ``rebuild`` replaces the table.
    """
    if mode not in ("incremental", "offsets", "remerge", "rebuild"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "rebuild":
        rows = silver.replace(shape_silver(bronze.rows(), as_of))
        return MergeMetrics(rows, 0, rows)
    mark = watermark(silver) if mode == "incremental" else None
    if mark is not None:
        source = bronze.since("ingested_at", mark)
    elif mode == "offsets":
        source = after_offsets(bronze.rows(), seen_offsets or {})
    else:
        source = bronze.rows()
    return silver.upsert(shape_silver(source, as_of))


def table_profile(bronze: DataFrame) -> DataFrame:
    """One row: rows, distinct patients, extremes of heart rate and SpO2."""
    return bronze.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("patient_id").alias("distinct_patients"),
        F.min("heart_rate").alias("min_heart_rate"),
        F.max("heart_rate").alias("max_heart_rate"),
        F.min("spo2").alias("min_spo2"),
        F.max("spo2").alias("max_spo2"),
    )
