"""Gold: NEWS2 per patient and hour."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.functions import news2
from wardflow.functions.times import instant
from wardflow.schemas import GOLD
from wardflow.session import materialize
from wardflow.sources.tables import KeyedTable

KEYS = ("patient_id", "window_start")


def score_readings(readings: DataFrame) -> DataFrame:
    """Adds the seven parameter scores, total, highest parameter score and risk band."""
    parts = {f"score_{name}": column for name, column in news2.subscores().items()}
    names = [F.col(name) for name in parts]
    total = names[0]
    for name in names[1:]:
        total = total + name
    return (
        readings.withColumns(parts)
        .withColumns({"news2_total": total, "max_parameter_score": F.greatest(*names)})
        .withColumn(
            "risk_band", news2.risk_band(F.col("news2_total"), F.col("max_parameter_score"))
        )
    )


def _measures() -> list[Column]:
    """Every measure is algebraic, so tasks combine locally and a busy patient is no hot spot.

    ``bround`` rounds half to even, as IEEE and Python do.
    """
    total, highest = F.col("news2_total"), F.col("max_parameter_score")
    return [
        F.count(F.lit(1)).cast("int").alias("readings_in_window"),
        F.bround(F.avg(total), 3).alias("mean_news2"),
        F.max(total).alias("max_news2"),
        F.max(highest).alias("max_single_parameter_score"),
        news2.risk_band(F.max(total), F.max(highest)).alias("worst_risk_band"),
        F.bround(F.avg(F.col("on_supplemental_o2").cast("int")), 3).alias("pct_readings_on_oxygen"),
        F.bround(F.avg("heart_rate"), 2).alias("mean_heart_rate"),
        F.min("spo2").alias("min_spo2"),
        F.max("resp_rate").alias("max_resp_rate"),
        F.min("systolic_bp").alias("min_systolic_bp"),
        F.bround(F.max("temperature_c"), 2).alias("max_temperature_c"),
        F.min("recorded_at").alias("first_reading_at"),
        F.max("recorded_at").alias("last_reading_at"),
    ]


def _scored(readings: DataFrame) -> DataFrame:
    return readings.withColumns(
        {"news2_total": news2.total_score(), "max_parameter_score": news2.max_parameter_score()}
    )


def aggregate_gold(silver: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Silver reduced to one row per patient and hour."""
    return (
        _scored(silver)
        .groupBy("patient_id", F.col("recorded_hour").alias("window_start"))
        .agg(*_measures())
        .withColumn("computed_at", instant(as_of))
        .select(*GOLD.fieldNames())
    )


def windowed_gold(readings: DataFrame, lateness: str | None = None) -> DataFrame:
    """The same aggregate over tumbling one-hour event-time windows, batch or streaming.

    ``lateness`` sets an event-time watermark: a stream then emits an hour once and drops
    its state, and ignores readings that come later than that.
    """
    if lateness:
        readings = readings.withWatermark("recorded_at", lateness)
    hours = F.window("recorded_at", "1 hour")
    return (
        _scored(readings)
        .groupBy("patient_id", hours.alias("hours"))
        .agg(*_measures())
        .withColumn("window_start", F.col("hours.start"))
        .select(*[c for c in GOLD.fieldNames() if c != "computed_at"])
    )


def gold_table(spark, settings) -> KeyedTable:
    return KeyedTable(
        spark,
        settings.gold_path,
        GOLD,
        KEYS,
        partition="to_date(window_start)",
        partition_on=("window_start",),
    )


def build_gold(
    silver: KeyedTable,
    gold: KeyedTable,
    *,
    touched: DataFrame | None = None,
    prune: bool = False,
    as_of: datetime | str | None = None,
) -> dict[str, int]:
    """Recompute hour buckets from Silver and upsert them.

    ``touched`` (patient_id, recorded_hour) limits the work to those buckets; by default all
    are recomputed.  ``prune`` also removes those of them that hold no reading any more.
    """
    if touched is None:
        readings = silver.read()
    else:
        # an hour lies in one day: only those folders are read
        days = touched.select(F.to_date("recorded_hour").cast("string").alias("day")).distinct()
        readings = silver.read([r["day"] for r in days.collect()]).join(
            touched, ["patient_id", "recorded_hour"], "left_semi"
        )
    rows = gold.stage(aggregate_gold(readings, as_of))
    silver_rows = rows.agg(F.coalesce(F.sum("readings_in_window"), F.lit(0))).first()[0]
    if not silver_rows and not prune:
        return {"gold_rows": 0, "silver_rows": 0}
    if touched is None:
        metrics = gold.upsert(rows, prune=prune, unique=True)
    else:
        buckets = touched.withColumnRenamed("recorded_hour", "window_start")
        metrics = gold.upsert(rows, replacing=buckets if prune else None, unique=True)
    return {
        "gold_rows": metrics.source_rows,
        "silver_rows": silver_rows,
        "num_target_rows_updated": metrics.num_target_rows_updated,
        "num_target_rows_inserted": metrics.num_target_rows_inserted,
    }


def touched_buckets(source: DataFrame, located: DataFrame) -> DataFrame:
    """Buckets a merge of ``source`` changes: where its readings are now, and where they were.

    ``located`` holds the stored rows of the same readings, which a correction may move to
    another hour.
    """
    bucket = ["patient_id", "recorded_hour"]
    return source.select(*bucket).union(located.select(*bucket)).distinct()


def worst_windows(gold: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` worst rows: highest, then mean score; ties by patient and hour."""
    return gold.orderBy(
        F.desc("max_news2"), F.desc("mean_news2"), "patient_id", "window_start"
    ).limit(n)


def worst_window_per_patient(gold: DataFrame) -> DataFrame:
    """Each patient's worst row; combines before the shuffle."""
    row = F.struct(*[c for c in gold.columns if c != "patient_id"])
    badness = F.struct(
        "max_news2", "mean_news2", (-F.unix_micros(F.col("window_start"))).alias("earlier")
    )
    return (
        gold.groupBy("patient_id")
        .agg(F.max_by(row, badness).alias("worst"))
        .select("patient_id", "worst.*")
        .select(*gold.columns)
    )


def find_windows(
    gold: DataFrame, patient_id: str | None = None, window_start: datetime | str | None = None
) -> DataFrame:
    """Gold rows of a patient, of an hour, or of both; raises where there is none."""
    if patient_id:
        gold = gold.filter(F.col("patient_id") == patient_id)
    if window_start is not None:
        gold = gold.filter(F.col("window_start") == instant(window_start))
    if gold.isEmpty():
        raise LookupError("no matching Gold row")
    return gold


def band_histogram(gold: DataFrame) -> DataFrame:
    return gold.groupBy("worst_risk_band").agg(F.count(F.lit(1)).alias("windows"))


def reduction(gold: DataFrame) -> DataFrame:
    """One row: Silver rows, Gold rows and their ratio (every reading is in one window)."""
    readings = F.sum("readings_in_window")
    windows = F.count(F.lit(1))
    return gold.agg(
        readings.alias("silver_rows"),
        windows.alias("gold_rows"),
        F.bround(readings / windows, 1).alias("reduction_ratio"),
    )


def trend(gold: DataFrame) -> DataFrame:
    """Each patient's windows in order, with the mean score of the one before.

    A patient has at most one row an hour, so some 9,000 a year are ordered together.
    """
    before = F.lag("mean_news2").over(Window.partitionBy("patient_id").orderBy("window_start"))
    return gold.select(
        "patient_id",
        "window_start",
        "mean_news2",
        "max_news2",
        before.alias("previous_mean_news2"),
    ).withColumn("change", F.bround(F.col("mean_news2") - F.col("previous_mean_news2"), 3))
