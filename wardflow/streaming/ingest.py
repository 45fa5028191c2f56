"""Streaming ingest: raw messages to Bronze and dead-letter, and on to Silver and Gold.

Each micro-batch is written under its batch id, so a batch replayed after a failure replaces
its own output: at-least-once delivery, exactly-once tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardflow.config import Settings
from wardflow.operators import contract, gold, silver
from wardflow.schemas import DEADLETTER
from wardflow.session import materialize, work_tables
from wardflow.sources.tables import AppendLog


@dataclass
class IngestStats:
    consumed: int = 0
    valid: int = 0
    rejected: int = 0

    def add(self, valid: int, rejected: int) -> None:
        self.valid += valid
        self.rejected += rejected
        self.consumed += valid + rejected

    def as_dict(self) -> dict[str, int]:
        return {"consumed": self.consumed, "valid": self.valid, "rejected": self.rejected}


def deadletter_table(spark: SparkSession, settings: Settings) -> AppendLog:
    return AppendLog(spark, settings.deadletter_path, DEADLETTER)


def ingest_batch(
    messages: DataFrame,
    settings: Settings,
    batch_id: str | None = None,
    as_of: datetime | str | None = None,
    ingested_at=None,
    tasks: int | None = None,
    deadletters: Callable[[DataFrame], None] | None = None,
) -> tuple[int, int]:
    """Validate one batch and write both sides; returns (valid, rejected).

    ``deadletters`` also sends the rejected messages somewhere, as JSON records: at least once,
    as a replayed batch sends them again.

    The validated batch is kept while both sides are written, so each message is parsed once.
    ``tasks`` spreads a batch from a source with fewer partitions than the cluster has cores.
    """
    spark = messages.sparkSession
    if tasks:
        messages = messages.repartition(tasks, "partition", "offset")
    validated = contract.validate(messages, as_of).persist()
    try:
        stamp = as_of if ingested_at is None else ingested_at
        valid = silver.bronze_table(spark, settings).append(
            contract.bronze_rows(validated, stamp), batch_id
        )
        rejected = deadletter_table(spark, settings).append(
            contract.deadletter_rows(validated, stamp), batch_id
        )
        if deadletters is not None:
            rows = deadletter_table(spark, settings)
            rows = rows.rows() if batch_id is None else rows.batch(batch_id)
            payload = contract.deadletter_payload(rows)
            deadletters(payload.select(F.lit(None).cast("string").alias("key"), "value"))
        return valid, rejected
    finally:
        validated.unpersist()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when its checkpoint was made."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start_ingest(
    messages: DataFrame,
    settings: Settings,
    *,
    name: str = "ingest",
    as_of: datetime | str | None = None,
    ingested_at=None,
    stats: IngestStats | None = None,
    after_batch: Callable[[str], None] | None = None,
    tasks: int | None = None,
    deadletters: Callable[[DataFrame], None] | None = None,
    available_now: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Start the stream.  ``available_now`` drains what is there and stops.

    ``after_batch`` is called with each written batch's id, say to refresh Silver and Gold.
    Offsets are committed to the checkpoint only after that.
    """

    checkpoint = f"{settings.checkpoint_path}/{name}"

    def write(batch: DataFrame, batch_id: int) -> None:
        # a new checkpoint is a new stream: its batches must not replace an older one's
        label = f"{name}-{stream_id(batch.sparkSession, checkpoint)}-{batch_id:09d}"
        valid, rejected = ingest_batch(
            batch, settings, label, as_of, ingested_at, tasks, deadletters
        )
        if stats is not None:
            stats.add(valid, rejected)
        if after_batch is not None:
            after_batch(label)

    writer = (
        messages.writeStream.queryName(name)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def ingest_available(messages: DataFrame, settings: Settings, **options) -> IngestStats:
    """Drain a message stream into Bronze and dead-letter, then stop."""
    stats = IngestStats()
    start_ingest(messages, settings, stats=stats, available_now=True, **options).awaitTermination()
    return stats


def refresh_after(
    spark: SparkSession,
    settings: Settings,
    as_of: datetime | str | None = None,
    batch: str | None = None,
) -> dict[str, dict[str, int]]:
    """Incremental Silver, then only the Gold hours that changed.

    With ``batch`` exactly the rows of that Bronze batch are merged, else those ingested after
    the newest merged one.

    A correction may move a reading to another hour: the buckets it left count as changed
    too, and lose their row when it was their last.

    The changed hours are noted in the pending log before Silver is written, and struck off
    after Gold is.  A job that dies between the two leaves its note behind, and the next
    refresh, whichever way it finds its rows, brings those hours up to date as well.
    """
    bronze = silver.bronze_table(spark, settings)
    current, target = silver.silver_table(spark, settings), gold.gold_table(spark, settings)
    if batch is not None:
        fresh = bronze.batch(batch)
    else:
        mark = silver.watermark(current)
        fresh = bronze.rows() if mark is None else bronze.since("ingested_at", mark)
    with work_tables(spark):
        source = current.stage(silver.shape_silver(fresh, as_of))
        located = current.locate(source, "patient_id", "recorded_hour")
        pending = pending_hours(spark, settings)
        pending.append(gold.touched_buckets(source, located), uuid.uuid4().hex)
        merged = current.upsert(source, located=located)
        touched = materialize(pending.rows().distinct())
        refreshed = gold.build_gold(current, target, touched=touched, prune=True, as_of=as_of)
        pending.clear()
        return {"silver": merged.as_dict(), "gold": refreshed}


def pending_hours(spark: SparkSession, settings: Settings) -> AppendLog:
    """Patient hours that Silver may have changed and Gold does not show yet."""
    hours = T.StructType(
        [
            T.StructField("patient_id", T.StringType(), False),
            T.StructField("recorded_hour", T.TimestampType(), False),
        ]
    )
    return AppendLog(spark, f"{settings.root}/pending/gold", hours)
