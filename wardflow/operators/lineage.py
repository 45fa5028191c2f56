"""Stage lineage: START, then COMPLETE or FAIL, as rows of an event table."""

from __future__ import annotations

import traceback
import uuid
from collections.abc import Callable, Iterable
from contextlib import AbstractContextManager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.config import Settings, parent_run_id
from wardflow.schemas import LINEAGE_EVENT

# Fixed value: the event specification.
SCHEMA_URL = "https://openlineage.io/spec/2-0-2/OpenLineage.json#/$defs/RunEvent"


def event_row(
    settings: Settings,
    parent: str,
    kind: str,
    job: str,
    run_id: str,
    datasets: dict[str, Iterable[str]],
    facets: dict,
) -> dict:
    """One run event as the specification nests it; absent facets and datasets stay null or empty."""
    registry = settings.datasets()
    named = {
        side: [dict(zip(("namespace", "name"), registry[n])) for n in names]
        for side, names in datasets.items()
    }
    owner = {
        "run": {"runId": parent},
        "job": {"namespace": settings.namespace, "name": settings.job_name},
    }
    return {
        "eventTime": datetime.now(timezone.utc).isoformat(timespec="microseconds"),
        "eventType": kind,
        "producer": settings.producer,
        "schemaURL": SCHEMA_URL,
        "run": {"runId": run_id, "facets": {"parent": owner, **facets}},
        "job": {"namespace": settings.namespace, "name": job},
        **named,
    }


class StageRecorder(AbstractContextManager):
    """A stage while it runs: entering it tells its start, leaving it how it ended.

    ``rows`` notes output counts, which the closing event carries whether or not it failed.
    """

    def __init__(self, tell: Callable[[str, dict], None]):
        self._tell, self._counts = tell, {}

    def rows(self, **counts: int) -> None:
        self._counts.update((name, int(n)) for name, n in counts.items())

    def __enter__(self) -> StageRecorder:
        self._tell("START", {})
        return self

    def __exit__(self, kind, fault, trace) -> None:
        facets: dict = {"outputStatistics": self._counts} if self._counts else {}
        if fault is not None:
            facets["errorMessage"] = {
                "message": f"{kind.__name__}: {fault}",
                "programmingLanguage": "python",
                "stackTrace": "".join(traceback.format_exception(kind, fault, trace)),
            }
        self._tell("COMPLETE" if fault is None else "FAIL", facets)


class Lineage:
    """The stages of one parent run, told to an event table.  Events are single rows, not data."""

    def __init__(
        self,
        spark: SparkSession,
        settings: Settings,
        run_id: str | None = None,
        event_path: str | None = None,
    ):
        self.spark, self.settings = spark, settings
        self.parent_run_id = parent_run_id(run_id) or str(uuid.uuid4())
        self.event_path = event_path or settings.lineage_path

    def stage(
        self, job: str, *, inputs: Iterable[str] = (), outputs: Iterable[str] = ()
    ) -> StageRecorder:
        run_id, sides = str(uuid.uuid4()), {"inputs": tuple(inputs), "outputs": tuple(outputs)}

        def tell(kind: str, facets: dict) -> None:
            event = event_row(self.settings, self.parent_run_id, kind, job, run_id, sides, facets)
            row = self.spark.createDataFrame([event], LINEAGE_EVENT)
            row.coalesce(1).write.mode("append").json(self.event_path)

        return StageRecorder(tell)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LINEAGE_EVENT).json(path)


def run_summary(events: DataFrame) -> DataFrame:
    """One row per stage run: status, start, end, seconds, number of events, error."""
    at = F.to_timestamp("eventTime")
    flat = events.select(
        F.col("run.facets.parent.run.runId").alias("parent_run_id"),
        F.col("run.runId").alias("run_id"),
        F.col("job.name").alias("job"),
        F.col("eventType").alias("state"),
        F.col("run.facets.errorMessage.message").alias("error"),
        at.alias("at"),
    )
    started = F.min(F.when(F.col("state") == "START", F.col("at")))
    ended = F.max(F.when(F.col("state") != "START", F.col("at")))
    return (
        flat.groupBy("parent_run_id", "run_id", "job")
        .agg(
            F.max_by("state", F.struct((F.col("state") != "START").alias("final"), "at")).alias(
                "status"
            ),
            started.alias("started_at"),
            ended.alias("ended_at"),
            F.count(F.lit(1)).alias("events"),
            F.max("error").alias("error"),
        )
        .withColumn(
            "seconds", (F.unix_micros("ended_at") - F.unix_micros("started_at")) / 1_000_000
        )
    )


def events_per_run(events: DataFrame) -> DataFrame:
    """Events and failed stages of each parent run."""
    return (
        events.groupBy(F.col("run.facets.parent.run.runId").alias("parent_run_id"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("eventType") == "FAIL").alias("failed"),
        )
    )
