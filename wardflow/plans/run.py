"""The five stages in order, each with lineage."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from wardflow.config import Settings
from wardflow.functions.embedding import HashedWords, ModelLoader
from wardflow.operators import gold, postings, silver, stored_gate
from wardflow.operators.chunking import chunk_documents
from wardflow.operators.lineage import Lineage
from wardflow.operators.retrieval import index_rows
from wardflow.schemas import INDEX
from wardflow.session import materialize, prepare, work_tables
from wardflow.sources import messages as msg
from wardflow.sources.corpus import read_corpus
from wardflow.sources.tables import KeyedTable, MergeMetrics
from wardflow.streaming.ingest import ingest_available


def index_table(spark: SparkSession, settings: Settings) -> KeyedTable:
    """Chunks with their vector, in ``settings.index_buckets`` hash buckets of the document.

    An upsert rewrites the buckets its documents fall into, so there should be many more
    buckets than documents in a usual batch.  The number is a property of the table: changing
    it needs a rebuild.
    """
    bucket = f"pmod(xxhash64(doc_id), {settings.index_buckets})"
    # a point belongs to one document, so its id and both together are the same key
    keys = ("doc_id", "point_id")
    return KeyedTable(spark, settings.index_path, INDEX, keys, bucket, partition_on=("doc_id",))


def build_index(
    chunks: DataFrame,
    table: KeyedTable,
    *,
    recreate: bool = True,
    prune: bool = False,
    load: ModelLoader = HashedWords,
) -> int:
    """Write chunks to the vector index; returns the points written.

    Without ``recreate`` they are upserted; ``prune`` then also removes chunks that a
    re-chunked document no longer has.
    """
    with work_tables(table.spark):
        # chunked and embedded once, whatever is read of it afterwards
        rows = table.stage(index_rows(chunks, load))
        if recreate:
            return table.replace(rows)
        documents = materialize(rows.select("doc_id").distinct()) if prune else None
        return table.upsert(rows, replacing=documents).source_rows


def stage_ingest(
    lineage: Lineage,
    messages: DataFrame,
    as_of=None,
    deadletters: Callable | None = None,
    tasks: int | None = None,
) -> dict[str, int]:
    """Drain a stream of messages, from files or Kafka, into Bronze and the dead letters.

    ``deadletters`` also gets the rejected messages of each batch as ``(key, value)`` records,
    say ``lambda rows: publish_kafka(rows, servers, topic)``.  ``tasks`` spreads the batches of a source
    with fewer partitions than the cluster has cores.
    """
    settings = lineage.settings
    with lineage.stage(
        "ingest", inputs=["kafka.raw"], outputs=["table.bronze", "kafka.deadletter"]
    ) as run:
        stats = ingest_available(
            messages, settings, as_of=as_of, deadletters=deadletters, tasks=tasks
        ).as_dict()
        run.rows(**stats)
        return stats


def stage_build_silver(lineage: Lineage, as_of=None, mode: str = "incremental") -> MergeMetrics:
    spark, settings = lineage.spark, lineage.settings
    with lineage.stage("build_silver", inputs=["table.bronze"], outputs=["table.silver"]) as run:
        metrics = silver.build_silver(
            silver.bronze_table(spark, settings),
            silver.silver_table(spark, settings),
            mode=mode,
            as_of=as_of,
        )
        run.rows(**metrics.as_dict())
        return metrics


def stage_quality_gate(lineage: Lineage, as_of=None, freshness: str = "oldest") -> None:
    spark, settings = lineage.spark, lineage.settings
    with lineage.stage("quality_gate", inputs=["table.silver"]):
        stored_gate.run_stored_gate(
            stored_gate.GateStates(silver.silver_table(spark, settings), settings.gate_path),
            max_age_minutes=settings.max_age_minutes,
            freshness=freshness,
            as_of=as_of,
            results_path=settings.quality_path,
        )


def stage_build_gold(lineage: Lineage, as_of=None) -> dict[str, int]:
    spark, settings = lineage.spark, lineage.settings
    with lineage.stage("build_gold", inputs=["table.silver"], outputs=["table.gold"]) as run:
        tables = silver.silver_table(spark, settings), gold.gold_table(spark, settings)
        with work_tables(spark):
            metrics = gold.build_gold(*tables, as_of=as_of)
        run.rows(**metrics)
        return metrics


def stage_rag_index(lineage: Lineage, documents: DataFrame | None = None) -> int:
    """Index ``documents`` in the corpus layout, or else the files of the corpus folder."""
    spark, settings = lineage.spark, lineage.settings
    with (
        lineage.stage("rag_index", inputs=["corpus"], outputs=["table.index"]) as run,
        work_tables(spark),
    ):
        if documents is None:
            documents = read_corpus(spark, settings.corpus_dir)
        chunks = materialize(chunk_documents(documents))
        points = build_index(chunks, index_table(spark, settings), recreate=True)
        postings.write(chunks, settings.postings_path)
        run.rows(points=points)
        return points


def run_pipeline(
    spark: SparkSession,
    settings: Settings,
    source: str | DataFrame,
    run_id: str | None = None,
    as_of: datetime | str | None = None,
    deadletters: Callable | None = None,
    documents: DataFrame | None = None,
    tasks: int | None = None,
) -> dict:
    """All stages under one parent run.

    ``source`` is a path of input lines, read as a stream in their order, or a streaming
    DataFrame in the Kafka layout (``stream_kafka``).  ``documents`` takes the place of the corpus
    folder where guidelines are a table; ``tasks`` spreads the messages of a source of few partitions.  A failing gate raises, so Gold and the index stay as they are.
    """
    prepare(spark)
    lineage = Lineage(spark, settings, run_id)
    if isinstance(source, str):
        source = msg.stream_lines(spark, source, settings.raw_topic)
    results: dict = {"parent_run_id": lineage.parent_run_id}
    results["ingest"] = stage_ingest(lineage, source, as_of, deadletters, tasks)
    results["silver"] = stage_build_silver(lineage, as_of).as_dict()
    stage_quality_gate(lineage, as_of)
    results["gold"] = stage_build_gold(lineage, as_of)
    results["rag_index"] = stage_rag_index(lineage, documents)
    return results
