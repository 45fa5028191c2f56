"""Names, thresholds and table locations of one deployment."""

from __future__ import annotations

import os
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Everything a run needs to know; ``root`` is a folder on shared storage."""

    root: str
    corpus_dir: str = ""

    # topics
    raw_topic: str = "vitals.raw"
    deadletter_topic: str = "vitals.deadletter"
    kafka_servers: str = "localhost:9092"

    # quality gate
    max_age_minutes: int = 24 * 60

    # retrieval
    dense_top_k: int = 20
    bm25_top_k: int = 20
    rrf_k: int = 60
    rerank_pool: int = 12
    rerank_top_n: int = 5
    max_sentences: int = 4
    # The floor belongs to the scale of the pair scorer in use.  The default scorer returns
    # the log-odds of the query's covered term weight, so 0 means "half covered".
    min_rerank_score: float = -2.0

    # buckets of the vector index
    index_buckets: int = 64

    # lineage
    namespace: str = "wardflow"
    producer: str = "urn:wardflow"
    job_name: str = "bedside_readings"

    @property
    def bronze_path(self) -> str:
        return f"{self.root}/bronze/vitals"

    @property
    def deadletter_path(self) -> str:
        return f"{self.root}/deadletter/vitals"

    @property
    def silver_path(self) -> str:
        return f"{self.root}/silver/vitals"

    @property
    def gold_path(self) -> str:
        return f"{self.root}/gold/news2_scores"

    @property
    def index_path(self) -> str:
        return f"{self.root}/index/guidelines"

    @property
    def postings_path(self) -> str:
        return f"{self.root}/index/postings"

    @property
    def quality_path(self) -> str:
        return f"{self.root}/quality/results"

    @property
    def gate_path(self) -> str:
        return f"{self.root}/quality/silver"

    @property
    def lineage_path(self) -> str:
        return f"{self.root}/lineage/events"

    @property
    def checkpoint_path(self) -> str:
        return f"{self.root}/checkpoints"

    def datasets(self) -> dict[str, tuple[str, str]]:
        """Logical dataset name -> (namespace, physical name), used by lineage events."""
        kafka = f"kafka://{self.kafka_servers}"
        return {
            "kafka.raw": (kafka, self.raw_topic),
            "kafka.deadletter": (kafka, self.deadletter_topic),
            "table.bronze": ("file", self.bronze_path),
            "table.silver": ("file", self.silver_path),
            "table.gold": ("file", self.gold_path),
            "corpus": ("file", self.corpus_dir),
            "table.index": ("file", self.index_path),
        }


def parent_run_id(explicit: str | None = None) -> str | None:
    """Run id given by the caller, else by the scheduler's environment."""
    return explicit or os.getenv("PIPELINE_RUN_ID") or None
