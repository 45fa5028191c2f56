"""Best-k search of a batch of queries against a corpus of any size.

Every query is compared with every corpus row, but pairs never become rows: a task scores
one Arrow block of the corpus against the whole query batch as a matrix and keeps only the
best k per query.  What leaves a task is at most k rows per query.

Queries go to the tasks in blocks of about a stated size, each a broadcast of its own that goes when
its block has been written, and the corpus is read in place for each block: it is never shuffled or
copied, and a batch of any size takes the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.session import materialize

# Scores are compared at this many decimals, so that sums taken in another order (another
# partitioning, a recomputed task) give the same ranks; ties go by doc_id, then ordinal.
SCORE_DECIMALS = 8

# Queries of a block: its rows are on the driver and in a broadcast at once, and a task holds a
# matrix of this many scores for each of BLOCK_ROWS corpus rows.
QUERY_BLOCK = 512
BLOCK_ROWS = 2_048

ID_COLUMNS = ("chunk_id", "doc_id", "ordinal")


class Scorer(Protocol):
    """Scores corpus blocks against one batch of queries; built inside the task."""

    query_ids: pa.Array

    def score(self, block: pa.Table) -> np.ndarray:
        """(queries x block rows) scores; ``-inf`` marks rows that are no candidates."""


ScorerFactory = Callable[[pa.Table], Scorer]


def _best_mask(scores: np.ndarray, k: int) -> np.ndarray:
    """Marks each row's k highest entries; among equals the leftmost win."""
    if scores.shape[1] <= k:
        return np.isfinite(scores)
    kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, [scores.shape[1] - k]]
    above, level = scores > kth, scores == kth
    room = k - above.sum(axis=1, keepdims=True)
    return (above | (level & (np.cumsum(level, axis=1) <= room))) & np.isfinite(scores)


class _Best:
    """Running best k per query as flat columns, compacted now and then."""

    def __init__(self, scorer: Scorer, k: int):
        self.scorer, self.k = scorer, k
        self.parts: list[pa.Table] = []
        self.size = 0

    def add(self, block: pa.Table) -> None:
        block = block.sort_by([("doc_id", "ascending"), ("ordinal", "ascending")])
        scores = np.round(self.scorer.score(block), SCORE_DECIMALS)
        query, row = np.nonzero(_best_mask(scores, self.k))
        ids = block.select(list(ID_COLUMNS)).take(pa.array(row))
        part = ids.append_column("score", pa.array(scores[query, row])).append_column(
            "_query", pa.array(query)
        )
        self.parts.append(part)
        self.size += part.num_rows
        if self.size > 4 * self.k * len(self.scorer.query_ids):
            self.parts = [self._compact()]
            self.size = self.parts[0].num_rows

    def _compact(self) -> pa.Table:
        order = [
            ("_query", "ascending"),
            ("score", "descending"),
            ("doc_id", "ascending"),
            ("ordinal", "ascending"),
        ]
        table = pa.concat_tables(self.parts).sort_by(order)
        query = table["_query"].to_numpy()
        first = np.searchsorted(query, query, side="left")
        return table.filter(pa.array(np.arange(len(query)) - first < self.k))

    def result(self) -> pa.Table | None:
        if not self.size:
            return None
        table = self._compact()
        query_ids = self.scorer.query_ids.take(table["_query"].combine_chunks())
        return table.drop_columns(["_query"]).add_column(0, "query_id", query_ids)


def _blocks(table: pa.Table) -> Iterator[pa.Table]:
    for start in range(0, table.num_rows, BLOCK_ROWS):
        yield table.slice(start, BLOCK_ROWS)


def _schema(query_ids: DataFrame, corpus: DataFrame) -> str:
    id_type = dict(query_ids.dtypes)["query_id"]
    kinds = dict(corpus.dtypes)
    ids = ", ".join(f"{c} {kinds[c]}" for c in ID_COLUMNS)
    return f"query_id {id_type}, {ids}, score double"


def _with_broadcast(
    corpus: DataFrame, shared: Broadcast, factory: ScorerFactory, k: int, schema: str
) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = factory(shared.value)
        best = _Best(scorer, k)
        for batch in batches:
            for block in _blocks(pa.Table.from_batches([batch])):
                best.add(block)
        found = best.result()
        if found is not None:
            yield from found.combine_chunks().to_batches()

    return corpus.mapInArrow(search, schema)


def best_matches(
    corpus: DataFrame,
    queries: DataFrame,
    factory: ScorerFactory,
    k_best: int,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, chunk_id, doc_id, ordinal, score, rank`` of each query's best ``k_best``.

    ``corpus`` has ``chunk_id, doc_id, ordinal`` and what the scorer reads; ``queries`` one or
    more rows per ``query_id``.  Exact: every corpus row is scored for every query.  Scores are
    ranked at ``SCORE_DECIMALS`` decimals, so two that differ only beyond them are ties.
    """
    spark, schema = corpus.sparkSession, _schema(queries, corpus)
    queries = materialize(queries)
    # blocks by the hash of the id, about query_block ids each; no task sees all ids
    blocks = max(1, -(-queries.select("query_id").distinct().count() // query_block))
    placed = queries.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    found = spark.createDataFrame([], schema)
    for k in range(blocks):
        block = placed.filter(F.col("_block") == k).drop("_block").toArrow()
        if block.num_rows == 0:
            continue
        shared = spark.sparkContext.broadcast(block)
        part = _with_broadcast(corpus, shared, factory, k_best, schema)
        if blocks > 1:  # written out, so that its broadcast can go
            part = materialize(rank_matches(part, k_best).drop("rank"))
            shared.destroy()
        found = found.unionByName(part)
    return rank_matches(found, k_best)


def rank_matches(found: DataFrame, k: int) -> DataFrame:
    """1-based rank per query, best first; keeps ranks up to k."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id", "ordinal")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)
