"""Approximate dense search: vectors in cells of a coarse clustering, a few cells probed per question.

Centroids come from Spark ML's k-means on a bounded sample; every vector is put into the cell of its
nearest centroid, and a question is scored only against the cells whose centroids are nearest to it.
Within those cells scores are exact.  ``tuned_probes`` measures on a sample of questions how many
cells reach a wanted recall.  The exact search stays the default everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.retrieval import CosineScorer, dense_search, vector_matrix
from wardflow.operators.topk import ID_COLUMNS, best_matches
from wardflow.session import materialize

# Cells, and sampled vectors for each that the centroids are learnt from.
CELLS = 64
SAMPLE_PER_CELL = 256

# Questions on which the number of probes is measured.
MEASURED = 64


@dataclass(frozen=True)
class CellIndex:
    """``rows``: the indexed columns and ``cell``, clustered by it; ``centroids``: one unit row a cell."""

    rows: DataFrame
    centroids: np.ndarray


def _unit(vectors: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    return np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0)


def nearest_cells(embedding: Column, centroids: np.ndarray, n: int) -> Column:
    """The ``n`` cells nearest by cosine, nearest first; the centroids' number and size are fixed."""

    def run(vectors: pa.Array) -> pa.Array:
        scores = vector_matrix(vectors) @ centroids.T
        best = np.argsort(-scores, axis=1, kind="stable")[:, :n].astype(np.int32)
        ends = np.arange(len(vectors) + 1, dtype=np.int32) * best.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(best.ravel()))

    run.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<int>")(embedding)


def sampled(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows at most, by the hash of their key."""
    share = min(1.0, most / max(1, rows.count()))
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * (1 << 30)))


def build(index: DataFrame, cells: int = CELLS) -> CellIndex:
    """Cells of ``index`` (chunk_id, doc_id, ordinal, embedding); all rows are indexed."""
    some = sampled(index, "chunk_id", cells * SAMPLE_PER_CELL)
    learnt = some.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = KMeans(k=cells, seed=1, maxIter=10, distanceMeasure="euclidean").fit(learnt)
    centroids = _unit(np.array(model.clusterCenters()))
    rows = index.select(*ID_COLUMNS, "embedding")
    placed = rows.withColumn("cell", nearest_cells(F.col("embedding"), centroids, 1)[0])
    # a cell may hold any share of the rows; its parts are several tasks
    dealt = placed.hint("rebalance", "cell").sortWithinPartitions("cell")
    return CellIndex(materialize(dealt), centroids)


class CellScorer(CosineScorer):
    """Scores a block's rows for the questions that probe their cell: ``probes`` lists the cells."""

    def __init__(self, queries: pa.Table):
        super().__init__(queries)
        lists = queries["probes"].combine_chunks()
        question = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        cell = lists.flatten().to_numpy()
        order = np.argsort(cell, kind="stable")
        cell, question = cell[order], question[order]
        self.of_cell = {c: question[a:b] for c, a, b in _runs(cell)}

    def score(self, block: pa.Table) -> np.ndarray:
        vectors = vector_matrix(block["embedding"].combine_chunks())
        norms = np.sqrt((vectors**2).sum(axis=1))
        cell = block["cell"].to_numpy()
        order = np.argsort(cell, kind="stable")
        out = np.full((len(self.query_ids), len(cell)), -np.inf)
        for c, a, b in _runs(cell[order]):
            questions, rows = self.of_cell.get(c), order[a:b]
            if questions is None:
                continue
            lengths = np.outer(self.norms[questions], norms[rows])
            dots = self.vectors[questions] @ vectors[rows].T
            out[np.ix_(questions, rows)] = np.divide(dots, lengths, out=np.zeros_like(dots), where=lengths > 0)
        return out


def _runs(ordered: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, start, stop) of each run of equal values."""
    if len(ordered) == 0:
        return []
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    return list(zip(ordered[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(ordered)], strict=True))


def search(queries: DataFrame, index: CellIndex, top_k: int = 20, probes: int = 8) -> DataFrame:
    """Each query's ``top_k`` nearest rows among those of its ``probes`` nearest cells."""
    cells = nearest_cells(F.col("embedding"), index.centroids, probes)
    asked = queries.select("query_id", "embedding", cells.alias("probes"))
    return best_matches(index.rows, asked, CellScorer, top_k)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact hits that were found; 1 where there are none."""
    keys = ["query_id", "chunk_id"]
    wanted = exact.select(*keys)
    got = wanted.join(found.select(*keys), keys, "left_semi").count()
    return got / max(1, wanted.count()) if got else float(wanted.isEmpty())


def tuned_probes(queries: DataFrame, index: CellIndex, top_k: int = 20, target: float = 0.92) -> int:
    """The least power of two of cells whose recall on some ``MEASURED`` queries reaches ``target``.

    All cells are the exact search, so there always is one.
    """
    asked = materialize(sampled(queries, "query_id", MEASURED))
    exact = materialize(dense_search(asked, index.rows, top_k))
    probes = 1
    while probes < len(index.centroids):
        if recall(search(asked, index, top_k, probes), exact) >= target:
            return probes
        probes *= 2
    return len(index.centroids)
