"""Exact top-k inner products in three phases with a uniform threshold.

Vectors are integers.  The stated queries are taken in blocks of ``QUERY_BLOCK``; of each block,
once it is at the tasks:

1. every chunk of rows gathers a local score list for each query: it ranks its rows by the partial
   product over the query's heaviest dimensions and scores the best ``k`` exactly;
2. the k-th best of all those scores is a safe cutoff, as the true k-th best cannot be lower; it
   is broadcast, and each chunk collects the entries whose partial product plus the largest
   possible rest (lengths of the remaining parts) reaches it;
3. what is left of those entries' scores is resolved exactly, and entries at or above the cutoff
   meet for the final ranking, ties to the smaller id.

Rows never meet as pairs in a shuffle: a chunk compares itself with the block it was given.

A row whose vector is null or empty of finite use (a null, NaN or infinite component) takes no
part.  A query's own row, told by its id, is no candidate; repeated rows of another id are
candidates each.  Vectors of different lengths are compared as if padded with zeros.  A null id
takes no part.  Scores are exact as long as they fit 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardflow.session import materialize

# Queries of one block: their vectors are on the driver and in a broadcast at once.
QUERY_BLOCK = 4096

# Rows of a chunk, and queries of a step within it: bounds the score matrix.
CHUNK_ROWS, CHUNK_QUERIES = 4096, 512

# Share of the dimensions that phase 1 looks at.
HEAD = 0.5


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component; null for a vector that takes no part."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return F.when(~bad, whole)


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as one matrix, padded with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy().astype(np.int64)
    out = np.zeros((len(vectors), max(width, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


class Block:
    """A block of queries, its dimensions ordered by weight."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        weight = np.abs(vectors).sum(axis=0, dtype=np.float64)
        self.order = np.argsort(-weight, kind="stable")
        self.ids, self.vectors = ids, vectors[:, self.order]
        self.head = max(1, int(vectors.shape[1] * HEAD)) if vectors.shape[1] else 0
        rest = self.vectors[:, self.head :].astype(np.float64)
        self.rest = np.sqrt((rest**2).sum(axis=1))

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        """Rows in the block's order of dimensions; what lies beyond its width is zero there."""
        return vectors[:, : len(self.order)][:, self.order]

    def products(self, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact products: in floating point while every sum stays below 2^53."""
        bound = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0))
        if bound * max(1, rows.shape[1]) < 2.0**53:
            return queries.astype(np.float64) @ rows.astype(np.float64).T
        return queries @ rows.T


def _chunks(batches: Iterator[pa.RecordBatch], block: Block):
    """(row ids, row matrix in the block's order) for bounded numbers of rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(at, CHUNK_ROWS)
            ids = part.column(0).to_numpy().astype(np.int64)
            yield ids, block.rows(_matrix(part.column(1), len(block.order)))


def _local_lists(block, k: int) -> Callable:
    """Phase 1: for each query, exact scores of the rows that look best in part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        best = np.full((len(own.ids), 0), 0, np.int64)
        seen = np.full((len(own.ids), 0), False)
        for ids, rows in _chunks(batches, own):
            scores, valid = [], []
            for q in range(0, len(own.ids), CHUNK_QUERIES):
                queries = own.vectors[q : q + CHUNK_QUERIES]
                part = own.products(queries[:, : own.head], rows[:, : own.head]).astype(np.float64)
                part[own.ids[q : q + CHUNK_QUERIES, None] == ids[None, :]] = -np.inf
                n = min(k, len(ids))
                top = np.argpartition(-part, n - 1, axis=1)[:, :n]
                exact = np.einsum("qd,qnd->qn", queries, rows[top])
                scores.append(exact)
                valid.append(np.take_along_axis(part, top, 1) > -np.inf)
            best = np.concatenate([best, np.concatenate(scores)], axis=1)
            seen = np.concatenate([seen, np.concatenate(valid)], axis=1)
            low = np.iinfo(np.int64).min
            order = np.argsort(-np.where(seen, best, low).astype(np.float64), axis=1, kind="stable")
            best = np.take_along_axis(best, order[:, :k], 1)
            seen = np.take_along_axis(seen, order[:, :k], 1)
        query, place = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query.astype(np.int64)), pa.array(best[query, place])], ["query", "score"]
        )

    return run


def _sufficient(block, cutoffs) -> Callable:
    """Phases 2 and 3: entries that may reach the cutoff, their scores resolved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cutoff = block.value, cutoffs.value
        for ids, rows in _chunks(batches, own):
            rest = np.sqrt((rows[:, own.head :].astype(np.float64) ** 2).sum(axis=1))
            for q in range(0, len(own.ids), CHUNK_QUERIES):
                at = slice(q, q + CHUNK_QUERIES)
                queries, least = own.vectors[at], cutoff[at, None]
                part = own.products(queries[:, : own.head], rows[:, : own.head])
                # the slack covers the rounding of the lengths
                limit = part + np.outer(own.rest[at], rest) * (1 + 1e-9) + 1
                query, row = np.nonzero((limit >= least) & (own.ids[at, None] != ids[None, :]))
                if own.head < queries.shape[1] and len(query) * 8 > part.size:
                    tail = own.products(queries[:, own.head :], rows[:, own.head :])[query, row]
                else:
                    tail = _pairwise(queries[:, own.head :], rows[:, own.head :], query, row)
                score = part[query, row].astype(np.int64) + tail.astype(np.int64)
                keep = score >= cutoff[at][query]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own.ids[at][query[keep]]),
                        pa.array(ids[row[keep]]),
                        pa.array(score[keep]),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    return run


def _pairwise(queries: np.ndarray, rows: np.ndarray, query: np.ndarray, row: np.ndarray) -> np.ndarray:
    out = np.zeros(len(query), np.int64)
    for k in range(0, len(query), 1 << 16):
        at = slice(k, k + (1 << 16))
        out[at] = np.einsum("nd,nd->n", queries[query[at]], rows[row[at]])
    return out


def search(
    vectors: DataFrame, queries: Column, k: int, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best rows of each query.

    ``vector`` is a column of integer arrays (see ``quantised``); ``queries`` marks query rows.
    """
    spark = vectors.sparkSession
    table = materialize(
        vectors.select(
            F.col(key).cast("long").alias("id"),
            F.col(vector).alias("vector"),
            queries.alias("asked"),
        ).filter(F.col("id").isNotNull() & F.col("vector").isNotNull())
    )
    asked = table.filter("asked").select("id", "vector")
    rows = table.select("id", "vector")
    # blocks of queries: a hash bucket each, so no block depends on the order of rows
    n = asked.count()
    blocks = max(1, -(-n // (QUERY_BLOCK // 2)))
    numbered = materialize(
        asked.distinct().withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    )
    found = []
    for b in range(blocks):
        part = numbered.filter(F.col("block") == b).drop("block").toArrow()
        if part.num_rows == 0:
            continue
        matrix = _matrix(part.column(1).combine_chunks(), 0)
        block = Block(part.column(0).to_numpy().astype(np.int64), matrix)
        sent = spark.sparkContext.broadcast(block)
        lists = rows.mapInArrow(_local_lists(sent, k), "query long, score long")
        best = Window.partitionBy("query").orderBy(F.desc("score"))
        kth = (
            lists.withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= k)
            .groupBy("query")
            .agg(F.min("score").alias("score"), F.count("*").alias("n"))
            .filter(F.col("n") == k)
            .toArrow()
        )
        cutoff = np.full(len(block.ids), np.iinfo(np.int64).min)
        cutoff[kth.column("query").to_numpy()] = kth.column("score").to_numpy()
        entries = rows.mapInArrow(
            _sufficient(sent, spark.sparkContext.broadcast(cutoff)),
            "query_id long, vec_id long, score long",
        )
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        found.append(
            materialize(
                entries.withColumn("rank", F.row_number().over(order))
                .filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score")
            )
        )
    kind = T.StructType(
        [
            T.StructField("query_id", T.LongType()),
            T.StructField("rank", T.IntegerType()),
            T.StructField("vec_id", T.LongType()),
            T.StructField("score", T.LongType()),
        ]
    )
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], kind)
