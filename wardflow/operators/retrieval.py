"""Batch retrieval: BM25, dense cosine, reciprocal rank fusion, hybrid search."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.functions import text as tx
from wardflow.functions.embedding import HashedWords, ModelLoader, embed
from wardflow.functions.ids import uuid5
from wardflow.operators import postings as ps
from wardflow.session import materialize
from wardflow.operators.topk import ID_COLUMNS, best_matches

# BM25 corpus statistics


@dataclass(frozen=True)
class TermStatistics:
    """``corpus``: one row (n, avgdl).  ``terms``: term, df, idf.  Made once, used often."""

    corpus: DataFrame
    terms: DataFrame


def token_counts(chunks: DataFrame) -> DataFrame:
    """Postings ``chunk_id, term, tf``, counted inside each chunk."""
    tokens = F.coalesce(tx.tokens(F.col("text")), F.array().cast("array<string>"))
    return chunks.select("chunk_id", F.inline(ps.counted(tokens))).withColumn("tf", F.col("tf").cast("long"))


def term_statistics(chunks: DataFrame) -> TermStatistics:
    """Corpus size and mean length; document frequency and idf of every term.

    A term in more than half of the chunks has a negative idf; it gets ``epsilon`` times the
    mean idf of the whole vocabulary (negatives included) instead.

    The corpus is read once: beside its distinct terms every chunk emits an empty term that
    carries its length.  The counts, one row per term, are kept as a work table; everything
    else follows from that.
    """

    def once_each(tokens: Column) -> Column:
        terms = F.transform(
            F.array_distinct(tokens), lambda t: F.struct(t.alias("term"), F.lit(0).alias("length"))
        )
        whole = F.struct(F.lit("").alias("term"), F.size(tokens).alias("length"))
        return F.concat(terms, F.array(whole))

    # Counts combine before the shuffle, so a term in every chunk sends one row per task.
    emitted = chunks.select(F.inline(tx.let(tx.tokens(F.col("text")), once_each)))
    counted = materialize(
        emitted.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("length").alias("length"))
    )
    whole = counted.filter(F.col("term") == "")
    corpus = whole.agg(
        F.coalesce(F.sum("df"), F.lit(0)).alias("n"), F.avg(F.col("length") / F.col("df")).alias("avgdl")
    )
    n = corpus.select("n").scalar()
    return TermStatistics(corpus, ps.with_idf(counted.filter(F.col("term") != ""), n))


# Dense scores


def vector_matrix(lists: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    values = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
    return values.reshape(len(lists), -1).astype(np.float64)


class CosineScorer:
    """Both sides: ``embedding``.  A vector without length scores 0 against everything."""

    def __init__(self, queries: pa.Table):
        self.query_ids = queries["query_id"].combine_chunks()
        self.vectors = vector_matrix(queries["embedding"].combine_chunks())
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))

    def score(self, block: pa.Table) -> np.ndarray:
        vectors = vector_matrix(block["embedding"].combine_chunks())
        norms = np.sqrt((vectors**2).sum(axis=1))
        lengths = np.outer(self.norms, norms)
        dots = self.vectors @ vectors.T
        return np.divide(dots, lengths, out=np.zeros_like(dots), where=lengths > 0)


# Searches


def bm25_search(
    queries: DataFrame, chunks: DataFrame, top_k: int = 20, postings: ps.Postings | None = None
) -> DataFrame:
    """Each query's best ``top_k`` chunks by BM25 with a score above 0.

    ``postings`` is the index of ``chunks``; without one it is built for this search.
    """
    return ps.search(queries, postings or ps.build(chunks), top_k)


def dense_search(queries: DataFrame, index: DataFrame, top_k: int = 20) -> DataFrame:
    """Each query's ``top_k`` nearest index rows by cosine; both sides have ``embedding``."""
    corpus = index.select(*ID_COLUMNS, "embedding")
    return best_matches(corpus, queries.select("query_id", "embedding"), CosineScorer, top_k)


def reciprocal_rank_fusion(rankings: DataFrame, k: int = 60) -> DataFrame:
    """``query_id, ranker, chunk_id, rank`` -> ``query_id, chunk_id, rrf_score``.

    The score is the sum of ``1 / (k + rank)`` over the lists that hold the chunk.
    """
    return rankings.groupBy("query_id", "chunk_id").agg(
        F.sum(F.lit(1.0) / (F.lit(k) + F.col("rank"))).alias("rrf_score")
    )


def fuse_rankings(dense: DataFrame, bm25: DataFrame, k: int = 60) -> DataFrame:
    """Both lists merged in one aggregation that keeps each list's rank (null if absent).

    Equal scores keep the order in which a dense-then-BM25 accumulator would meet them.
    """
    columns = ["query_id", *ID_COLUMNS, "rank"]
    both = (
        dense.select(*columns)
        .withColumn("ranker", F.lit("dense"))
        .unionByName(bm25.select(*columns).withColumn("ranker", F.lit("bm25")))
    )

    def rank_in(ranker: str) -> Column:
        return F.max(F.when(F.col("ranker") == ranker, F.col("rank")))

    fused = both.groupBy("query_id", *ID_COLUMNS).agg(
        F.sum(F.lit(1.0) / (F.lit(k) + F.col("rank"))).alias("rrf_score"),
        rank_in("dense").alias("dense_rank"),
        rank_in("bm25").alias("bm25_rank"),
    )
    order = Window.partitionBy("query_id").orderBy(
        F.desc("rrf_score"), F.asc_nulls_last("dense_rank"), F.asc_nulls_last("bm25_rank")
    )
    return fused.withColumn("fused_rank", F.row_number().over(order))


def hybrid_search(
    queries: DataFrame,
    index: DataFrame,
    *,
    dense_top_k: int = 20,
    bm25_top_k: int = 20,
    rrf_k: int = 60,
    load: ModelLoader = HashedWords,
    postings: ps.Postings | None = None,
) -> DataFrame:
    """Dense and BM25 lists of each query, fused.

    ``queries`` has ``query_id, query``; ``index`` chunk rows with their ``embedding``;
    ``postings`` the inverted index of the same chunks.
    """
    embedded = queries.select("query_id", embed(F.col("query"), load).alias("embedding"))
    dense = dense_search(embedded, index, dense_top_k)
    bm25 = bm25_search(queries, index, bm25_top_k, postings)
    return fuse_rankings(dense, bm25, rrf_k)


# Index


def index_rows(chunks: DataFrame, load: ModelLoader = HashedWords) -> DataFrame:
    """Chunks with their point id and embedding."""
    return chunks.select(
        uuid5(F.col("chunk_id")).alias("point_id"),
        "*",
        embed(F.col("text"), load).alias("embedding"),
    )


def index_profile(index: DataFrame) -> DataFrame:
    """One row: points and distinct documents."""
    return index.agg(
        F.count(F.lit(1)).alias("points"), F.countDistinct("doc_id").alias("documents")
    )
