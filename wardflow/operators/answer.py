"""Reranking and grounded, cited answers for a batch of queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.config import Settings
from wardflow.functions import text as tx
from wardflow.functions.embedding import HashedWords, ModelLoader, embed
from wardflow.functions.vectors import cosine
from wardflow.operators.gold import find_windows, worst_windows
from wardflow.operators.postings import Postings, build
from wardflow.operators.retrieval import TermStatistics, hybrid_search
from wardflow.operators.topk import SCORE_DECIMALS
from wardflow.session import materialize

# Fixed values.
REFUSAL = "No sufficiently relevant guidance was retrieved for this question."
ALWAYS_RELEVANT = 2
MIN_SENTENCE_WORDS = 4

# Keeps the log-odds finite where no query term, or every one, is covered.
_SMOOTHING = 0.01

# Adds ``score`` to rows with ``query_id, query, text``.
PairScorer = Callable[[DataFrame], DataFrame]


class PairModel(Protocol):
    def score(self, queries: list[str], texts: list[str]) -> list[float]: ...


# Reranking


def model_scorer(load: Callable[[], PairModel]) -> PairScorer:
    """Pair scorer from a model, which is loaded once per Python worker."""

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = load()
        for queries, texts in batches:
            yield pd.Series(model.score(queries.tolist(), texts.tolist()), dtype="float64")

    return lambda pairs: pairs.withColumn("score", run("query", "text"))


def lexical_scorer(queries: DataFrame, statistics: TermStatistics | Postings) -> PairScorer:
    """Log-odds of the share of the query's term weight that the text covers.

    A term weighs ``ln(1 + (n - df + 0.5) / (df + 0.5))``, so a term the corpus lacks weighs
    most and an off-topic question scores low.
    """
    n = statistics.corpus.select("n").scalar()
    distinct = queries.select(
        "query_id", F.explode(F.array_distinct(tx.tokens(F.col("query")))).alias("term")
    )
    df = F.coalesce(F.col("df"), F.lit(0))
    weighted = distinct.join(statistics.terms.select("term", "df"), "term", "left").select(
        "query_id", "term", F.ln(1 + (n - df + 0.5) / (df + 0.5)).alias("weight")
    )
    # As many entries per query as it has distinct words; sorted, so sums always run alike.
    of_query = weighted.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("_terms")
    )

    def weight(terms: Column) -> Column:
        return F.aggregate(terms, F.lit(0.0), lambda total, t: total + t["weight"])

    def share(pair_terms: Column) -> Column:
        covered = F.filter(F.col("_terms"), lambda t: F.array_contains(pair_terms, t["term"]))
        return weight(covered) / weight(F.col("_terms"))

    def score(pairs: DataFrame) -> DataFrame:
        covered = F.coalesce(tx.let(tx.tokens(F.col("text")), share), F.lit(0.0))
        odds = (covered + _SMOOTHING) / (1 - covered + _SMOOTHING)
        return pairs.join(of_query, "query_id", "left").withColumn("score", F.ln(odds)).drop("_terms")

    return score


def candidate_pairs(queries: DataFrame, hits: DataFrame, index: DataFrame, pool: int) -> DataFrame:
    """The best ``pool`` fused hits of each query with query and chunk text.

    Hits whose chunk the index lacks are dropped.
    """
    chosen = hits.filter(F.col("fused_rank") <= pool).select("query_id", "chunk_id", "fused_rank")
    chunk = index.select("chunk_id", "title", "heading", "source", "text")
    return chunk.join(chosen, "chunk_id").join(queries.select("query_id", "query"), "query_id")


def rerank(pairs: DataFrame, scorer: PairScorer, top_n: int = 5) -> DataFrame:
    """Best ``top_n`` pairs of each query by pair score; ``marker`` is the 1-based position.

    Equal scores keep the order of the fused hits.
    """
    score = F.round("score", SCORE_DECIMALS)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "fused_rank")
    return (
        scorer(pairs)
        .withColumn("score", score)
        .withColumn("marker", F.row_number().over(order))
        .filter(F.col("marker") <= top_n)
    )


# Answers


def accepted(reranked: DataFrame, min_score: float) -> DataFrame:
    """Reranked chunks of the queries whose best score reaches the floor."""
    best = F.max("score").over(Window.partitionBy("query_id"))
    return reranked.withColumn("_best", best).filter(F.col("_best") >= min_score).drop("_best")


def relevant_chunks(reranked: DataFrame) -> DataFrame:
    """The two best chunks, and any further one with a score above 0."""
    return reranked.filter((F.col("marker") <= ALWAYS_RELEVANT) | (F.col("score") > 0))


def candidate_sentences(chunks: DataFrame) -> DataFrame:
    """Cleaned sentences of four words or more: query_id, query, marker, position, sentence."""
    split = chunks.select(
        "query_id", "query", "marker", F.posexplode(tx.sentences(F.col("text"))).alias("position", "raw")
    )
    cleaned = split.select(
        "query_id", "query", "marker", "position", tx.clean_sentence(F.col("raw")).alias("sentence")
    )
    return cleaned.filter(tx.word_count(F.col("sentence")) >= MIN_SENTENCE_WORDS)


def pick_sentences(
    sentences: DataFrame, max_sentences: int = 4, load: ModelLoader = HashedWords
) -> DataFrame:
    """The distinct sentences nearest to their query: query_id, marker, pick, sentence.

    Each question is embedded once, not once for each of its sentences.
    """
    asked = sentences.select("query_id", "query").distinct()
    asked = asked.select("query_id", embed(F.col("query"), load).alias("_asked"))
    embedded = sentences.withColumn("_said", embed(F.col("sentence"), load))
    similarity = F.round(cosine(F.col("_asked"), F.col("_said")), SCORE_DECIMALS)
    scored = embedded.join(asked, "query_id").withColumn("similarity", similarity)
    best_first = [F.desc("similarity"), F.col("marker"), F.col("position")]
    same = Window.partitionBy("query_id", "sentence").orderBy(*best_first)
    of_query = Window.partitionBy("query_id").orderBy(*best_first)
    return (
        scored.withColumn("_copy", F.row_number().over(same))
        .filter(F.col("_copy") == 1)
        .withColumn("pick", F.row_number().over(of_query))
        .filter(F.col("pick") <= max_sentences)
        .select("query_id", "marker", "pick", "sentence", "similarity")
    )


def assemble(picked: DataFrame) -> DataFrame:
    """``query_id, answer``: picked sentences by citation marker, each followed by it."""
    parts = F.sort_array(F.collect_list(F.struct("marker", "pick", "sentence")))
    cited = F.transform(
        parts, lambda p: F.concat(p["sentence"], F.lit(" ["), p["marker"].cast("string"), F.lit("]"))
    )
    return picked.groupBy("query_id").agg(F.array_join(cited, " ").alias("answer"))


def _listed(rows: DataFrame, order: str, name: str, fields: list[Column]) -> DataFrame:
    """``query_id, name``: the rows of each query as an array of structs in the given order."""
    ordered = F.sort_array(F.collect_list(F.struct(order, F.struct(*fields).alias("item"))))
    items = F.transform(ordered, lambda x: x["item"])
    return rows.groupBy("query_id").agg(items.alias(name))


def answer_questions(
    queries: DataFrame,
    index: DataFrame,
    settings: Settings,
    *,
    scorer: PairScorer | None = None,
    load: ModelLoader = HashedWords,
    postings: Postings | None = None,
) -> DataFrame:
    """One row per query: answer or refusal, citations, contexts and the retrieval trace.

    ``queries`` has ``query_id, query``; ``index`` chunk rows with ``embedding``, ``postings`` their
    inverted index (built here without one).
    """
    postings = postings or build(index)
    scorer = scorer or lexical_scorer(queries, postings)
    # At most pool rows per query, and then top_n: work tables keep the searches from being
    # repeated for each of the lists made from them.
    pool = materialize(
        hybrid_search(
            queries,
            index,
            dense_top_k=settings.dense_top_k,
            bm25_top_k=settings.bm25_top_k,
            rrf_k=settings.rrf_k,
            load=load,
            postings=postings,
        ).filter(F.col("fused_rank") <= settings.rerank_pool)
    )
    pairs = candidate_pairs(queries, pool, index, settings.rerank_pool)
    reranked = materialize(rerank(pairs, scorer, settings.rerank_top_n))
    kept = accepted(reranked, settings.min_rerank_score)
    answers = assemble(
        pick_sentences(candidate_sentences(relevant_chunks(kept)), settings.max_sentences, load)
    )

    shown = F.round("score", 3).alias("rerank_score")
    named = [F.col(c) for c in ("chunk_id", "title", "heading", "source")]
    # Each list has at most top_n or pool entries per query.
    citations = _listed(kept, "marker", "citations", [F.col("marker"), *named, shown])
    contexts = _listed(kept, "marker", "contexts", [*named, F.col("text"), shown])
    trace = [F.round("rrf_score", 5).alias("rrf_score"), F.col("dense_rank"), F.col("bm25_rank")]
    retrieval = _listed(pool, "fused_rank", "retrieval", [F.col("chunk_id"), *trace])

    joined = (
        queries.select("query_id", "query")
        .join(citations, "query_id", "left")
        .join(contexts, "query_id", "left")
        .join(retrieval, "query_id", "left")
        .join(answers, "query_id", "left")
    )
    refused = F.col("citations").isNull()
    return joined.select(
        "query_id",
        "query",
        refused.alias("refused"),
        F.when(refused, REFUSAL).otherwise(F.coalesce("answer", F.lit(""))).alias("answer"),
        F.coalesce("citations", F.array()).alias("citations"),
        F.coalesce("contexts", F.array()).alias("contexts"),
        F.coalesce("retrieval", F.array()).alias("retrieval"),
    )


# Explaining Gold rows


def window_question() -> Column:
    """A Gold row as a retrieval question."""

    def text(column: str) -> Column:
        return F.col(column).cast("string")

    on_oxygen = F.when(F.col("pct_readings_on_oxygen") > 0, " on oxygen").otherwise("")
    temperature = F.format_string("%.1f", F.bround("max_temperature_c", 1))
    return F.concat(
        F.lit("NEWS2 "), text("max_news2"), F.lit(" ("), text("worst_risk_band"),
        F.lit(" risk), respiratory rate "), text("max_resp_rate"),
        F.lit(", SpO2 "), text("min_spo2"), F.lit("%"), on_oxygen,
        F.lit(", systolic BP "), text("min_systolic_bp"),
        F.lit(", heart rate "), F.bround("mean_heart_rate", 0).cast("int").cast("string"),
        F.lit(", temperature "), temperature,
        F.lit(". Recommended escalation and immediate management?"),
    )


def window_queries(gold: DataFrame) -> DataFrame:
    """Gold rows as ``query_id, patient_id, window_start, query``."""
    stamp = F.date_format("window_start", "yyyy-MM-dd HH:mm:ssXXX")
    return gold.select(
        F.concat_ws("@", F.col("patient_id"), stamp).alias("query_id"),
        "patient_id",
        "window_start",
        window_question().alias("query"),
    )


def explain_gold_windows(
    gold: DataFrame,
    index: DataFrame,
    settings: Settings,
    **options,
) -> DataFrame:
    """Cited guidance for every given Gold row, next to the row's patient and hour.

    Different windows often ask the same question, so each distinct question is answered
    once.
    """
    asked = window_queries(gold)
    distinct = asked.select("query").distinct()
    questions = materialize(distinct.select(F.md5("query").alias("query_id"), "query"))
    answers = answer_questions(questions, index, settings, **options).drop("query_id")
    return asked.withColumnRenamed("query_id", "window_id").join(answers, "query")


def explain_gold_window(
    gold: DataFrame,
    index: DataFrame,
    settings: Settings,
    patient_id: str | None = None,
    window_start=None,
    **options,
) -> DataFrame:
    """Cited guidance for the worst matching Gold row; raises where none matches."""
    worst = worst_windows(find_windows(gold, patient_id, window_start), 1)
    return explain_gold_windows(worst, index, settings, **options)
