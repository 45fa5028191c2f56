"""Registered queries: every operator over whole tables, as ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import contextlib
import dataclasses
import os
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardflow.config import Settings
from wardflow.functions import text as tx
from wardflow.functions.ids import uuid5
from wardflow.functions.times import age_minutes, instant
from wardflow.functions.vectors import cosine
from wardflow.operators import answer as an
from wardflow.operators import cells, contract, gold, lineage, quality, retrieval, silver, stored_gate
from wardflow.operators import postings as ps
from wardflow.operators.chunking import section_rows
from wardflow.operators.upsert import merge_metrics, merge_rows, newest_rows
from wardflow.plans import fixtures as fx
from wardflow.plans import run
from wardflow.session import materialize, prepare, shared_dir, spread
from wardflow.sources import messages as msg
from wardflow.sources.corpus import parse_documents
from wardflow.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Scores in results are shown at this many decimals.
SHOWN = 6


def query(fn: Query) -> Query:
    """Register ``fn`` under its own name."""

    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return _plain_times(fn(spark, sf_dir))

    QUERIES[fn.__name__] = prepared
    return fn


def _plain_times(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times, as the SQL side has them."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            F.col(c).cast("timestamp_ntz").alias(c) if isinstance(t, T.TimestampType) else F.col(c)
            for c, t in kinds.items()
        ]
    )


# shared inputs


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.validate(spread(fx.messages(spark, sf_dir), "offset"), fx.AS_OF)


def _deadletter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.deadletter_rows(_validated(spark, sf_dir), fx.AS_OF)


def _reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per reason, with the position of its message."""
    return _deadletter(spark, sf_dir).select(
        F.col("source.partition").alias("part_no"),
        F.col("source.offset").alias("off_no"),
        F.explode("errors").alias("reason"),
    )


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.shape_silver(fx.bronze(spark, sf_dir), fx.AS_OF)


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.aggregate_gold(_silver(spark, sf_dir), fx.AS_OF)


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Bronze before and from the middle of its time span: two successive loads."""
    rows = fx.bronze(spark, sf_dir)
    ends = rows.agg(
        F.unix_micros(F.min("ingested_at")).alias("a"), F.unix_micros(F.max("ingested_at")).alias("b")
    )
    middle = F.timestamp_micros(ends.select(F.expr("a + (b - a) div 2")).scalar())
    early = F.col("ingested_at") < middle
    return rows.filter(early), rows.filter(~early)


# sources and sinks


@query
def src2_nonblank_lines(spark, sf_dir):
    lines = fx.texts(spark, sf_dir).select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "value")
    )
    kept = msg.nonblank_lines(lines)
    return kept.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.length("value")).alias("characters"),
        F.min("line_no").alias("first_line"),
    )


@query
def src3_json_decode(spark, sf_dir):
    doc = F.try_parse_json("props")
    return fx.table(spark, sf_dir, "events").select(
        "event_id", F.try_variant_get(doc, "$.k", "bigint").alias("k")
    )


@query
def str2_front_matter(spark, sf_dir):
    """Texts with a front-matter block in front, parsed again."""
    head = F.concat(F.lit("---\ntitle: Text "), F.col("doc_id").cast("string"), F.lit("\nsource: "),
                    "source", F.lit("\ntopic: first\ntopic: "), "lang", F.lit("\n---\n"))
    files = fx.texts(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("doc_id"), F.concat(head, "text").alias("value")
    )
    parsed = parse_documents(files)
    return parsed.select("doc_id", "title", "source", "topic", F.md5("body").alias("digest"))


@query
def src5_table_read(spark, sf_dir):
    """Bronze written as a table, read back and profiled."""
    table = silver.bronze_table(spark, _fresh(spark))
    table.append(fx.bronze(spark, sf_dir), "load")
    return silver.table_profile(table.rows())


@query
def snk1_published_records(spark, sf_dir):
    lines = spread(fx.messages(spark, sf_dir), "offset").select("value")
    keyed = msg.keyed_records(msg.nonblank_lines(lines))
    return keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("records"), F.min("value").alias("first_value")
    )


@query
def snk1_line_log(spark, sf_dir):
    """Messages appended to a log of lines in two parts, read back: each key's in their order."""
    log = f"{_fresh(spark).root}/log"
    rows = fx.messages(spark, sf_dir).orderBy("offset")
    first = F.col("offset") % 1000 < 400
    sent = [msg.append_lines(rows.filter(part), log) for part in (first, ~first)]
    back = msg.read_lines(spark, log, "vitals.raw", split_bytes=1 << 20)
    seq = F.row_number().over(Window.partitionBy("key").orderBy("offset"))
    return back.select("key", seq.alias("seq"), "value", F.lit(sum(sent)).alias("sent"))


@query
def stm6_line_stream(spark, sf_dir):
    """A log that grows twice, drained after each time by a stream that starts again where it stopped."""
    settings = _fresh(spark)
    log = f"{settings.root}/log"
    rows = fx.messages(spark, sf_dir).orderBy("offset")
    first = F.col("offset") % 1000 < 400
    for part in (first, ~first):
        msg.append_lines(rows.filter(part), log)
        lines = msg.stream_lines(spark, log, "vitals.raw", split_bytes=1 << 20)
        ingest.ingest_available(lines, settings, as_of=fx.AS_OF)
    seq = F.row_number().over(Window.partitionBy("patient_id").orderBy("kafka_offset"))
    kept = silver.bronze_table(spark, settings).rows().withColumn("seq", seq)
    return kept.drop("ingested_at", "kafka_offset")


@query
def snk2_deadletter_rows(spark, sf_dir):
    return _deadletter(spark, sf_dir).select(
        "raw",
        F.array_join("errors", "; ").alias("errors"),
        "rejected_at",
        F.col("source.topic").alias("topic"),
        F.col("source.partition").alias("part_no"),
        F.col("source.offset").alias("off_no"),
    )


@query
def snk4_first_build_metrics(spark, sf_dir):
    table = silver.silver_table(spark, _fresh(spark))
    metrics = table.upsert(_silver(spark, sf_dir)).as_dict()
    return table.read().agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.lit(metrics["num_target_rows_updated"]).cast("bigint").alias("num_target_rows_updated"),
        F.lit(metrics["num_target_rows_inserted"]).cast("bigint").alias("num_target_rows_inserted"),
    )


@query
def jsn1_deadletter_json(spark, sf_dir):
    """Dead letters as JSON, read back: is the refused message nested, or kept as a text?"""
    payload = contract.deadletter_payload(_deadletter(spark, sf_dir))
    doc = F.parse_json("value")
    raw = F.schema_of_variant(F.variant_get(doc, "$.raw", "variant"))
    return payload.select(
        F.variant_get(doc, "$.source.offset", "bigint").alias("off_no"),
        F.array_join(F.variant_get(doc, "$.errors", "array<string>"), "; ").alias("errors"),
        F.when(raw == "STRING", "text").otherwise("json").alias("raw_kind"),
    )


@query
def prj2_run_stamp(spark, sf_dir):
    return _silver(spark, sf_dir).select("reading_id", "updated_at")


# contract


@query
def con1_rejection_reasons(spark, sf_dir):
    return _deadletter(spark, sf_dir).select(
        F.col("source.offset").alias("off_no"), F.array_join("errors", "; ").alias("errors")
    )


@query
def con2_not_an_object(spark, sf_dir):
    return _reasons(spark, sf_dir).filter(F.col("reason").startswith("record: "))


@query
def con3_missing_fields(spark, sf_dir):
    missing = _reasons(spark, sf_dir).filter(F.col("reason").endswith(contract.MISSING))
    return missing.groupBy(F.substring_index("reason", ":", 1).alias("field")).agg(
        F.count(F.lit(1)).alias("messages")
    )


@query
def con4_unknown_fields(spark, sf_dir):
    return _reasons(spark, sf_dir).filter(F.col("reason").endswith(contract.EXTRA))


@query
def con5_out_of_range(spark, sf_dir):
    return _reasons(spark, sf_dir).filter(F.col("reason").contains("than or equal to"))


@query
def con6_patient_pattern(spark, sf_dir):
    return _reasons(spark, sf_dir).filter(F.col("reason").contains("String should match"))


@query
def con7_consciousness_levels(spark, sf_dir):
    return _reasons(spark, sf_dir).filter(F.col("reason").endswith(contract.NOT_LEVEL))


@query
def con8_blank_strings(spark, sf_dir):
    return _reasons(spark, sf_dir).filter(F.col("reason").contains("should have at least"))


@query
def con9_in_the_future(spark, sf_dir):
    return _reasons(spark, sf_dir).filter(F.col("reason").contains("in the future"))


@query
def con10_refused_types(spark, sf_dir):
    return _reasons(spark, sf_dir).filter(F.col("reason").contains("should be a valid"))


@query
def con12_bronze_rows(spark, sf_dir):
    validated = _validated(spark, sf_dir)
    return contract.bronze_rows(validated, F.col("timestamp"))


@query
def rte1_routes(spark, sf_dir):
    route = F.when(F.size("errors") == 0, "bronze").otherwise("deadletter")
    return _validated(spark, sf_dir).groupBy(route.alias("route"), "partition").agg(
        F.count(F.lit(1)).alias("messages")
    ).withColumnRenamed("partition", "part_no")


@query
def agg3_ingest_stats(spark, sf_dir):
    return contract.ingest_stats(_validated(spark, sf_dir))


@query
def agg4_rejection_profile(spark, sf_dir):
    return contract.rejection_profile(_deadletter(spark, sf_dir))


@query
def agg4_first_reasons(spark, sf_dir):
    return contract.first_reason_samples(_deadletter(spark, sf_dir))


# silver


@query
def win1_latest_reading(spark, sf_dir):
    return silver.latest_readings(fx.bronze(spark, sf_dir))


@query
def prj1_silver_rows(spark, sf_dir):
    return _silver(spark, sf_dir).drop("updated_at")


@query
def prj3_age_minutes(spark, sf_dir):
    age = age_minutes(F.col("recorded_at"), instant(fx.AS_OF))
    return fx.bronze(spark, sf_dir).select("kafka_offset", F.round(age, 4).alias("age_minutes"))


@query
def agg2_watermark(spark, sf_dir):
    return _silver(spark, sf_dir).agg(F.max("ingested_at").alias("watermark"))


@query
def flt1_newer_than_watermark(spark, sf_dir):
    """Rows of the whole of Bronze that a Silver built from its first half has not seen."""
    early, _ = _halves(spark, sf_dir)
    mark = silver.newest_ingested(silver.shape_silver(early, fx.AS_OF))
    return silver.newer_than(fx.bronze(spark, sf_dir), mark).select(
        "reading_id", "ingested_at", "kafka_offset"
    )


@query
def mrg1_silver_upsert(spark, sf_dir):
    early, late = (silver.shape_silver(part, fx.AS_OF) for part in _halves(spark, sf_dir))
    return merge_rows(early, late, ["reading_id"]).drop("updated_at")


@query
def agg9_merge_metrics(spark, sf_dir):
    early, late = (silver.shape_silver(part, fx.AS_OF) for part in _halves(spark, sf_dir))
    return merge_metrics(early, late, ["reading_id"])


# Orders from this day on arrive with the increment; every seventh older one is corrected.
ORDERS_SINCE = "1996-01-01"


@query
def mrg1_orders_upsert(spark, sf_dir):
    """All orders before a day, merged with all later ones and corrected versions of old ones."""
    orders = fx.table(spark, sf_dir, "orders")
    since = F.col("o_orderdate") >= F.lit(ORDERS_SINCE).cast("date")
    corrected = orders.filter(~since & (F.col("o_orderkey") % 7 == 0)).withColumns(
        {"o_orderpriority": F.lit("corrected"), "o_totalprice": F.col("o_totalprice") + 1}
    )
    source = orders.filter(since).unionByName(corrected)
    return merge_rows(orders.filter(~since), source, ["o_orderkey"])


@query
def set1_append_all(spark, sf_dir):
    early, late = _halves(spark, sf_dir)
    return early.unionByName(late).groupBy("reading_id").agg(F.count(F.lit(1)).alias("versions"))


@query
def agg5_table_profile(spark, sf_dir):
    return silver.table_profile(fx.bronze(spark, sf_dir))


# score and gold


@query
def news8_scored_readings(spark, sf_dir):
    scored = gold.score_readings(_silver(spark, sf_dir))
    parts = [c for c in scored.columns if c.startswith("score_")]
    return scored.select(
        "reading_id", *parts, "news2_total", "max_parameter_score", "risk_band"
    )


@query
def agg1_gold_patient_hour(spark, sf_dir):
    return _gold(spark, sf_dir).drop("computed_at")


@query
def mrg2_gold_upsert(spark, sf_dir):
    """Gold of the first half, with only the windows that the second half touches upserted."""
    early, late = (silver.shape_silver(part, fx.AS_OF) for part in _halves(spark, sf_dir))
    located = early.join(late.select("reading_id"), "reading_id", "left_semi")
    touched = materialize(gold.touched_buckets(late, located))
    merged = newest_rows(early, late, ["reading_id"], "ingested_at")
    again = merged.join(touched, ["patient_id", "recorded_hour"], "left_semi")
    windows = touched.withColumnRenamed("recorded_hour", "window_start")
    target = gold.aggregate_gold(early, fx.AS_OF).join(windows, list(gold.KEYS), "left_anti")
    source = gold.aggregate_gold(again, fx.AS_OF)
    return merge_rows(target, source, list(gold.KEYS)).drop("computed_at")


@query
def stm3_hourly_windows(spark, sf_dir):
    return gold.windowed_gold(_silver(spark, sf_dir))


@query
def agg6_band_histogram(spark, sf_dir):
    return gold.band_histogram(_gold(spark, sf_dir))


@query
def agg6_reduction(spark, sf_dir):
    return gold.reduction(_gold(spark, sf_dir))


@query
def win5_trend(spark, sf_dir):
    return gold.trend(_gold(spark, sf_dir))


@query
def top5_worst_window_per_patient(spark, sf_dir):
    return gold.worst_window_per_patient(_gold(spark, sf_dir)).drop("computed_at")


@query
def top6_worst_windows(spark, sf_dir):
    return gold.worst_windows(_gold(spark, sf_dir), 8).drop("computed_at")


@query
def flt2_windows_of_a_patient(spark, sf_dir):
    return gold.find_windows(_gold(spark, sf_dir), patient_id="P100012").drop("computed_at")


@query
def str8_window_questions(spark, sf_dir):
    return an.window_queries(_gold(spark, sf_dir)).drop("query_id")


# quality gate


def _suite_rows(df, suite):
    return quality.suite_results(quality.with_age(df, fx.AS_OF), suite)


@query
def exp_suite_on_silver(spark, sf_dir):
    return _suite_rows(_silver(spark, sf_dir), quality.silver_suite(60 * 24 * 40))


@query
def exp_suite_on_bronze(spark, sf_dir):
    """Bronze still holds corrected readings, so its keys repeat; and it is too old."""
    suite = quality.silver_suite(60, freshness="newest", not_in_future=True)
    return _suite_rows(fx.bronze(spark, sf_dir), suite)


@query
def exp_suite_on_labels(spark, sf_dir):
    """The same expectations on another table, with nulls from a left join."""
    labels = fx.table(spark, sf_dir, "labels")
    joined = fx.table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    suite = [
        quality.row_count_between(1),
        quality.not_null("quality"),
        quality.unique("text"),
        quality.in_set("lang", ("en", "fr")),
        quality.between("toxic", 0, 0),
        quality.match_regex("source", "^src[0-4]$"),
        quality.column_max_between("n_chars", 0, 10_000),
    ]
    return quality.suite_results(joined, suite)


def _loads(spark, sf_dir):
    """Bronze over six days in three loads; corrections move to another day, some values are bad."""
    day = F.col("kafka_offset") % 6
    moved = F.timestamp_micros(F.unix_micros("recorded_at") + day * 86_400_000_000)
    odd = F.col("kafka_offset") % 97 == 0
    rows = fx.bronze(spark, sf_dir).withColumns(
        {"recorded_at": moved, "heart_rate": F.when(odd, 999).otherwise(F.col("heart_rate"))}
    )
    return [rows.filter(F.floor(day / 2) == load) for load in range(3)]


@query
def exp_stored_states(spark, sf_dir):
    """The suite after each of three loads of Silver, from states of the days each has touched."""
    settings = _fresh(spark)
    table = silver.silver_table(spark, settings)
    states = stored_gate.GateStates(table, settings.gate_path)
    found = []
    for load, rows in enumerate(_loads(spark, sf_dir)):
        table.upsert(silver.shape_silver(rows, fx.AS_OF))
        results = states.results(quality.silver_suite(60 * 24 * 40), fx.AS_OF)
        found.append(materialize(results.withColumn("load", F.lit(load))))
    return reduce(DataFrame.unionByName, found)


def _label_suite():
    return [quality.unique("text"), quality.in_set("lang", ("en", "fr")), quality.between("toxic", 0, 0)]


@query
def exp8_failure_samples(spark, sf_dir):
    """The unexpected values that a failing gate shows."""
    labels = fx.table(spark, sf_dir, "labels")
    joined = fx.table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    found = quality.failure_samples(joined, _label_suite(), [1, 2, 3])
    return found.select("position", "rank", F.md5("value").alias("digest"))


def _gate_rows(spark, sf_dir):
    """Two gate runs over Bronze, which fails, kept as results and read back."""
    settings = _fresh(spark)
    for freshness in ("newest", "oldest"):
        quality.run_silver_quality_gate(
            fx.bronze(spark, sf_dir), max_age_minutes=60, freshness=freshness, not_in_future=True,
            as_of=fx.AS_OF, raise_on_failure=False, results_path=settings.quality_path,
        )
    return quality.read_results(spark, settings.quality_path)


@query
def snk5_gate_results(spark, sf_dir):
    return _gate_rows(spark, sf_dir).select("evaluated_at", "success", "statistics.*")


@query
def exp9_gate_failures(spark, sf_dir):
    failures = _gate_rows(spark, sf_dir).select(F.inline("failures"))
    return failures.select("expectation", "column", "unexpected_count")


# text


@query
def str1_tokens(spark, sf_dir):
    tokens = tx.tokens(F.col("text"))
    return fx.texts(spark, sf_dir).select(
        "doc_id",
        F.size(tokens).alias("n_tokens"),
        F.md5(F.array_join(tokens, " ")).alias("digest"),
    )


@query
def str3_sections(spark, sf_dir):
    sections = section_rows(fx.pages_as_markdown(spark, sf_dir))
    return sections.select("doc_id", "position", "heading", F.md5("text").alias("digest"))


@query
def str5_sentences(spark, sf_dir):
    return fx.texts(spark, sf_dir).select(
        "doc_id",
        F.size(tx.sentences(F.col("text"))).alias("sentences"),
        F.md5(F.array_join(tx.sentences(F.col("text")), "|")).alias("digest"),
    )


@query
def str6_clean_sentences(spark, sf_dir):
    """Cleaned sentences of four words or more (FLT5), distinct over the corpus (SET2)."""
    raw = fx.texts(spark, sf_dir).select(
        F.explode(tx.sentences(F.col("text"))).alias("raw")
    )
    clean = raw.select(tx.clean_sentence(F.col("raw")).alias("sentence"))
    long = clean.filter(tx.word_count(F.col("sentence")) >= an.MIN_SENTENCE_WORDS)
    copies = long.groupBy("sentence").agg(F.count(F.lit(1)).alias("copies"))
    return copies.select(F.md5("sentence").alias("digest"), "copies")


@query
def ret1_chunks(spark, sf_dir):
    return fx.chunks(spark, sf_dir).select(
        "chunk_id", "doc_id", "ordinal", "heading", F.md5("text").alias("digest")
    )


@query
def str10_point_ids(spark, sf_dir):
    return fx.chunks(spark, sf_dir).select("chunk_id", uuid5(F.col("chunk_id")).alias("point_id"))


@query
def mth1_cosine_to_label_mean(spark, sf_dir):
    means = fx.label_means(spark, sf_dir).withColumnsRenamed(
        {"query_id": "label", "embedding": "mean"}
    )
    near = cosine(F.col("embedding"), F.col("mean"))
    return fx.vectors(spark, sf_dir).join(means, "label").select(
        "chunk_id", F.round(near, SHOWN).alias("cosine")
    )


# retrieval


@query
def agg7_index_size(spark, sf_dir):
    return retrieval.index_profile(fx.chunks(spark, sf_dir))


@query
def agg8_corpus_statistics(spark, sf_dir):
    stats = retrieval.term_statistics(fx.chunks(spark, sf_dir))
    return stats.corpus.select("n", F.round("avgdl", SHOWN).alias("avgdl"))


@query
def agg8_term_statistics(spark, sf_dir):
    terms = retrieval.term_statistics(fx.chunks(spark, sf_dir)).terms
    return terms.select("term", "df", F.round("idf", SHOWN).alias("idf"))


@query
def joi4_postings(spark, sf_dir):
    postings = retrieval.token_counts(fx.chunks(spark, sf_dir))
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("chunks"), F.sum("tf").alias("occurrences")
    )


def _shown(name: str):
    return F.round(name, SHOWN).alias(name)


def _shown_matches(found: DataFrame) -> DataFrame:
    return found.select("query_id", "chunk_id", _shown("score"), "rank")


@query
def ret3_dense_topk(spark, sf_dir):
    """The 20 vectors nearest to each label's mean vector."""
    means = fx.label_means(spark, sf_dir)
    return _shown_matches(retrieval.dense_search(means, fx.vectors(spark, sf_dir), 20))


def _cells(spark, sf_dir):
    """Every fiftieth vector as a question, the cells of all vectors, and the cells to probe."""
    vectors = materialize(fx.vectors(spark, sf_dir))
    asked = vectors.filter(F.col("chunk_id").cast("long") % 50 == 0)
    asked = asked.select(F.col("chunk_id").cast("long").alias("query_id"), "embedding")
    index = cells.build(vectors)
    return asked, index, cells.tuned_probes(asked, index, 20)


@query
def ret3_approximate_recall(spark, sf_dir):
    """Whether the approximate search finds nine tenths of what the exact one finds."""
    asked, index, probes = _cells(spark, sf_dir)
    exact = materialize(retrieval.dense_search(asked, index.rows, 20))
    share = cells.recall(cells.search(asked, index, 20, probes), exact)
    return asked.agg(F.count("*").alias("questions"), F.lit(share >= 0.9).alias("reached"))


@query
def ret4_bm25_topk(spark, sf_dir):
    index, postings = _index(spark, sf_dir)
    found = retrieval.bm25_search(fx.questions(spark, sf_dir), index, 20, postings)
    return _shown_matches(found)


@query
def ret5_rrf(spark, sf_dir):
    """Two rankings of each customer's orders, by price and by date, fused."""
    orders = fx.table(spark, sf_dir, "orders")

    def ranking(ranker, order):
        window = Window.partitionBy("o_custkey").orderBy(*order)
        return orders.select(
            F.col("o_custkey").alias("query_id"),
            F.lit(ranker).alias("ranker"),
            F.col("o_orderkey").alias("chunk_id"),
            F.row_number().over(window).alias("rank"),
        )

    rankings = ranking("price", [F.desc("o_totalprice"), "o_orderkey"]).unionByName(
        ranking("date", [F.desc("o_orderdate"), "o_orderkey"])
    )
    fused = retrieval.reciprocal_rank_fusion(rankings)
    return fused.withColumn("rrf_score", F.round("rrf_score", 8))


def _built(spark, sf_dir):
    index = materialize(retrieval.index_rows(fx.chunks(spark, sf_dir)))
    return index, ps.build(index)


_STORED: dict[tuple, tuple] = {}


def _index(spark, sf_dir):
    """The index, vectors and postings: searches read one that the session's first search stores.

    As in use, where an index is built once and searched often; ``ret0_index_build`` builds it anew.
    """
    files = sorted(fx.table(spark, sf_dir, "documents").inputFiles())
    key = (spark.sparkContext.applicationId, *files)
    if key not in _STORED:
        _STORED[key] = _built(spark, sf_dir)
    return _STORED[key]


@query
def ret0_index_build(spark, sf_dir):
    """Chunks, vectors and postings of all documents, built anew: what the index holds."""
    index, postings = _built(spark, sf_dir)
    return retrieval.index_profile(index).withColumns(
        {
            "terms": postings.terms.agg(F.count("*")).scalar(),
            "postings": postings.terms.agg(F.sum("df")).scalar(),
            "avgdl": postings.corpus.select(F.round("avgdl", SHOWN)).scalar(),
        }
    )


@query
def joi4_stored_postings(spark, sf_dir):
    """Postings written as a table of term buckets and read again."""
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    ps.write(fx.chunks(spark, sf_dir), path)
    rows = ps.read(spark, path).rows
    return rows.groupBy("term").agg(F.count("*").alias("chunks"), F.sum("tf").alias("occurrences"))


@query
def snk6_index_upsert(spark, sf_dir):
    """The index of half of the documents, then all of them upserted; as the table holds it."""
    table = run.index_table(spark, _fresh(spark))
    chunks = materialize(fx.chunks(spark, sf_dir))
    run.build_index(chunks.filter(F.col("doc_id").cast("long") % 2 == 0), table)
    run.build_index(chunks, table, recreate=False)
    return retrieval.index_profile(table.read())


@query
def mrg3_index_prune(spark, sf_dir):
    """All chunks indexed, then every document chunked anew to its first chunk only."""
    table = run.index_table(spark, _fresh(spark))
    chunks = materialize(fx.chunks(spark, sf_dir))
    run.build_index(chunks, table)
    run.build_index(chunks.filter("ordinal = 0"), table, recreate=False, prune=True)
    return table.read().select("point_id", "chunk_id", "doc_id")


def _hits(spark, sf_dir):
    index, postings = _index(spark, sf_dir)
    return retrieval.hybrid_search(fx.questions(spark, sf_dir), index, postings=postings)


@query
def ret6_hybrid_search(spark, sf_dir):
    hits = _hits(spark, sf_dir)
    return hits.select(
        "query_id",
        "chunk_id",
        F.round("rrf_score", 8).alias("rrf_score"),
        "dense_rank",
        "bm25_rank",
        "fused_rank",
    )


@query
def ret7_rerank(spark, sf_dir):
    (index, postings), questions = _index(spark, sf_dir), fx.questions(spark, sf_dir)
    pool = materialize(_hits(spark, sf_dir).filter(F.col("fused_rank") <= 12))
    pairs = an.candidate_pairs(questions, pool, index, 12)
    top = an.rerank(pairs, an.lexical_scorer(questions, postings), 5)
    return top.select("query_id", "marker", "chunk_id", _shown("score"))


def _answers(spark, sf_dir):
    index, postings = _index(spark, sf_dir)
    return an.answer_questions(
        fx.questions(spark, sf_dir), index, Settings(root=""), postings=postings
    )


@query
def ret8_answers(spark, sf_dir):
    return _answers(spark, sf_dir).select(
        "query_id", "refused", "answer", F.size("citations").alias("citations"),
        F.size("contexts").alias("contexts"), F.size("retrieval").alias("retrieved"),
    )


@query
def ret8_citations(spark, sf_dir):
    cited = _answers(spark, sf_dir).select("query_id", F.inline("citations"))
    return cited.select("query_id", "marker", "chunk_id", "title", "source", "rerank_score")


@query
def ret9_explained_windows(spark, sf_dir):
    """Guidance for every high-risk window; a low floor, as no document is clinical."""
    high = materialize(_gold(spark, sf_dir).filter(F.col("worst_risk_band") == "high"))
    index, postings = _index(spark, sf_dir)
    found = an.explain_gold_windows(
        high, index, Settings(root="", min_rerank_score=-4.0), postings=postings
    )
    return found.select("patient_id", "window_start", "query", "refused", "answer")


# streaming


def _fresh(spark) -> Settings:
    """Settings with a table folder of their own under the shared folder."""
    return Settings(root=f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}")


@query
def stm2_stream_ingest(spark, sf_dir):
    """The messages through the streaming path; Bronze as the stream left it."""
    settings = _fresh(spark)
    schema = fx.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    ingest.ingest_available(
        fx.messages_of(events),
        settings,
        as_of=fx.AS_OF,
        ingested_at=F.col("timestamp"),
        tasks=_cores(spark),
    )
    return silver.bronze_table(spark, settings).rows()


@query
def stm1_many_batches(spark, sf_dir):
    """The events as many files, drained in micro-batches of three files each."""
    settings = _fresh(spark)
    folder = f"{settings.root}/events"
    events = fx.table(spark, sf_dir, "events")
    events.repartition(12, "event_id").write.parquet(folder)
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 3)
    ingest.ingest_available(
        fx.messages_of(reader.parquet(folder)),
        settings,
        as_of=fx.AS_OF,
        ingested_at=F.col("timestamp"),
        tasks=_cores(spark),  # three files would be three tasks
    )
    return silver.bronze_table(spark, settings).rows()


@query
def stm5_out_of_order(spark, sf_dir):
    """The later load first: Silver still ends with the latest version of every reading."""
    settings = _fresh(spark)
    table = silver.bronze_table(spark, settings)
    for load, rows in enumerate(reversed(_halves(spark, sf_dir))):
        table.append(rows, f"load-{load}")
        ingest.refresh_after(spark, settings, fx.AS_OF, f"load-{load}")
    return silver.silver_table(spark, settings).read().drop("updated_at")


@query
def stm4_replayed_refresh(spark, sf_dir):
    """Each load refreshed twice, as after a lost commit; Gold as the tables hold it."""
    settings = _fresh(spark)
    table = silver.bronze_table(spark, settings)
    for load, rows in enumerate(_halves(spark, sf_dir)):
        table.append(rows, f"load-{load}")
        for _ in range(2):
            ingest.refresh_after(spark, settings, fx.AS_OF, f"load-{load}")
    return gold.gold_table(spark, settings).read().drop("computed_at")


@query
def stm4_incremental_gold(spark, sf_dir):
    """Two loads, each followed by an incremental refresh; Gold as the tables hold it."""
    settings = _fresh(spark)
    table = silver.bronze_table(spark, settings)
    for load, rows in enumerate(_halves(spark, sf_dir)):
        table.append(rows, f"load-{load}")
        ingest.refresh_after(spark, settings, fx.AS_OF)
    return gold.gold_table(spark, settings).read().drop("computed_at")


def _event_stream(spark, sf_dir):
    """The messages as a stream over the ``events`` table."""
    schema = fx.table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return fx.messages_of(reader.parquet(sf_dir))


def _cores(spark) -> int:
    """Tasks for messages whose file has few row groups."""
    return spark.sparkContext.defaultParallelism


def _stage_counts(spark, settings):
    """Stages of a run from its lineage: status, events, and each count they left."""
    events = lineage.read_events(spark, settings.lineage_path)
    counts = events.filter("run.facets.outputStatistics is not null").select(
        F.col("job.name").alias("job"), F.explode("run.facets.outputStatistics").alias("counted", "n")
    )
    return (
        lineage.run_summary(events)
        .join(counts, "job", "left")
        .select("parent_run_id", "job", "status", "events", "counted", "n")
    )


@query
def pip1_full_run(spark, sf_dir):
    """All five stages as one run on the event stream, with every document indexed."""
    settings = dataclasses.replace(_fresh(spark), max_age_minutes=60 * 24 * 40)
    events, documents = _event_stream(spark, sf_dir), fx.documents(spark, sf_dir)
    run.run_pipeline(spark, settings, events, "full-run", fx.AS_OF, documents=documents, tasks=_cores(spark))
    return _stage_counts(spark, settings)


@query
def pip2_staged_run(spark, sf_dir):
    """Ingest, Silver, a gate that fails, and Gold as stages of one run."""
    settings = _fresh(spark)
    steps = lineage.Lineage(spark, settings, "staged-run")
    run.stage_ingest(steps, _event_stream(spark, sf_dir), fx.AS_OF, tasks=_cores(spark))
    run.stage_build_silver(steps, fx.AS_OF)
    with contextlib.suppress(quality.QualityGateError):
        run.stage_quality_gate(steps, fx.AS_OF)
    run.stage_build_gold(steps, fx.AS_OF)
    return _stage_counts(spark, settings)


@contextlib.contextmanager
def _environment(**values: str):
    before = {name: os.environ.get(name) for name in values}
    os.environ.update(values)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                del os.environ[name]
            else:
                os.environ[name] = value


@query
def pip4_run_datasets(spark, sf_dir):
    """Two stages under the scheduler's run id: the datasets each names, and the rows it counted there."""
    settings = dataclasses.replace(_fresh(spark), kafka_servers="broker:9092")
    with _environment(PIPELINE_RUN_ID="scheduled-run"):
        steps = lineage.Lineage(spark, settings)
    run.stage_ingest(steps, _event_stream(spark, sf_dir), fx.AS_OF, tasks=_cores(spark))
    run.stage_build_silver(steps, fx.AS_OF)
    events = lineage.read_events(spark, settings.lineage_path).filter("eventType = 'COMPLETE'")
    counted = F.coalesce(
        F.col("run.facets.outputStatistics")["consumed"], F.col("run.facets.outputStatistics")["source_rows"]
    )
    sides = F.map_from_arrays(F.array(F.lit("input"), F.lit("output")), F.array("inputs", "outputs"))
    told = events.select(
        F.col("run.facets.parent.run.runId").alias("parent_run_id"),
        F.col("run.facets.parent.job").alias("owner"),
        F.col("job.name").alias("job"),
        counted.alias("counted"),
        F.explode(sides).alias("side", "datasets"),
    )
    return told.select("*", F.explode("datasets").alias("dataset")).select(
        "parent_run_id", "job", "counted", "side",
        F.concat_ws("/", "owner.namespace", "owner.name").alias("owner"),
        F.col("dataset.namespace").alias("namespace"),
        F.replace("dataset.name", F.lit(settings.root), F.lit("")).alias("dataset"),
    )


@query
def pip2_halted_run(spark, sf_dir):
    """The whole run with readings too old for the gate: it raises, and what follows never starts."""
    settings = dataclasses.replace(_fresh(spark), corpus_dir=sf_dir)
    with contextlib.suppress(quality.QualityGateError):
        run.run_pipeline(spark, settings, _event_stream(spark, sf_dir), "halted-run", fx.AS_OF)
    later = gold.gold_table(spark, settings).exists() or run.index_table(spark, settings).exists()
    return _stage_counts(spark, settings).withColumn("went_on", F.lit(later))


# lineage


@query
def src6_stage_events(spark, sf_dir):
    """Stage events written as an event table, read back and summed up."""
    path = _fresh(spark).lineage_path
    fx.lineage_events(spark, sf_dir).write.json(path)
    return lineage.run_summary(lineage.read_events(spark, path))


@query
def agg10_run_summary(spark, sf_dir):
    events = fx.lineage_events(spark, sf_dir)
    return lineage.run_summary(events)


@query
def agg10_events_per_run(spark, sf_dir):
    return lineage.events_per_run(fx.lineage_events(spark, sf_dir))
