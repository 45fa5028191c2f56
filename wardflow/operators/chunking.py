"""Documents to chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions import text as tx
from wardflow.schemas import CHUNK
from wardflow.sources.corpus import read_corpus


def section_rows(documents: DataFrame, keep_preamble: bool = False) -> DataFrame:
    """One row per section: doc_id, position, heading, text."""
    return documents.select(
        "doc_id", F.posexplode(tx.sections(F.col("body"), keep_preamble)).alias("position", "s")
    ).select("doc_id", "position", "s.heading", "s.text")


def chunk_documents(
    documents: DataFrame,
    *,
    window: int = tx.WINDOW_WORDS,
    overlap: int = tx.OVERLAP_WORDS,
    keep_preamble: bool = False,
    drop_empty: bool = False,
) -> DataFrame:
    """``doc_id, title, source, topic, body`` -> chunk rows.

    A document is one row, so its sections, windows and running ordinal are all made inside
    that row: no shuffle, and a document of any length stays with its own task only.
    """

    def pieces(section):
        return F.transform(
            tx.word_windows(section["text"], window, overlap),
            lambda piece: F.struct(section["heading"].alias("heading"), piece.alias("text")),
        )

    chunks = F.flatten(F.transform(tx.sections(F.col("body"), keep_preamble), pieces))
    out = documents.select(
        "doc_id", "title", "source", "topic", F.posexplode(chunks).alias("ordinal", "piece")
    ).select(
        F.concat_ws("::", "doc_id", "ordinal").alias("chunk_id"),
        "doc_id",
        "title",
        "source",
        "topic",
        "piece.heading",
        "ordinal",
        "piece.text",
    )
    if drop_empty:
        out = out.filter(F.col("text") != "")
    return out.select(*CHUNK.fieldNames())


def build_chunks(spark: SparkSession, corpus_dir: str) -> DataFrame:
    return chunk_documents(read_corpus(spark, corpus_dir))
