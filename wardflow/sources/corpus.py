"""Guideline corpus: Markdown files with a small front-matter block."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions import text as tx


def parse_documents(files: DataFrame) -> DataFrame:
    """``(doc_id, value)`` raw files -> ``doc_id, title, source, topic, body``."""
    raw = F.regexp_replace("value", "\r\n?", "\n")
    block = tx.front_matter(F.col("_raw"))
    return (
        files.withColumn("_raw", raw)
        .withColumn("_block", block)
        .select(
            "doc_id",
            F.coalesce(tx.front_matter_value(F.col("_block"), "title"), "doc_id").alias("title"),
            F.coalesce(tx.front_matter_value(F.col("_block"), "source"), F.lit("unknown")).alias(
                "source"
            ),
            F.coalesce(tx.front_matter_value(F.col("_block"), "topic"), F.lit("")).alias("topic"),
            tx.strip(tx.without_front_matter(F.col("_raw"))).alias("body"),
        )
    )


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """All ``*.md`` files of a folder but the readme; ``doc_id`` is the file name's stem.

    Row order is not defined; later steps order by ``doc_id`` and ordinal, which is the
    order of the sorted file names.
    """
    files = (
        spark.read.option("pathGlobFilter", "*.md")
        .text(path, wholetext=True)
        .withColumn("_name", F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))))
        .filter(F.lower("_name") != "readme.md")
        .select(F.regexp_replace("_name", r"\.md$", "").alias("doc_id"), "value")
    )
    return parse_documents(files)
