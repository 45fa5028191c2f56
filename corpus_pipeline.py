"""A training corpus from raw documents, in five stages.

1. language ID: documents in no known language go;
2. SimHash near-dedup: one document of each group stays;
3. benchmark decontamination: documents that hold a window of a benchmark item go;
4. secret scans: secrets are masked in the texts, ``n_chars`` follows;
5. BPE: each remaining text as ids (binary, 32-bit little-endian) beside all its columns, with the
   digests of ids and of the text decoded from them.

Every stage but the last returns the columns of ``documents``.  SQL can express neither the
language models nor the fingerprints, so ``ORACLE_SQL`` is None and the stages are tested against
brute-force versions.  Null and empty texts are rejected by the first stage; an empty table passes
through; rows that repeat collapse to one in the second.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import bpe, decontaminate, language, secrets, simhash
from wardflow.llm.batches import ready, table
from wardflow.session import shared_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identify(docs).filter("kept").select("doc.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = docs.withColumn("text", secrets.redact(F.col("text")))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.with_ids(docs, TOKENIZER)


def _stage(fn):
    return lambda spark, docs, sf_dir: fn(ready(spark), docs, sf_dir)


STAGES = [
    ("language ID", _stage(known_language)),
    ("SimHash near-dedup", _stage(one_of_each_group)),
    ("benchmark decontamination", _stage(without_benchmark)),
    ("secret scans", _stage(without_secrets)),
    ("BPE encoding and decoding", _stage(encoded)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again as the next one's input."""
    docs = table(ready(spark), sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
