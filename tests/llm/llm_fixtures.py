"""Small tables with every awkward case, and plain versions of shared definitions."""

from __future__ import annotations

import re

from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"

ODD_TEXTS = [
    "",
    "   ",
    "don't 's ''s x's't  'll we'RE 'Sam",
    "a<|endoftext|>b <|endoftext|><|endoftext|>",
    "\n\n a\t b \x1c\x1f\x85  x　y",
    "½² ①a 3٣ 12,345.6",
    "é a​b 👍🏽👩‍👩‍👧",
    "\x00a\x00 \x00",
]

LONG = "word secret of a very long text " * 3000

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names the operators use inside
        T.StructField("row", T.StringType()),
        T.StructField("found", T.LongType()),
        T.StructField("fp", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("host", T.LongType()),
        T.StructField("key", T.LongType()),
    ]
)

CLASHING = ("row", 1, "fp", "id", 2, 3)


def frame(spark, rows):
    """Documents from (doc_id, text, lang, source), with the clashing columns."""
    full = [(*r, None if r[1] is None else len(r[1]), *CLASHING) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def documents(spark):
    rows = [(10 + k, text, "en", "src0") for k, text in enumerate(ODD_TEXTS)]
    rows += [
        (1, None, None, None),
        (2, LONG, "en", "src0"),
        (3, "the same row twice", "en", "src1"),
        (3, "the same row twice", "en", "src1"),
        (None, "a row without a key", "en", "src1"),
    ]
    return frame(spark, rows)


def words(text):
    """Words of a text by the contract's pattern, A-Z lowered."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
