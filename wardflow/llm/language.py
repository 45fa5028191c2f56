"""Language identification by Bayesian fusion of evidence.

For each language the posterior adds the logarithms of: the text's likelihood under a byte-trigram
model, the likelihood of the declared markup language, the likelihood of the address suffix, and
the prior of the host.  Host priors are declared-language counts of each host, smoothed towards
those of its parent domain, and these towards the whole corpus, all by grouped aggregation.  One
more class, ``und``, takes texts that no model explains better than evenly spread trigrams.

Trigram models are learnt from at most ``PER_LANGUAGE`` rows of each declared language, by the
hash of their key; the counts of hosts cover all rows, and whole texts are scored.

A text without letters (null and empty ones too) is ``und`` and not kept.  A null, unknown or
missing declaration, suffix or host is no evidence.  Repeated rows have the same result, an empty
table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.batches import per_text, pieces, raw
from wardflow.llm.terms import first_by_hash
from wardflow.session import materialize

LANGUAGES = ("en", "de", "fr", "es")
UNKNOWN = "und"

PER_LANGUAGE = 2000
HASH_BITS = 16
SMOOTHING = 0.05

# Trigrams overlap, so a text counts as at most this many independent ones.
MOST_TRIGRAMS = 200

DECLARED_RIGHT = 0.95
SUFFIX_RIGHT = 0.9
HOST_STRENGTH = 20.0
UNKNOWN_PRIOR = 0.01
KEEP_PROBABILITY = 0.5

# Country suffixes of addresses and the language they speak for.
SUFFIXES = {"uk": "en", "us": "en", "ie": "en", "de": "de", "at": "de", "fr": "fr", "es": "es"}

# Letters by lower case; everything else is a separator.
_LETTERS = np.zeros(256, np.uint32)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams around each letter, and each row's first and past-last one."""
    data, rows = raw(texts)
    # a separator before every row, so that no trigram crosses from one to the next
    padded = np.insert(_LETTERS[data], rows, 0)
    padded = np.append(padded, np.uint32(0))
    at = np.flatnonzero(padded[1:-1]) + 1
    code = padded[at - 1] << np.uint32(16) | padded[at] << np.uint32(8) | padded[at + 1]
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - HASH_BITS)
    bounds = rows + np.arange(len(rows))
    return bucket, np.searchsorted(at, bounds[:-1]), np.searchsorted(at, bounds[1:])


def _counts(languages: tuple[str, ...]) -> Callable:
    """(language number, text) to trigram counts, summed within a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << HASH_BITS
        for batch in batches:
            total, start = np.zeros((len(languages), size), np.int64), 0
            for texts in pieces(batch.column(1)):
                language = batch.column(0).slice(start, len(texts)).to_numpy()
                start += len(texts)
                bucket, first, stop = trigrams(texts)
                of = np.repeat(language, stop - first).astype(np.int64)
                total += np.bincount(of * size + bucket, minlength=total.size).reshape(total.shape)
            language, bucket = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(language.astype(np.int32)),
                    pa.array(bucket.astype(np.int32)),
                    pa.array(total[language, bucket]),
                ],
                ["language", "bucket", "n"],
            )

    return run


def learn(
    docs: DataFrame,
    languages: tuple[str, ...] = LANGUAGES,
    key: str = "doc_id",
    text: str = "text",
    declared: str = "lang",
) -> np.ndarray:
    """Log probability of each trigram bucket under each language, ``und`` last."""
    number = F.array_position(F.array(*map(F.lit, languages)), F.lower(declared)) - 1
    rows = docs.select(
        F.col(key).alias("key"), number.cast("int").alias("language"), F.col(text).alias("text")
    ).filter("key is not null and language >= 0 and text is not null")
    taken, _ = first_by_hash(rows.select("key", "language"), "language", PER_LANGUAGE)
    # at most PER_LANGUAGE rows a language: a bounded broadcast
    counts = (
        rows.join(F.broadcast(taken), ["key", "language"], "left_semi")
        .select("language", "text")
        .mapInArrow(_counts(languages), "language int, bucket int, n long")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    size = 1 << HASH_BITS
    table = np.full((len(languages) + 1, size), SMOOTHING)
    at = counts.column("language").to_numpy(), counts.column("bucket").to_numpy()
    table[at] += counts.column("n").to_numpy()
    table[-1] = 1.0
    return np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def likelihoods(text: Column, model: Broadcast) -> Column:
    """Log likelihood of the text under each language and ``und``; null without letters."""

    def run(texts: pa.Array) -> pa.Array:
        table = model.value
        bucket, first, stop = trigrams(texts)
        n = stop - first
        out = np.zeros((len(texts), len(table)))
        for k, row in enumerate(table):
            sums = np.concatenate([[0.0], np.cumsum(row[bucket], dtype=np.float64)])
            out[:, k] = sums[stop] - sums[first]
        out *= (np.minimum(n, MOST_TRIGRAMS) / np.maximum(n, 1))[:, None]
        ends = np.arange(len(texts) + 1, dtype=np.int32) * out.shape[1]
        none = pa.array(n == 0)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()), mask=none)

    return per_text(run, "array<double>")(text)


def host_priors(
    docs: DataFrame, languages: tuple[str, ...] = LANGUAGES, declared: str = "lang", host: str = "source"
) -> DataFrame:
    """``host`` and ``prior``: log prior of each language, ``und`` last."""
    counts = [F.sum((F.lower(declared) == x).cast("long")) for x in languages]
    by_host = materialize(
        docs.filter(F.col(host).isNotNull())
        .groupBy(F.lower(host).alias("host"))
        .agg(F.array(*[F.coalesce(c, F.lit(0)) for c in counts]).alias("own"))
        .withColumn("_parent", F.regexp_replace("host", r"^[^.]*\.?", ""))
    )
    sums = [F.sum(F.col("own")[k]) for k in range(len(languages))]
    overall = by_host.agg(F.array(*sums).alias("all"))
    by_parent = by_host.groupBy("_parent").agg(F.array(*sums).alias("up"))

    def smoothed(own: Column, towards: Column) -> Column:
        total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
        return F.transform(
            F.zip_with(own, towards, lambda n, p: n + F.lit(HOST_STRENGTH) * p),
            lambda x: x / (total + F.lit(HOST_STRENGTH)),
        )

    even = F.array(*[F.lit(1 / len(languages))] * len(languages))
    # one row with the sums of the whole corpus
    whole = overall.select(smoothed(F.col("all"), even).alias("whole")).first()
    known = F.array(*[F.lit(x) for x in (whole.whole or [1 / len(languages)] * len(languages))])
    priors = by_host.join(by_parent, "_parent").withColumn(
        "share", smoothed(F.col("own"), smoothed(F.col("up"), known))
    )
    log = F.transform("share", lambda x: F.log(x * F.lit(1 - UNKNOWN_PRIOR)))
    return materialize(
        priors.select("host", F.concat(log, F.array(F.log(F.lit(UNKNOWN_PRIOR)))).alias("prior"))
    )


def _told(said: Column, languages: tuple[str, ...], right: float) -> Column:
    """Log likelihood of a statement that names a language; zeros where it names none."""
    n = len(languages)
    wrong = (1 - right) / (n - 1) if n > 1 else 1 - right
    each = [F.when(said == x, np.log(right).item()).otherwise(float(np.log(wrong))) for x in languages]
    nothing = F.array(*[F.lit(0.0)] * (n + 1))
    return F.when(said.isin(*languages), F.array(*each, F.lit(float(np.log(1 / n))))).otherwise(nothing)


def identified(
    docs: DataFrame,
    priors: DataFrame,
    model: Broadcast,
    languages: tuple[str, ...] = LANGUAGES,
    text: str = "text",
    declared: str = "lang",
    host: str = "source",
    suffix: Column | None = None,
) -> DataFrame:
    """The rows of ``docs`` in ``doc``, with ``language``, ``probability`` and ``kept``."""
    spoken = F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair])
    nothing = F.array(*[F.lit(0.0)] * (len(languages) + 1))
    said = [_told(F.lower(declared), languages, DECLARED_RIGHT)]
    if suffix is not None:
        said.append(_told(F.element_at(spoken, F.lower(suffix)), languages, SUFFIX_RIGHT))
    rows = docs.select(
        F.struct("*").alias("doc"),
        F.col(text).alias("text"),
        F.lower(host).alias("host"),
        F.array(*said).alias("said"),
    )
    total = F.zip_with("likely", F.coalesce("prior", nothing), lambda a, b: a + b)
    for k in range(len(said)):
        total = F.zip_with(total, F.col("said")[k], lambda a, b: a + b)
    names = F.array(*[F.lit(x) for x in (*languages, UNKNOWN)])
    best = F.element_at(names, F.array_position("total", F.col("best")).cast("int"))
    odds = F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best")))
    return (
        rows.join(priors, "host", "left")
        .withColumn("likely", likelihoods(F.col("text"), model))
        .withColumn("total", total)
        .withColumn("best", F.array_max("total"))
        .select(
            "doc",
            F.coalesce(best, F.lit(UNKNOWN)).alias("language"),
            F.coalesce(1 / odds, F.lit(1.0)).alias("probability"),
        )
        .withColumn(
            "kept",
            (F.col("language") != UNKNOWN) & (F.col("probability") >= KEEP_PROBABILITY),
        )
    )


def identify(
    docs: DataFrame,
    languages: tuple[str, ...] = LANGUAGES,
    key: str = "doc_id",
    text: str = "text",
    declared: str = "lang",
    host: str = "source",
    suffix: Column | None = None,
) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, languages, key, text, declared))
    priors = host_priors(docs, languages, declared, host)
    return identified(docs, priors, model, languages, text, declared, host, suffix)


def page_evidence(pages: DataFrame) -> DataFrame:
    """Evidence of web pages: visible text, declared language, host and address suffix."""
    bare = F.regexp_replace(F.col("html"), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    host = F.lower(F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1))
    return pages.select(
        "page_id",
        F.regexp_replace(bare, r"<[^>]*>", " ").alias("text"),
        F.regexp_extract("html", r"""(?i)<html[^>]*\blang=["']?([a-z]{2})""", 1).alias("lang"),
        host.alias("source"),
        F.regexp_extract(host, r"\.([a-z]+)$", 1).alias("suffix"),
    )


def identify_pages(pages: DataFrame) -> DataFrame:
    """``identify`` over all evidence of web pages; models and hosts are those of the pages."""
    return identify(page_evidence(pages), key="page_id", suffix=F.col("suffix"))
