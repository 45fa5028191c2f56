"""Hashed terms of texts as sparse features, and a bounded labelled sample to learn from."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.llm.batches import Words, mixed, pieces, raw, span_hashes

# Features are hashed into this many bits.
HASH_BITS = 18

# Bytes of the word beginnings that are features beside whole words (inflected forms share one).
BEGINNING = 5

# Squared deviation, in standard errors, that a term must reach: few do by chance.
LEAST_SCORE = 15.0

_SALT = {"beginning": np.uint64(0xA24BAED4963EE407), "shape": np.uint64(0x9FB21C651E98DF25)}

_REPEATED = 0  # bucket of repeated tokens

# Shapes: letters by case, digits, every other byte as it is, white space between tokens.
SHAPE_BYTES = np.arange(256, dtype=np.uint8)
SHAPE_BYTES[0x41:0x5B], SHAPE_BYTES[0x61:0x7B], SHAPE_BYTES[0x80:] = 0x41, 0x61, 0x61
SHAPE_BYTES[0x30:0x3A] = 0x30
for _b in (0x20, *range(0x09, 0x0E)):
    SHAPE_BYTES[_b] = 0


def _buckets(hashes: np.ndarray, salt: str = "") -> np.ndarray:
    if salt:
        hashes = mixed(hashes ^ _SALT[salt])
    return (hashes >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def features(texts: pa.Array, chosen: np.ndarray | None = None, shapes: bool = False):
    """(row, feature, value) of a piece, by row and feature, and the number of rows.

    Words and word beginnings count by presence, the shapes of token endings by their share of
    the row's tokens.  ``chosen`` renumbers the buckets and leaves out those below zero.
    """
    data, rows = raw(texts)
    words = Words(data, rows)
    of = words.rows()
    long = np.flatnonzero(words.ends - words.starts > BEGINNING)
    starts = words.starts[long]
    beginnings = words.hashes(starts, starts + BEGINNING)
    row = np.concatenate([of, of[long]])
    bucket = np.concatenate([_buckets(words.hashes()), _buckets(beginnings, "beginning")])
    if chosen is not None:
        bucket = chosen[bucket]
        row, bucket = row[bucket >= 0], bucket[bucket >= 0]
    found = np.unique(row << HASH_BITS | bucket)
    row, bucket = found >> HASH_BITS, found & ((1 << HASH_BITS) - 1)
    value = np.ones(len(row))
    if shapes:
        tokens = Words(data, rows, SHAPE_BYTES)
        of = tokens.rows()
        hashes = span_hashes(data, tokens.starts, tokens.ends)
        endings = _buckets(
            tokens.hashes(np.maximum(tokens.starts, tokens.ends - 3), tokens.ends), "shape"
        )
        total = np.diff(tokens.bounds)
        # a token that repeats the one before it counts as a shape of its own
        same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])) + 1
        endings = np.concatenate([endings, np.full(len(same), _REPEATED)])
        of = np.concatenate([of, of[same]])
        if chosen is not None:
            endings = chosen[endings]
            of, endings = of[endings >= 0], endings[endings >= 0]
        found, count = np.unique(of << HASH_BITS | endings, return_counts=True)
        more = found >> HASH_BITS
        row = np.concatenate([row, more])
        bucket = np.concatenate([bucket, found & ((1 << HASH_BITS) - 1)])
        value = np.concatenate([value, count / total[more]])
        order = np.argsort(row, kind="stable")
        row, bucket, value = row[order], bucket[order], value[order]
    return row, bucket, value, len(texts)


class Sample:
    """Feature rows of a labelled sample: sparse, with a class and a weight each."""

    def __init__(self, table: pa.Table):
        lists = table.column("buckets").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        self.bucket = lists.flatten().to_numpy().astype(np.int64)
        self.value = table.column("shares").combine_chunks().flatten().to_numpy()
        self.label = table.column("label").to_numpy().astype(np.int64)
        self.weight = table.column("weight").to_numpy()
        self.n = len(sizes)

    def choose(self, most: int, support: int) -> np.ndarray:
        """Renumbering of the buckets whose values differ most between the classes."""
        size = 1 << HASH_BITS
        score = np.zeros(size)
        seen = np.bincount(self.bucket, minlength=size)
        square = np.bincount(self.bucket, self.value**2, size)
        mean = np.bincount(self.bucket, self.value, size) / max(1, self.n)
        spread = np.maximum(square / max(1, self.n) - mean**2, 1e-12)
        for label in np.unique(self.label):
            own = self.label == label
            n = int(own.sum())
            at = own[self.row]
            inside = np.bincount(self.bucket[at], self.value[at], size) / n
            score = np.maximum(score, (inside - mean) ** 2 * n / spread)
        score[(seen < support) | (score < LEAST_SCORE)] = 0
        best = np.argsort(-score, kind="stable")[:most]
        best = np.sort(best[score[best] > 0])
        chosen = np.full(size, -1, np.int32)
        chosen[best] = np.arange(len(best))
        return chosen

    def reduced(self, chosen: np.ndarray):
        """(row, feature, value) of the chosen buckets."""
        feature = chosen[self.bucket]
        keep = feature >= 0
        return self.row[keep], feature[keep].astype(np.int64), self.value[keep]


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the key's text, modulo 5, is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def first_by_hash(rows: DataFrame, group: str, most: int) -> tuple[DataFrame, dict]:
    """At most ``most`` distinct (key, group) rows of each group by the hash of the key.

    Also returns how many rows each group has; groups are classes or languages, so few.  Only
    rows below a hash that some twice as many pass are ranked, so no task gets a whole group.
    """
    totals = {r[0]: r[1] for r in rows.groupBy(group).agg(F.count("*")).collect()}
    share = F.lit(1.0)
    for value, n in totals.items():
        if n > 2 * most:
            share = F.when(F.col(group) == value, 2 * most / n).otherwise(share)
    low = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < share * (1 << 30)
    order = Window.partitionBy(group).orderBy(F.xxhash64("key"), "key")
    ranked = rows.filter(low).select("key", group).distinct()
    ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("key", group), totals


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label: Column,
    per_class: int,
    shapes: bool,
    key: str = "doc_id",
    text: str = "text",
) -> Sample:
    """At most ``per_class`` labelled rows of each class, by the hash of their key.

    Held-out rows and rows without a key or class stay away.  A row weighs as many as it stands
    for, so that the classes keep their proportions.  The feature lists of the sample come to the
    driver, its texts do not.
    """
    rows = (
        labels.select(F.col(key).alias("key"), label.cast("int").alias("label"))
        .dropna()
        .filter(~held_out(F.col("key")))
        .distinct()
    )
    taken, totals = first_by_hash(rows, "label", per_class)
    # the sample is bounded by per_class, so this broadcast is; a key that many rows share
    # counts once
    joined = (
        docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
        .join(F.broadcast(taken), "key")
        .groupBy("key", "label")
        .agg(F.min("text").alias("text"))
    )
    table = joined.select("label", "text").mapInArrow(
        _lists(shapes), "label int, buckets array<int>, shares array<float>"
    )
    found = table.toArrow()
    counts = {k: 0 for k in totals}
    for x in found.column("label").to_pylist():
        counts[x] += 1
    weight = [totals[x] / counts[x] for x in found.column("label").to_pylist()]
    total = max(1.0, sum(weight))
    return Sample(found.append_column("weight", pa.array([w * len(weight) / total for w in weight], pa.float64())))


def _lists(shapes: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for texts in pieces(batch.column(1)):
                row, bucket, value, n = features(texts, None, shapes)
                ends = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, n),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(value.astype(np.float32))),
                    ],
                    ["label", "buckets", "shares"],
                )
                start += n

    return run


def adam(parameters: list[np.ndarray], gradient: Callable, steps: int, rate: float) -> None:
    """Minimise in place; ``gradient`` returns the derivative by each parameter."""
    first = [np.zeros_like(p) for p in parameters]
    second = [np.zeros_like(p) for p in parameters]
    for t in range(1, steps + 1):
        for p, g, m, v in zip(parameters, gradient(), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
