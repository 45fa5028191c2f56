"""Benchmark decontamination: which documents hold windows of benchmark items.

A window is ``WINDOW`` consecutive words of an item, or all words of a shorter one.  A document
contains a window only if it contains every shingle of it, so one necessary shingle is enough to
find it: shingles are ordered by how often the corpus has them, and each window is joined by its
rarest.  A candidate is kept only if enough words lie before and after it (positional and length
bounds), and is then verified word by word.

Two passes read the corpus: the first counts the benchmark's shingles in it, the second emits the
places of rarest shingles with the few words around them.  Which shingles matter is known to the
tasks from a bitmap of fixed size (2 MB whatever the benchmark's size); what it lets through by
chance the joins drop.

A null text has no words.  An item without words, id or text takes part in nothing.  Repeated
documents are rows of their own; repeated items count once.  An empty benchmark leaves every
document clean, and an empty corpus gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.llm.batches import WORD_TABLE, Words, pieces, raw, shingle_hashes
from wardflow.session import materialize

WINDOW = 10
SHINGLE = 3

# Bits of the shingle bitmap: a fixed 2 MB.
BITMAP_BITS = 24


def _item_windows(window: int, shingle: int) -> Callable:
    """Rows of (item, text) to rows of (item, window, length, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, texts = batch.column(0), batch.column(1)
            out: tuple[list, ...] = ([], [], [], [])
            for row, text in zip(items.to_pylist(), texts.to_pylist(), strict=True):
                plain = text.encode()
                words = plain.translate(WORD_TABLE).split()
                found = Words(np.frombuffer(plain, np.uint8), np.array([0, len(plain)]))
                hashes = found.hashes()
                size = min(window, len(words))
                k = min(shingle, size)
                shingles = shingle_hashes(hashes, k).view(np.int64) if k else []
                for at in range(len(words) - size + 1 if words else 0):
                    out[0].append(row)
                    out[1].append(b" ".join(words[at : at + size]).decode())
                    out[2].append(size)
                    out[3].append(shingles[at : at + size - k + 1].tolist())
            kinds = (pa.string(), pa.string(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                ["item", "window", "length", "shingles"],
            )

    return run


def _bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """Bitmap over the top bits of the hashes: at most 2^18 words come to the driver."""
    places = hashes.select(F.shiftrightunsigned(column, 64 - BITMAP_BITS).alias("place"))
    words = (
        places.select(
            F.shiftright("place", 6).alias("word"),
            F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit"),
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .collect()
    )
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for row in words:
        out[row.word] = row.bits
    return out.view(np.uint8)


def _in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = (hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _places(words: Words, hashes: np.ndarray, size: int, bitmap: np.ndarray):
    """Places and hashes of shingles that pass the bitmap and lie within one row."""
    shingles = shingle_hashes(hashes, size)
    at = np.flatnonzero(_in_bitmap(bitmap, shingles))
    row = np.searchsorted(words.bounds, at, "right") - 1
    inside = at + size <= words.bounds[row + 1]
    return at[inside], row[inside], shingles[at[inside]]


def _counts(bitmap, sizes: list[int]) -> Callable:
    """Texts to (shingle, how often), summed within a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            found = []
            for texts in pieces(batch.column(0)):
                words = Words(*raw(texts))
                hashes = words.hashes()
                found += [_places(words, hashes, k, bits)[2] for k in sizes]
            if found:
                values, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))],
                    ["shingle", "n"],
                )

    return run


def _candidates(bitmap, sizes: list[int], window: int) -> Callable:
    """(row, key, text) to a row of each text with its word count, and one of each place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        names = ["row", "key", "n_words", "shingle", "place", "before", "around"]
        for batch in batches:
            start = 0
            for texts in pieces(batch.column(2)):
                rows = batch.column(0).slice(start, len(texts))
                keys = batch.column(1).slice(start, len(texts))
                start += len(texts)
                words = Words(*raw(texts))
                hashes = words.hashes()
                counts = pa.array(np.diff(words.bounds).astype(np.int64))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string())
                nothing = [pa.nulls(len(texts), t) for t in kinds]
                yield pa.RecordBatch.from_arrays([rows, keys, counts, *nothing], names)
                found: list[tuple] = []
                for k in sizes:
                    for at, row, shingle in zip(*_places(words, hashes, k, bits), strict=True):
                        low, high = words.bounds[row], words.bounds[row + 1]
                        first, stop = max(low, at - window + 1), min(high, at + window)
                        around = words.text(first, stop)
                        found.append((row, shingle.view(np.int64), at - low, at - first, around))
                if found:
                    row, *rest = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.take(pa.array(row)),
                            pa.nulls(len(found), keys.type),
                            pa.nulls(len(found), pa.int64()),
                            *[pa.array(c, t) for c, t in zip(rest, kinds, strict=True)],
                        ],
                        names,
                    )

    return run


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    keys: list[str],
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows ``(row, key, n_words)``, places ``(row, first, stop, window)``, ``(item, window)``.

    ``key`` is a struct of the columns ``keys`` of a row; ``row`` numbers the rows.
    """
    spark = docs.sparkSession
    items = materialize(
        benchmark.select(F.col(item).cast("string"), F.col(item_text))
        .dropna()
        .mapInArrow(
            _item_windows(window, shingle),
            "item string, window string, length int, shingles array<long>",
        )
        .dropDuplicates(["item", "window"])
    )
    windows = items.select("window", "length", "shingles").dropDuplicates(["window"])
    sizes = sorted(
        r.k for r in items.select(F.least("length", F.lit(shingle)).alias("k")).distinct().collect()
    )  # at most ``shingle`` values
    each = windows.select("window", "length", F.posexplode("shingles").alias("offset", "shingle"))

    bitmap = spark.sparkContext.broadcast(_bitmap(each, "shingle"))
    counts = (
        docs.select(text)
        .mapInArrow(_counts(bitmap, sizes), "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
    )
    ranked = each.join(counts, "shingle", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = materialize(
        ranked.groupBy("window", "length")
        .agg(F.min(F.struct("n", "shingle", "offset")).alias("least"))
        .select("window", "length", "least.shingle", "least.offset")
    )

    chosen = spark.sparkContext.broadcast(_bitmap(rarest, "shingle"))
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[F.col(k) for k in keys]).alias("key"),
        F.col(text).alias("text"),
    )
    kind = numbered.schema["key"].dataType.simpleString()
    found = materialize(
        numbered.mapInArrow(
            _candidates(chosen, sizes, window),
            f"row long, key {kind}, n_words long, shingle long, place long, before int, "
            "around string",
        )
    )
    words, first = F.split("around", " "), F.col("before") - F.col("offset")
    places = (
        found.filter(F.col("shingle").isNotNull())
        .join(rarest, "shingle")
        .filter(first >= 0)
        .filter(F.size(words) - first >= F.col("length"))
        .filter(
            F.array_join(F.slice(words, F.greatest(first, F.lit(0)) + 1, F.col("length")), " ")
            == F.col("window")
        )
        .select(
            "row",
            (F.col("place") - F.col("offset")).alias("first"),
            (F.col("place") - F.col("offset") + F.col("length")).alias("stop"),
            "window",
        )
        .distinct()
    )
    rows = found.filter(F.col("n_words").isNotNull()).select("row", "key", "n_words")
    return rows, materialize(places), items.select("item", "window")


def hit_words(places: DataFrame) -> DataFrame:
    """Number of words of each row that lie in any place."""
    before = Window.partitionBy("row").orderBy("first", "stop").rowsBetween(
        Window.unboundedPreceding, -1
    )
    spans = places.select("row", "first", "stop").distinct()
    reached = F.coalesce(F.max("stop").over(before), F.col("first"))
    return (
        spans.withColumn("new", F.greatest(F.lit(0), F.col("stop") - F.greatest("first", reached)))
        .groupBy("row")
        .agg(F.sum("new").alias("n_hit"))
    )


def item_sets(places: DataFrame, items: DataFrame) -> DataFrame:
    """The items whose windows a row holds, as strings in order."""
    return (
        places.select("row", "window")
        .distinct()
        .join(items, "window")
        .select("row", "item")
        .distinct()
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )


def contamination(docs: DataFrame, benchmark: DataFrame, keys: list[str], **names) -> DataFrame:
    """Per row: the columns ``keys``, n_words, n_hit and items (strings in order)."""
    rows, places, items = matches(docs, benchmark, keys, **names)
    return (
        rows.join(hit_words(places), "row", "left")
        .join(item_sets(places, items), "row", "left")
        .select(
            "key.*",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no window, with all their columns.

    Rows are told apart by key and text, so one key may stand on clean and on other texts.
    """
    rows = docs.select(
        F.struct("*").alias("whole"),
        F.col(key).alias("id"),
        F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest"),
        F.col(text).alias("text"),
    )
    found, places, _ = matches(rows, benchmark, ["id", "digest"])
    held = places.select("row").distinct()
    bad = found.join(held, "row").select(
        F.col("key.id").alias("bad"), F.col("key.digest").alias("bad_digest")
    )
    same = F.col("id").eqNullSafe(F.col("bad")) & F.col("digest").eqNullSafe(F.col("bad_digest"))
    return rows.join(bad.distinct(), same, "left_anti").select("whole.*")
