"""SimHash near-duplicates: fingerprints, links of few differing bits, components.

A fingerprint is mapped to the bit counts of its 32 two-bit segments.  The Manhattan distance of
two such count vectors is a lower bound of the number of differing bits, so fingerprints that
differ in at most ``MAX_BITS`` = 3 lie within 3 of each other in that space.  With the segments
dealt into five blocks, at most three blocks can differ, and any such pair has equal counts in
two whole blocks: the grid cells of the ten pairs of blocks find every pair.  Within a cell the
Manhattan bound is tested first, then the bits themselves.

Rows that share a fingerprint are joined before the search, so copies cost nothing there.  A
cell with many fingerprints is split into tiles, each pair of tiles a group of its own, and a
group emits a spanning forest of its links, not all of them: every link between different
fingerprints is represented, by itself or by a path of links.

Null and empty texts have fingerprint 0 and are linked like any other.  Repeated rows are rows of
their own with the same fingerprint.  A null key takes no part in the smallest key of a component;
``component_id`` is null where all keys are.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.batches import per_text
from wardflow.llm.components import components
from wardflow.session import materialize

MAX_BITS = 3
SHINGLE = 3
SEED = 42

# Segments (of two bits) in each block of the grid.
BLOCKS = (7, 7, 6, 6, 6)

# Fingerprints of a cell that are compared in one group; larger cells are split into tiles.
TILE = 2048

_FIRST = np.uint64(0x5555555555555555)


def fingerprint(text: bytes) -> int:
    """SimHash of the text's word shingles, unsigned."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes) - 1
        starts = (ends + 1 - sizes)[: 1 - SHINGLE].tolist()
        digest = partial(xxhash.xxh64_intdigest, seed=SEED)
        spans = zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)
        hashes = [digest(line[a:b]) for a, b in spans]
    hashes = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[k : k + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column) -> Column:
    """Fingerprint of a text as a signed 64-bit integer."""

    def many(texts: pa.Array) -> pa.Array:
        found = [fingerprint(t) for t in texts.cast(pa.binary()).to_pylist()]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return per_text(many, "long")(text)


def segment_counts(x: Column) -> Column:
    """Bit counts (0 to 2) of the 32 segments, two bits each."""
    low, high = F.lit(int(_FIRST)).cast("long"), F.shiftrightunsigned(x, 1)
    two, one = x.bitwiseAND(high).bitwiseAND(low), x.bitwiseXOR(high).bitwiseAND(low)
    return F.shiftleft(two, 1).bitwiseOR(one)


def _masks() -> list[int]:
    """Which counts each cell key holds: two whole blocks."""
    blocks, at = [], 0
    for size in BLOCKS:
        blocks.append(((1 << 2 * size) - 1) << at)
        at += 2 * size
    return [a | b for a, b in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether fingerprints differ in at most MAX_BITS bits; the Manhattan bound comes first."""
    differ = a ^ b
    # segments 01 and 10 have equal counts though both bits differ
    swapped = differ & (differ >> np.uint64(1)) & _FIRST & (a ^ (a >> np.uint64(1)))
    bits = np.bitwise_count(differ).astype(np.int8)
    manhattan = bits - 2 * np.bitwise_count(swapped).astype(np.int8)
    return (manhattan <= MAX_BITS) & (bits <= MAX_BITS)


def _forest(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect whatever ``close`` connects within one group."""
    links, left = [], np.arange(len(x))
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            node = frontier.pop()
            hit = close(x[left], x[node])
            if hit.any():
                reached, left = left[hit], left[~hit]
                links.append((np.full(len(reached), x[node]), x[reached]))
                frontier.extend(reached.tolist())
    return links


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal cells; rows come sorted by cell."""
    held_cell, held = np.zeros((3, 0), np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        cell = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
        cell = np.concatenate([held_cell, cell], axis=1)
        x = np.concatenate([held, batch.column(3).to_numpy().astype(np.int64).view(np.uint64)])
        if len(x) == 0:
            continue
        # the last cell may go on in the next batch
        others = np.flatnonzero((cell != cell[:, -1:]).any(axis=0))
        stop = int(others[-1]) + 1 if len(others) else 0
        yield from _grouped(cell[:, :stop], x[:stop])
        held_cell, held = cell[:, stop:], x[stop:]
    yield from _grouped(held_cell, held)


def _grouped(cell: np.ndarray, x: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(x) < 2:
        return
    new = np.r_[True, (cell[:, 1:] != cell[:, :-1]).any(axis=0)]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.r_[starts, len(x)])
    found = []
    # small cells side by side: every row against the row d after it
    few = np.repeat(sizes <= 16, sizes)
    run = np.repeat(np.arange(len(starts)), sizes)
    at = np.flatnonzero(few)
    for d in range(1, 16):
        at = at[at + d < len(x)]
        at = at[run[at] == run[at + d]]
        if len(at) == 0:
            break
        hit = at[close(x[at], x[at + d])]
        found.append((x[hit], x[hit + d]))
    for k in np.flatnonzero(sizes > 16).tolist():
        found += _forest(x[starts[k] : starts[k] + sizes[k]])
    if found:
        a, b = (np.concatenate([f[k] for f in found]).view(np.int64) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def links(prints: DataFrame, column: str = "fp") -> DataFrame:
    """Links ``(a, b)``, a < b, that connect the distinct fingerprints as all close pairs do."""
    counts = segment_counts(F.col(column))
    keys = [
        F.struct(F.lit(k).alias("grid"), counts.bitwiseAND(F.lit(_signed(m)).cast("long")).alias("cell"))
        for k, m in enumerate(_masks())
    ]
    cells = prints.select(F.col(column).alias("fp"), F.explode(F.array(*keys)).alias("key")).select(
        "key.grid", "key.cell", "fp"
    )
    # cells of more than a tile: their number is bounded by rows / TILE
    large = materialize(
        cells.groupBy("grid", "cell")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > TILE)
        .select("grid", "cell", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    whole = cells.join(large, ["grid", "cell"], "left_anti").withColumn("tile", F.lit(0))
    split = (
        cells.join(large, ["grid", "cell"])
        .withColumn("own", own)
        .withColumn("other", other)
        .filter(F.col("own") != F.col("other"))
        .withColumn(
            "tile",
            F.least("own", "other") * F.col("tiles") + F.greatest("own", "other"),
        )
    )
    columns = ["grid", "cell", "tile", "fp"]
    rows = whole.select(columns).unionByName(split.select(columns))
    found = (
        rows.repartition("grid", "cell", "tile")
        .sortWithinPartitions("grid", "cell", "tile")
        .mapInArrow(_links, "a long, b long")
    )
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fp`` (signed), ``root`` (a fingerprint of the component), ``component_id``."""
    rows = materialize(docs.select(F.col(key), fingerprints(F.col(text)).alias("fp")))
    return rows.join(print_classes(rows, key), "fp").select(key, "fp", "root", "component_id")


def print_classes(rows: DataFrame, key: str) -> DataFrame:
    """``fp, root, component_id`` of each fingerprint of rows ``key, fp``."""
    prints = materialize(rows.groupBy("fp").agg(F.min(key).alias("least")))
    roots = components(links(prints))
    named = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    of_root = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return materialize(named.select("fp", "root", "least").join(of_root, "root"))


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component with all its columns: one of those with the smallest key.

    Rows are told apart by key and fingerprint, so different texts under one key each count in the
    component of their own.  Components in which no row has a key keep a row too.  Of rows equal in
    both, the one whose columns hash lowest stays.  Fingerprints are computed once, with the rows.
    """
    whole = F.struct("*")
    own = materialize(
        docs.select(whole.alias("row"), F.col(key).alias("id"), fingerprints(F.col(text)).alias("fp"))
    )
    classes = print_classes(own.select("id", "fp"), "id")
    # the smallest fingerprint under the smallest key; a fingerprint's smallest key is its own
    named = F.col("least").eqNullSafe(F.col("component_id"))
    kept = (
        classes.filter(named)
        .groupBy("root")
        .agg(F.min("fp").alias("fp"), F.first("component_id").alias("id"))
        .select("fp", "id")
    )
    # by key too, so copies of one text are not one key of the join
    same = (F.col("o.fp") == F.col("k.fp")) & F.col("o.id").eqNullSafe(F.col("k.id"))
    rows = own.alias("o").join(kept.alias("k"), same, "left_semi")
    first = F.min_by("row", F.xxhash64("row")).alias("row")
    return rows.groupBy("fp", "id").agg(first).select("row.*")
