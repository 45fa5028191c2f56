"""N-gram Jaccard join: documents whose sets of word shingles overlap in four fifths of their union.

The documents are the rows of a sparse incidence matrix, the shingles its columns; the product with
its own transpose holds all overlaps.  It is never formed whole.  What cannot reach the bound goes first,
what belongs together anyway is not multiplied again, and the rest is multiplied in blocks:

1. Documents of equal sets become one row.
2. Two sets of similarity 0.8 share at least four fifths of either.  So a row with more than a fifth of
   columns that no other row has is dropped.  This is done first on a band of the columns (a fixed
   share of the hash range), which is cheap and leaves few rows, then on all columns of those.
3. Rows that agree on a min-hash form blocks of at most ``BLOCK`` rows; a block's product is
   accumulated column by column, one pivot row after another, and linked rows leave it.  This
   connects most of what is similar with work in proportion to the rows.  It only saves work.
4. Between rows of different components, the product is exact: rows are ordered by rarest columns, and
   two linked rows share one among their first ``n // 5 + 1``.  Where such a column joins several
   components, its pairs of rows of different components that pass the length and position bounds are
   listed, and their overlaps computed in full.

Large blocks are split into tiles, pairs of tiles being groups of their own, and group totals are
summed in parts, so a column or component with a third of all rows is no single task.  Links inside a
component are not listed, none between components is left out.

Defined cases.  A null, empty or blank text has an empty set and is linked with nothing, not even with
its like.  A text of fewer than five words is one shingle.  Repeated rows are rows of their own.  A null
key takes no part in the smallest key of a component; ``component_id`` is null where all keys are.
Shingles and sets are told apart by 64-bit hashes.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.batches import Words, mixed, pieces, raw, shingle_hashes
from wardflow.llm.components import components
from wardflow.llm.salted import attach
from wardflow.session import materialize, work_tables

SHINGLE = 5

# Two sets link when DEN * overlap >= NUM * union; no row may lack more than n // SLACK of another's.
NUM, DEN, SLACK = 4, 5, 5

# The band of the first test: this share of the hash range.
BAND = 5 / 16

# Min-hashes by which blocks are formed.
ROUNDS = 4

# Rows of a block or tile, and shingles that a task holds of one.
BLOCK = 512
HELD = 1 << 21

# Everything but white space, A-Z lower-cased.  Byte 0 separates, so a NUL becomes a byte that
# UTF-8 never holds.
TOKENS = np.arange(256, dtype=np.uint8)
TOKENS[0x41:0x5B] += 32
TOKENS[0] = 0xFF
for _b in (0x20, *range(0x09, 0x0E)):
    TOKENS[_b] = 0


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a piece's rows, sorted within each, and the rows' bounds."""
    words = Words(*raw(texts), TOKENS)
    hashes, counts = words.hashes(), np.diff(words.bounds)
    found, row = shingle_hashes(hashes, size), words.rows()
    inside = row[: len(found)] == row[len(hashes) - len(found) :] if len(found) else np.zeros(0, bool)
    found, of = found[inside], row[: len(found)][inside]
    few = np.flatnonzero((counts > 0) & (counts < size))
    whole = [shingle_hashes(hashes[words.bounds[r] : words.bounds[r + 1]], counts[r]) for r in few]
    found, of = np.concatenate([found, *whole]), np.concatenate([of, few])
    order = np.lexsort((found, of))
    found, of = found[order], of[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
    return found[new], np.searchsorted(of[new], np.arange(len(counts) + 1))


def _node(found: np.ndarray) -> int:
    """A hash of the whole set."""
    return int.from_bytes(hashlib.sha256(found.tobytes()).digest()[:8], "little", signed=True)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


def _sets(size: int, whole: bool) -> Callable:
    """Rows with the text last to rows with (n, node, shingles), all of them or those of the band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, names = 0, [*batch.schema.names[:-1], "n", "node", "shingles"]
            for texts in pieces(batch.column(batch.num_columns - 1)):
                found, bounds = shingle_sets(texts, size)
                sizes = np.diff(bounds)
                nodes = [_node(found[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
                if not whole:
                    low = found < np.uint64(int(BAND * (1 << 64)))
                    bounds = np.r_[0, np.cumsum(low)][bounds]
                    found = found[low]
                kept = [c.slice(start, len(texts)) for c in batch.columns[:-1]]
                start += len(texts)
                made = [pa.array(sizes.astype(np.int64)), pa.array(nodes, pa.int64()), _lists(found, bounds)]
                yield pa.RecordBatch.from_arrays([*kept, *made], names)

    return run


def with_sets(docs: DataFrame, text: str, size: int, whole: bool) -> DataFrame:
    """``docs`` with n, node (of the set) and shingles in place of the text; null texts are empty."""
    kept = [c for c in docs.columns if c != text]
    kind = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in kept)
    return docs.select(*kept, text).mapInArrow(
        _sets(size, whole), f"{kind}n long, node long, shingles array<long>"
    )


# ---- rows that can reach the bound -----------------------------------------------------------


def _possible(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``nodes`` (node, n, ...) with at most ``n // SLACK`` shingles that no other node has.

    ``sets`` are rows (node, shingles), copies included.
    """
    each = sets.select("node", F.explode("shingles").alias("shingle"))
    # a shingle of one node names that node, so nothing is joined back to the shingles
    alone = each.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("other")).filter("node = other")
    lacking = alone.groupBy("node").agg(F.count("*").alias("lacking"))
    few = F.coalesce("lacking", F.lit(0)) <= F.floor(F.col("n") / SLACK)
    return nodes.join(lacking, "node", "left").filter(few).drop("lacking")


def _incidence(rows: DataFrame) -> DataFrame:
    """(node, n, shingles): shared shingles only, rarest first, of rows that share enough of them."""
    rows = materialize(rows)
    each = rows.select("node", F.explode("shingles").alias("shingle"))
    counted = attach(each, ["shingle"], "node", df=("count", "*")).filter("df > 1")
    gathered = counted.groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("found")
    )
    enough = F.col("n") - F.size("found") <= F.floor(F.col("n") / SLACK)
    found = rows.select("node", "n").join(gathered, "node").filter(enough)
    return found.select("node", "n", F.col("found.shingle").alias("shingles"))


# ---- blocks ----------------------------------------------------------------------------------


def linked(overlap, n, m):
    """Whether sets of ``n`` and ``m`` with this overlap link."""
    return DEN * overlap >= NUM * (n + m - overlap)


def block_links(nodes: np.ndarray, n: np.ndarray, shingles: np.ndarray, bounds: np.ndarray):
    """Links (a, b) that connect whatever is linked within a block of rows.

    One row after another is multiplied with the block's columns; rows found linked leave it and
    are multiplied in turn with what is left.
    """
    size = len(nodes)
    row = np.repeat(np.arange(size), np.diff(bounds))
    _, column, held = np.unique(shingles, return_inverse=True, return_counts=True)
    by_column = row[np.argsort(column, kind="stable")]
    start = np.cumsum(held) - held
    left, links, waiting = np.ones(size, bool), [], []
    for first in range(size):
        if not left[first]:
            continue
        left[first] = False
        waiting.append(first)
        while waiting and left.any():
            pivot = waiting.pop()
            columns = column[bounds[pivot] : bounds[pivot + 1]]
            lengths = held[columns]
            ends = np.cumsum(lengths)
            at = np.arange(ends[-1]) + np.repeat(start[columns] - (ends - lengths), lengths)
            overlap = np.bincount(by_column[at], minlength=size)
            reached = np.flatnonzero(left & linked(overlap, n[pivot], n))
            left[reached] = False
            waiting.extend(reached.tolist())
            links.append((np.full(len(reached), nodes[pivot]), nodes[reached]))
        waiting.clear()
    return links


def _pairs(links: list) -> Iterator[pa.RecordBatch]:
    if links:
        a, b = (np.concatenate([x[k] for x in links]) for k in (0, 1))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple]:
    """(new run?, columns) of each row of sorted batches; runs have equal first ``keys`` columns."""
    before = None
    for batch in batches:
        for values in zip(*[c.to_pylist() for c in batch.columns[:keys]], range(batch.num_rows), strict=True):
            yield values[:keys] != before, batch, values[keys]
            before = values[:keys]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the blocks in rows (round, key, tile, node, n, shingles) sorted by block.

    A block of very long rows is cut where it holds ``HELD`` shingles.
    """
    held: list[tuple] = []
    size = 0

    def done():
        if len(held) < 2:
            return
        nodes, n = (np.array([h[k] for h in held]) for k in (0, 1))
        bounds = np.r_[0, np.cumsum([len(h[2]) for h in held])]
        yield from _pairs(block_links(nodes, n, np.concatenate([h[2] for h in held]), bounds))

    for new, batch, k in _runs(batches, 3):
        if new or size > HELD:
            yield from done()
            held, size = [], 0
        shingles = batch.column(5)[k].values.to_numpy()
        held.append((batch.column(3)[k].as_py(), batch.column(4)[k].as_py(), shingles))
        size += len(shingles)
    yield from done()


def _min_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, shingles) with the min-hashes of each round."""
    salts = [np.uint64(0x9E3779B97F4A7C15 * (r + 1) % (1 << 64)) for r in range(ROUNDS)]
    for batch in batches:
        lists = batch.column(2)
        values = lists.flatten().to_numpy().view(np.uint64)
        starts = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())][:-1]
        keys = np.empty((len(lists), ROUNDS), np.uint64)
        for r, salt in enumerate(salts):
            keys[:, r] = np.minimum.reduceat(mixed(values ^ salt), starts) if len(values) else 0
        bounds = np.arange(0, ROUNDS * len(lists) + 1, ROUNDS)
        yield pa.RecordBatch.from_arrays([*batch.columns, _lists(keys.ravel(), bounds)], [*batch.schema.names, "keys"])


def _close_links(rows: DataFrame) -> DataFrame:
    """Links within blocks of rows that agree on a min-hash."""
    kind = "node long, n long, shingles array<long>, keys array<long>"
    keyed = materialize(rows.select("node", "n", "shingles").mapInArrow(_min_hashes, kind))
    slim = keyed.select("node", F.posexplode("keys").alias("round", "key"))
    sized = attach(slim, ["round", "key"], "node", size=("count", "*")).filter("size > 1")
    tiles = F.ceil(F.col("size") / BLOCK)
    placed = sized.select("node", "round", "key", F.pmod(F.xxhash64("node", "round"), tiles).alias("tile"))
    return (
        placed.join(keyed.drop("keys"), "node")
        .select("round", "key", "tile", "node", "n", "shingles")
        .repartition("round", "key", "tile")
        .sortWithinPartitions("round", "key", "tile", "node")
        .mapInArrow(_blocks, "a long, b long")
    )


# ---- what is left between components ---------------------------------------------------------


def _crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rows of one column that lie in different components and pass the bounds.

    Rows are (shingle, low, high, own, n, node, comp, place), sorted; in a pair of tiles only rows
    of different tiles meet.
    """
    held: list[tuple] = []

    def done():
        if len(held) < 2:
            return
        low, high, own, n, node, comp, place = (np.array(c) for c in zip(*held, strict=True))
        links = []
        for i in range(len(n) - 1):
            stop = np.searchsorted(n, n[i] * DEN // NUM, "right")
            j = np.arange(i + 1, stop)
            rest = np.minimum(n[i] - place[i], n[j] - place[j])
            # at the first column two rows share, all they share is still to come
            good = (comp[j] != comp[i]) & linked(rest, n[i], n[j])
            good &= (own[j] != own[i]) | (low[i] == high[i])
            links.append((np.minimum(node[j[good]], node[i]), np.maximum(node[j[good]], node[i])))
        yield from _pairs(links)

    for new, batch, k in _runs(batches, 3):
        if new:
            yield from done()
            held = []
        held.append(tuple(batch.column(c)[k].as_py() for c in range(1, 8)))
    yield from done()


def _candidates(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that share one of their rarest columns."""
    lacking = F.col("n") - F.size("shingles")
    first = F.slice("shingles", 1, F.floor(F.col("n") / SLACK).cast("int") + 1 - lacking.cast("int"))
    each = materialize(
        rows.select("node", "n", "comp", lacking.alias("lacking"), F.posexplode(first).alias("at", "shingle")).select(
            "shingle", "node", "n", "comp", (F.col("lacking") + F.col("at")).alias("place")
        )
    )
    sized = attach(each, ["shingle"], "node", size=("count", "*"), least=("min", "comp"), most=("max", "comp"))
    tiles = F.ceil(F.col("size") / BLOCK)
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    tiled = (
        sized.filter("least < most")
        .withColumn("tiles", tiles)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")))
        .withColumn("other", others)
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
    )
    return (
        tiled.select("shingle", "low", "high", "own", "n", "node", "comp", "place")
        .repartition("shingle", "low", "high")
        .sortWithinPartitions("shingle", "low", "high", "n", "node")
        .mapInArrow(_crossing, "a long, b long")
        .distinct()
    )


def _overlap_links(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs whose sets link, with the component of each side."""
    a = rows.select(F.col("node").alias("a"), F.col("n").alias("n"), F.col("shingles").alias("x"), F.col("comp").alias("comp_a"))
    b = rows.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("shingles").alias("y"), F.col("comp").alias("comp_b"))
    overlap = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(a, "a").join(b, "b").withColumn("overlap", overlap)
        .filter(linked(F.col("overlap"), F.col("n"), F.col("m")))
        .select("a", "b", "comp_a", "comp_b")
    )


def _roots(rows: DataFrame) -> DataFrame:
    """(node, root) of the rows (node, n, shingles) that link with others."""
    close = components(_close_links(rows)).withColumnRenamed("root", "comp")
    rows = materialize(rows.join(close, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    crossing = _overlap_links(_candidates(rows), rows).select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
    joined = components(crossing).withColumnRenamed("node", "comp")
    return rows.select("node", "comp").join(joined, "comp", "left").select("node", F.coalesce("root", "comp").alias("root"))


# ---- the operator ----------------------------------------------------------------------------


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of every row."""
    printed = F.xxhash64(text)
    named = docs.select(F.col(key).alias("key"), printed.alias("print"), F.col(text).alias("text"))
    spark = docs.sparkSession
    with work_tables(spark):  # the bands go as soon as they have been read
        banded = materialize(with_sets(named, "text", size, whole=False))
        sets = materialize(banded.drop("shingles"), keep=True)
        filled = sets.filter("n > 0")
        first = F.min(F.struct(F.col("key").isNull().alias("nameless"), "key", "print")).alias("first")
        nodes = materialize(filled.groupBy("node").agg(F.first("n").alias("n"), first), keep=True)
        left = _possible(banded.filter("n > 0"), nodes).select("first.key", "first.print")
        # by text and key, so copies of one text are not one key of the join; what is left grows
        # with the input, so the plan is the one for large tables at any size
        same = (F.col("d.print") == F.col("l.print")) & F.col("d.key").eqNullSafe(F.col("l.key"))
        texts = named.alias("d").join(left.hint("merge").alias("l"), same, "left_semi").select("text")
        whole = materialize(with_sets(texts, "text", size, whole=True).filter("n > 0"), keep=True)
    with work_tables(spark):
        rows = materialize(_incidence(_possible(whole, whole.dropDuplicates(["node"]))), keep=True)
    with work_tables(spark):
        roots = materialize(_roots(rows), keep=True)

    classes = nodes.select("node", F.col("first.key").alias("least")).join(roots, "node", "left")
    classes = materialize(classes.withColumn("root", F.coalesce("root", "node")))
    of_node = attach(classes, ["root"], "node", component_id=("min", "least")).select("node", "component_id")
    # rows find their class in parts too: one class may hold a third of them
    dealt = filled.select("node", "key", "n").withColumn("salt", _salt("key"))
    parts = dealt.select("node", "salt").distinct().join(of_node, "node")
    done = dealt.join(parts, ["node", "salt"]).select("key", "n", "component_id")
    empty = sets.filter("n = 0").select("key", "n", F.col("key").alias("component_id"))
    return done.unionByName(empty).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")


def _salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(64)).cast("int")
