"""Source divergence audit: how far apart the sources of a language are in their words.

Per language the terms that enough documents hold are the columns, the sources the rows of a matrix
of counts.  A source gives each term the smoothed share ``p``; two sources are as far apart as the
sum of ``abs(p - q)``.  Most of a large matrix is zero, and where a source has no term its share is one
constant, so the matrix is stored as K-squared quadtrees: a square is cut into K x K quadrants,
empty ones are not stored, and the leaves are the counts.  Two rows are compared by walking their
trees side by side: a quadrant empty for both is priced at once, its width times the difference of
the two constants, and only where one of them has something does the walk go on.

Terms are counted by a grouped aggregation of counts that each task has summed already.  The matrix
is cut into square tiles; a task gets the cells of one column range for two
row ranges, however large the matrix, and returns the partial sums of their pairs.  All arithmetic is
in integers.

Defined cases.  A null or missing text has no terms; a null language or source is ''.  Every
(language, source) that occurs is a group, also without terms; a language without frequent terms has
distance 0 between all its sources; one with a single source has no pairs.  Repeated rows count
each.  A term is any length.  An empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.llm.batches import Words, mixed, pieces, raw
from wardflow.session import materialize

# Documents of its language that a term must be in, and what smoothing adds to each count.
LEAST_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000

# Fan-out of the quadtree by row and by column, and its depth: a tile has K ** DEPTH rows and columns.
K = 4
DEPTH = 5

# Cells that one step of a walk handles, so that its memory is bounded.
STEP = 1 << 20

# Parts in which rows are numbered within a language.
PARTS = 256

# Letters of any script, A-Z lower-cased; byte 0 separates.
LETTERS = np.zeros(256, np.uint8)
for _b in range(256):
    _c = _b + 32 if 0x41 <= _b <= 0x5A else _b
    LETTERS[_b] = _c if 0x61 <= _c <= 0x7A or _c >= 0x80 else 0


# ---- counting --------------------------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, source, term, n, docs), summed within a batch."""
    for batch in batches:
        langs, sources = (batch.column(k).dictionary_encode() for k in (0, 1))
        width = max(1, len(sources.dictionary))
        groups = langs.indices.to_numpy().astype(np.int64) * width + sources.indices.to_numpy()
        found, start = [], 0
        for texts in pieces(batch.column(2)):
            words = Words(*raw(texts), LETTERS)
            found.append(_piece(words, groups[start : start + len(texts)]))
            start += len(texts)
        found = [f for f in found if len(f[0])]
        if not found:
            continue
        group, term, n, docs = (np.concatenate([f[k] for f in found]) for k in (0, 1, 3, 4))
        text = pa.concat_arrays([f[2] for f in found])
        order = np.lexsort((term, group))
        group, term = group[order], term[order]
        new = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (term[1:] != term[:-1])])
        yield pa.RecordBatch.from_arrays(
            [
                langs.dictionary.take(pa.array(group[new] // width)),
                sources.dictionary.take(pa.array(group[new] % width)),
                text.take(pa.array(order[new])),
                pa.array(np.add.reduceat(n[order], new)),
                pa.array(np.add.reduceat(docs[order], new)),
            ],
            ["lang", "source", "term", "n", "docs"],
        )


def _piece(words: Words, groups: np.ndarray) -> tuple:
    """Group, hash, text, count and documents of each term and group of a piece."""
    row, term = words.rows(), words.hashes()
    # one number for row and term orders both; the term itself is looked up afterwards
    both = mixed(term + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first, n = np.unique(both, return_index=True, return_counts=True)
    group = groups[row[first]]
    order = np.lexsort((term[first], group))
    first, n, group = first[order], n[order], group[order]
    if len(first) == 0:
        return group, term, pa.array([], pa.string()), n, n
    new = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (term[first][1:] != term[first][:-1])])
    docs = np.diff(np.r_[new, len(first)])
    at = first[new]
    return group[new], term[at], _texts(words, at), np.add.reduceat(n, new), docs


def _texts(words: Words, at: np.ndarray) -> pa.Array:
    sizes = words.ends[at] - words.starts[at]
    ends = np.cumsum(sizes)
    places = np.arange(ends[-1]) + np.repeat(words.starts[at] - (ends - sizes), sizes)
    offsets = pa.array(np.r_[0, ends].astype(np.int32)).buffers()[1]
    return pa.StringArray.from_buffers(len(at), offsets, pa.py_buffer(words.bytes[places].tobytes()))


def _plain(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents that have the term."""
    texts = docs.select(_plain("lang").alias("lang"), _plain("source").alias("source"), "text")
    counted = texts.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def numbered(rows: DataFrame, column: str, name: str) -> DataFrame:
    """``name`` counts the rows of a language from 0, in parts so that no task gets all of them."""
    parted = rows.withColumn("bucket", F.pmod(F.xxhash64(column), F.lit(PARTS)).cast("int"))
    before = Window.partitionBy("lang").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        parted.groupBy("lang", "bucket")
        .agg(F.count("*").alias("n"))
        .select("lang", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    inside = F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(column)) - 1
    return (
        parted.withColumn("inside", inside)
        .join(base, ["lang", "bucket"])
        .withColumn(name, (F.col("base") + F.col("inside")).cast("long"))
        .drop("bucket", "inside", "base")
    )


def share(n: str, total: str, terms: str) -> Column:
    """p of a term counted ``n`` times among ``total`` over ``terms`` terms, exact."""
    return F.expr(
        f"1 + (cast({n} + {SMOOTHING} as decimal(20,0)) * cast({SCALE} as decimal(10,0)))"
        f" div cast({total} + {SMOOTHING} * {terms} as decimal(20,0))"
    )


# ---- quadtrees -------------------------------------------------------------------------------


def shares(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * n / whole) for n <= whole < 2^53, by long division in base 1000."""
    quotient, left = np.zeros_like(whole), n.astype(np.int64)
    for _ in range(3):
        left = left * 1000
        quotient = quotient * 1000 + left // whole
        left = left % whole
    return quotient + 1


class Quadtree:
    """A sparse square of side ``K ** depth``: per level a mask of the quadrants that hold something."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, depth: int):
        self.depth = depth
        code, unit = np.zeros(len(rows), np.int64), 1
        for level in range(depth):
            digit = (rows // K**level % K) * K + columns // K**level % K
            code, unit = code + digit * unit, unit * K * K
        self.order = np.argsort(code)
        nodes = code[self.order]
        self.masks, self.first = [], []
        for _ in range(depth):
            above, start = np.unique(nodes // (K * K), return_index=True)
            bits = np.left_shift(1, nodes % (K * K))
            self.masks.insert(0, np.bitwise_or.reduceat(bits, start) if len(nodes) else bits)
            self.first.insert(0, start)
            nodes = above
        self.empty = len(rows) == 0

    def child(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The node below, or -1 for an empty quadrant; the last level's are ``order``'s places."""
        if self.empty:
            return np.full(len(node), -1)
        mask = np.where(node < 0, 0, self.masks[level][node])
        before = np.bitwise_count(mask & (np.left_shift(1, quadrant) - 1))
        held = (mask >> quadrant & 1) == 1
        return np.where(held, self.first[level][node] + before, -1)


def distances(a: Quadtree, b: Quadtree, rows: tuple, shares_of: tuple, zeros: tuple, width: int) -> np.ndarray:
    """Sum of ``abs(p - q)`` over ``width`` columns, for each pair of a row of ``a`` and one of ``b``.

    ``shares_of`` are the leaves of the two trees, ``zeros`` the share of an absent term by row.
    """
    x, y = rows
    none_x, none_y = zeros[0][x], zeros[1][y]
    out = np.zeros(len(x), np.int64)
    if width <= 0 or len(x) == 0:
        return out
    pair = np.arange(len(x))
    root_a, root_b = (-1 if t.empty else 0 for t in (a, b))
    left, right, column = np.full(len(x), root_a), np.full(len(x), root_b), np.zeros(len(x), np.int64)
    for level in range(a.depth + 1):
        size = K ** (a.depth - level)
        bare = (left < 0) & (right < 0)
        if bare.any():
            wide = np.minimum(size, width - column[bare])
            at = pair[bare]
            np.add.at(out, at, wide * np.abs(none_x[at] - none_y[at]))
            pair, left, right, column = (v[~bare] for v in (pair, left, right, column))
        if level == a.depth or len(pair) == 0:
            break
        below = size // K
        pair, left, right, column = (np.repeat(v, K) for v in (pair, left, right, column))
        step = np.tile(np.arange(K), len(pair) // K)
        column = column + step * below
        inside = column < width
        pair, left, right, column, step = (v[inside] for v in (pair, left, right, column, step))
        left = a.child(level, left, x[pair] // below % K * K + step)
        right = b.child(level, right, y[pair] // below % K * K + step)
    p = np.where(left >= 0, shares_of[0][left] if len(shares_of[0]) else 0, none_x[pair])
    q = np.where(right >= 0, shares_of[1][right] if len(shares_of[1]) else 0, none_y[pair])
    np.add.at(out, pair, np.abs(p - q))
    return out


def _tile(depth: int) -> Callable:
    """Partial distances of the pairs of two row ranges over one column range."""

    def run(group: pa.Table) -> pa.Table:
        column = {c: group.column(c) for c in group.column_names}
        number = {c: column[c].to_numpy() for c in ("low", "high", "block", "at", "whole")}
        low, high = int(number["low"][0]), int(number["high"][0])
        marks = column["source"].is_valid().to_numpy()
        width = int(column["width"].to_numpy()[np.flatnonzero(marks)[0]])
        sides = []
        for block in (low, high):
            inside = number["block"] == block
            rows = np.flatnonzero(inside & marks)
            rows = rows[np.argsort(number["at"][rows])]
            at, whole = number["at"][rows], number["whole"][rows]
            absent = np.zeros(K**depth, np.int64)
            absent[at] = shares(np.full(len(rows), SMOOTHING), whole)
            cells = np.flatnonzero(inside & ~marks)
            tree = Quadtree(number["at"][cells], column["term_at"].to_numpy()[cells].astype(np.int64), depth)
            cells = cells[tree.order]
            counts = column["n"].to_numpy()[cells].astype(np.int64)
            leaves = shares(counts + SMOOTHING, number["whole"][cells])
            sides.append((tree, at, absent, leaves, column["source"].take(pa.array(rows))))
        (tree_a, at_a, zero_a, leaf_a, name_a), (tree_b, at_b, zero_b, leaf_b, name_b) = sides
        found: tuple[list, ...] = ([], [], [])
        step = max(1, STEP // max(1, width) // max(1, len(at_b)))
        for start in range(0, len(at_a), step):
            some = np.arange(start, min(start + step, len(at_a)))
            i, j = (v.ravel() for v in np.meshgrid(some, np.arange(len(at_b)), indexing="ij"))
            if low == high:
                i, j = i[i < j], j[i < j]
            value = distances(tree_a, tree_b, (at_a[i], at_b[j]), (leaf_a, leaf_b), (zero_a, zero_b), width)
            for kept, part in zip(found, (i, j, value), strict=True):
                kept.append(part)
        i, j, value = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)
        lang = pa.repeat(column["lang"][0], len(value))
        return pa.table(
            [lang, name_a.take(pa.array(i)), name_b.take(pa.array(j)), pa.array(value)],
            ["lang", "source", "item", "value"],
        )

    return run


# ---- the audit -------------------------------------------------------------------------------


def matrix(docs: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """Cells ``lang, source, term, n, term_at, in_lang`` and groups with their sizes and row numbers."""
    counts = materialize(term_counts(docs))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("in_lang"))
    terms = materialize(numbered(kept.filter(F.col("docs") >= least_docs).drop("docs"), "term", "term_at"))
    cells = materialize(counts.drop("docs").join(terms, ["lang", "term"]))
    langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("in_lang").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = numbered(docs.select(_plain("lang").alias("lang"), _plain("source").alias("source")).distinct(), "source", "row_at")
    rows = groups.groupBy("lang").agg(F.count("*").alias("rows"))
    zero = F.lit(0).cast("long")
    sized = groups.join(totals, ["lang", "source"], "left").join(langs.join(rows, "lang", "right"), "lang")
    numbers = [F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")]
    return cells, materialize(sized.select("lang", "source", "row_at", "rows", *numbers))


def pair_distances(cells: DataFrame, groups: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``lang, source, item, value`` of all ordered pairs of different sources of a language."""
    side = K**depth
    smoothed = F.greatest(F.col("total") + SMOOTHING * F.col("terms"), F.lit(SMOOTHING))
    facts = ["lang", "source", "row_at", "rows", smoothed.alias("whole"), "terms"]
    known = groups.select(*facts)
    block = F.floor(F.col("row_at") / side)
    tiles = F.floor(F.greatest(F.col("terms") - 1, F.lit(0)) / side)
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / side)))
    columns = ["lang", "tile", "low", "high", "block", "at", "whole", "source", "width", "term_at", "n"]

    def placed(rows: DataFrame) -> DataFrame:
        return (
            rows.withColumn("block", block)
            .withColumn("other", others)
            .withColumn("low", F.least("block", "other"))
            .withColumn("high", F.greatest("block", "other"))
            .withColumn("at", F.col("row_at") % side)
            .select(columns)
        )

    # each row is named once in every tile, so that rows without a cell there are priced too
    marks = known.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), tiles))).withColumns(
        {
            "width": F.least(F.lit(side), F.col("terms") - F.col("tile") * side),
            "term_at": F.lit(None).cast("long"),
            "n": F.lit(None).cast("long"),
        }
    )
    counted = (
        cells.select("lang", "source", F.col("term_at").alias("column"), "n")
        .join(known, ["lang", "source"])
        .withColumns(
            {
                "tile": F.floor(F.col("column") / side),
                "term_at": F.col("column") % side,
                "width": F.lit(None).cast("long"),
                "source": F.lit(None).cast("string"),
            }
        )
    )
    partial = (
        placed(marks)
        .unionByName(placed(counted))
        .groupBy("lang", "tile", "low", "high")
        .applyInArrow(_tile(depth), "lang string, source string, item string, value long")
    )
    half = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    return half.select("lang", F.explode(both).alias("x"), "value").select("lang", "x.*", "value")


def telling_terms(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: how much more a source uses a term than its language does."""
    p, q = share("n", "total", "terms"), share("in_lang", "lang_total", "terms")
    return (
        cells.join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), (p - q).alias("value"))
        .filter(F.col("value") > 0)
    )


def audit(docs: DataFrame, most_terms: int = 50, least_docs: int = LEAST_DOCS, depth: int = DEPTH) -> DataFrame:
    """``lang, source, part, item, value, rank``: all other sources, and the most telling terms."""
    cells, groups = matrix(docs, least_docs)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pair_distances(cells, groups, depth).withColumn("rank", rank).withColumn("part", F.lit("pair"))
    terms = telling_terms(cells, groups).withColumn("rank", rank).filter(F.col("rank") <= most_terms)
    return pairs.select(columns).unionByName(terms.withColumn("part", F.lit("term")).select(columns))
