"""Inverted index for BM25: stored postings, score bounds by block, exact best-k search as joins.

``build`` tokenises every chunk once.  Chunks are numbered and stored in order, each with its postings,
and a *block* is a run of them with one topic; per term and block the index knows the number of postings
and the largest impact, which tasks combine before the shuffle, as they hold whole blocks.
A search sums, for each question and block, the largest contributions its terms can make
there.  The most promising blocks are scored first; their k-th best score is a floor that any
other block's bound must reach for its postings to be read.  What is scored is scored in full,
so the result is that of scoring everything.

All of it is joins and sums.  The postings of all questions' terms are dealt out by block once, whatever
the number of questions: a chunk has them in one task, which adds them up and sends on
the best k of each question.  A frequent term is dealt over as many keys as it has blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.functions import text as tx
from wardflow.operators.topk import SCORE_DECIMALS
from wardflow.session import materialize

# BM25 (Okapi) parameters.
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25

# Term buckets of a stored index, and chunks of a block (about, for one topic).
BUCKETS = 64
BLOCK_CHUNKS = 512

# Parts of a stored bucket.
PARTS = 8

# A block is a run of BLOCK_CHUNKS chunks for each topic there is, counted up to this many.
MOST_TOPICS = 16

# Blocks of a scoring task, which holds a sum for each question and chunk of them.
TASK_BLOCKS = 8

# Blocks of a question that are scored to find its floor.
FIRST_BLOCKS = 4

# Sums of floats in another order may differ by less than this.
MARGIN = 1e-6


@dataclass(frozen=True)
class Postings:
    """``rows``: bucket, term, topic, no, tf, length and block.  ``heads``: bucket, term, block, df,
    most.  ``names``: no, chunk_id, doc_id, ordinal, length, ``no`` in the order of doc_id and ordinal.
    ``terms``: term, df, idf.  ``corpus``: one row (n, avgdl)."""

    rows: DataFrame
    heads: DataFrame
    names: DataFrame
    terms: DataFrame
    corpus: DataFrame


def bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def counted(tokens: Column) -> Column:
    """``term, tf`` of a token list as an array of structs, within the row.

    The list is sorted; a term begins where it differs from the one before.
    """

    def starts(ordered: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(ordered))
        first = F.filter(
            F.when(F.size(ordered) > 0, places).otherwise(F.array().cast("array<int>")),
            lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)),
        )
        return tx.let(
            F.concat(first, F.array(F.size(ordered) + 1)),
            lambda begin: F.transform(
                F.slice(begin, 1, F.size(begin) - 1),
                lambda at, k: F.struct(
                    F.get(ordered, at - 1).alias("term"),
                    (F.get(begin, k + 1) - at).alias("tf"),
                ),
            ),
        )

    return tx.let(F.sort_array(tokens), starts)


def tokenised(chunks: DataFrame) -> DataFrame:
    """``chunk_id, doc_id, ordinal, topic, length`` and the postings of each chunk as an array.

    ``chunks`` has chunk_id, doc_id, ordinal, text and, if there is one, topic.
    """
    topic = F.coalesce("topic", F.lit("")) if "topic" in chunks.columns else F.lit("")
    tokens = F.coalesce(tx.tokens(F.col("text")), F.array().cast("array<string>"))
    split = chunks.select("chunk_id", "doc_id", "ordinal", F.xxhash64(topic).alias("topic"), tokens.alias("tokens"))
    return split.withColumn("length", F.size("tokens")).withColumn("postings", counted(F.col("tokens"))).drop("tokens")


def _tables(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, names) of ``chunks``, whose texts are read once.

    Chunks are numbered in order, so that a posting is a few numbers and ties of scores need no
    names, and stored in it, so that the postings of a block lie together.
    """
    forward = materialize(tokenised(chunks)).repartitionByRange("doc_id", "ordinal")
    ordered = materialize(
        forward.sortWithinPartitions("doc_id", "ordinal").withColumn("no", F.monotonically_increasing_id())
    )
    topics = F.least(ordered.agg(F.count_distinct("topic")).scalar(), F.lit(MOST_TOPICS))
    rows = _with_copies(ordered).select(
        "topic", "no", "length", "copies", _block(topics).alias("block"), F.inline("postings")
    )
    rows = rows.select(bucket(F.col("term")).alias("bucket"), "term", "topic", "no", "tf", "length", "block", "copies")
    return rows, ordered.select("doc_id", "ordinal", "chunk_id", "length", "no")


def _with_copies(ordered: DataFrame) -> DataFrame:
    """``topic, no, length, postings, copies``: where a place (doc_id, ordinal) repeats, each chunk there has
    the postings of all of them, and ``copies`` is how many; a chunk without a place has none."""
    place = ["doc_id", "ordinal"]
    repeated = materialize(ordered.groupBy(*place).agg(F.count("*").alias("copies")).filter("copies > 1").dropna())
    columns = ["topic", "no", "length", "postings", "copies"]
    own = ordered.dropna(subset=place)
    if repeated.isEmpty():
        return own.withColumn("copies", F.lit(1).cast("bigint")).select(*columns)
    own = own.join(repeated, place, "left").withColumn("copies", F.coalesce("copies", F.lit(1).cast("bigint")))
    there = ordered.join(repeated, place)
    others = there.select(*place, "length", "postings", F.col("no").alias("_of"))
    more = there.select(*place, "topic", "no", "copies").join(others, place).filter("no != _of")
    return own.select(*columns).unionByName(materialize(more.select(*columns)))


def raw_idf(n: Column, df: Column) -> Column:
    return F.ln(n - df + 0.5) - F.ln(df + 0.5)


def with_idf(df_of_terms: DataFrame, n: Column) -> DataFrame:
    """``term, df`` with ``idf``: a term in more than half of the chunks has a negative one and gets
    ``epsilon`` times the mean of the whole vocabulary (negatives included) instead."""
    terms = df_of_terms.select("term", "df", raw_idf(n, F.col("df")).alias("idf"))
    floor = terms.agg(F.avg("idf") * BM25_EPSILON).scalar()
    return terms.withColumn("idf", F.when(F.col("idf") < 0, floor).otherwise(F.col("idf")))


def impact(avgdl: Column) -> Column:
    """What one posting contributes per unit of the question's term weight."""
    damp = BM25_K1 * (1 - BM25_B + BM25_B * F.col("length") / avgdl)
    return F.col("tf") * (BM25_K1 + 1) / (F.col("tf") + damp)


def _block(topics: Column) -> Column:
    """The block of a chunk: its topic and its run of chunks."""
    run = F.floor(F.col("no") / (F.lit(BLOCK_CHUNKS) * F.greatest(topics, F.lit(1))))
    return F.xxhash64("topic", run)


def _heads(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Bounds of posting rows; where these are in order, a task's partial sums are nearly all there is."""
    avgdl = names.agg(F.avg("length")).scalar()
    most = F.max(impact(avgdl) * F.col("copies"))
    return rows.groupBy("bucket", "term", "block").agg(F.count("*").alias("df"), most.alias("most"))


def _with_statistics(rows: DataFrame, heads: DataFrame, names: DataFrame) -> Postings:
    corpus = materialize(names.agg(F.count("*").alias("n"), F.avg("length").alias("avgdl")))
    n = corpus.select("n").scalar()
    terms = materialize(with_idf(materialize(heads.groupBy("term").agg(F.sum("df").alias("df"))), n))
    return Postings(rows, heads, names, terms, corpus)


def build(chunks: DataFrame) -> Postings:
    """Index of ``chunks`` in work tables; the rows are those of the chunks in order."""
    rows, names = _tables(chunks)
    return _with_statistics(rows.drop("copies"), materialize(_heads(rows, names)), names)


def write(chunks: DataFrame, path: str) -> None:
    """The index of ``chunks`` as stored tables, postings in a folder for each term bucket.

    A search opens the folders of its terms only.  The tables are replaced as a whole.
    """
    rows, names = _tables(chunks)
    # parts of a bucket by block, so that a frequent term is not one task
    dealt = rows.drop("copies").repartition("bucket", F.pmod(F.xxhash64("block"), F.lit(PARTS))).sortWithinPartitions("bucket", "block", "no")
    names.write.mode("overwrite").parquet(f"{path}/names")
    _heads(rows, names).write.mode("overwrite").parquet(f"{path}/heads")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows")


def read(spark: SparkSession, path: str) -> Postings:
    tables = [spark.read.parquet(f"{path}/{name}") for name in ("rows", "heads", "names")]
    return _with_statistics(*tables)


# ---- search ----------------------------------------------------------------------------------


def weighted_terms(queries: DataFrame, terms: DataFrame) -> DataFrame:
    """``query_id, bucket, term, weight``: a repeated question word counts as often as it occurs."""
    exploded = queries.select("query_id", F.explode(tx.tokens(F.col("query"))).alias("term"))
    counts = exploded.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))
    weight = F.col("qtf") * F.col("idf")
    return counts.join(terms, "term").select("query_id", bucket(F.col("term")).alias("bucket"), "term", weight.alias("weight"))


def block_bounds(weighted: DataFrame, heads: DataFrame) -> DataFrame:
    """``query_id, block, bound``: no chunk of the block scores more."""
    most = F.greatest(F.col("weight"), F.lit(0.0)) * F.col("most")
    return (
        weighted.join(heads, ["bucket", "term"]).groupBy("query_id", "block").agg(F.sum(most).alias("bound"))
    )


def _scored(blocks: DataFrame, weighted: DataFrame, postings: Postings) -> DataFrame:
    """Full scores above 0 of all chunks of the given ``query_id, block``.

    Postings are shuffled by block before they meet the questions; nothing else is.
    """
    avgdl = postings.corpus.select("avgdl").scalar()
    # a row for each block, with as many questions as ask for it
    wanted = materialize(blocks.groupBy("block").agg(F.collect_list("query_id").alias("asking")))
    tasks = -(-wanted.count() // TASK_BLOCKS)
    rows = postings.rows.join(wanted.select("block"), "block", "left_semi")
    asked = rows.join(weighted.select("bucket", "term").distinct(), ["bucket", "term"], "left_semi")
    placed = asked.select("bucket", "term", "block", "no", impact(avgdl).alias("impact")).repartition(max(1, tasks), "block")
    met = placed.join(wanted, "block").join(weighted, ["bucket", "term"])
    # a chunk lies in one block, so this sum needs no further shuffle
    return (
        met.filter(F.array_contains("asking", F.col("query_id")))
        .groupBy("query_id", "block", "no")
        .agg(F.sum(F.col("weight") * F.col("impact")).alias("score"))
        .filter("score > 0")
        .select("query_id", "no", "score")
    )


def rounded(score: Column) -> Column:
    """To ``SCORE_DECIMALS`` decimals; in floating point, as ``round`` would go through decimals."""
    return F.rint(score * 10.0**SCORE_DECIMALS) / 10.0**SCORE_DECIMALS


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "no")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(queries: DataFrame, postings: Postings, top_k: int = 20) -> DataFrame:
    """Each question's best ``top_k`` chunks with a score above 0, exactly.

    Scores are ranked at ``SCORE_DECIMALS`` decimals, ties by doc_id, then ordinal.
    """
    weighted = materialize(weighted_terms(queries, postings.terms))
    bounds = materialize(block_bounds(weighted, postings.heads))
    promising = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    ranked = bounds.withColumn("turn", F.row_number().over(promising))
    first = materialize(ranked.filter(F.col("turn") <= FIRST_BLOCKS))
    score = rounded(F.col("score"))
    found = materialize(_best(_scored(first, weighted, postings).withColumn("score", score), top_k))
    # a few rows a question
    floors = found.filter(F.col("rank") == top_k).select("query_id", F.col("score").alias("floor"))
    rest = (
        bounds.join(first.select("query_id", "block"), ["query_id", "block"], "left_anti")
        .join(floors, "query_id", "left")
        .filter(F.col("floor").isNull() | (F.col("bound") >= F.col("floor") - MARGIN))
    )
    reaching = (
        _scored(rest, weighted, postings)
        .join(floors, "query_id", "left")
        .filter(F.col("floor").isNull() | (F.col("score") >= F.col("floor") - MARGIN))
        .select("query_id", "no", "score")
    )
    scored = found.drop("rank").unionByName(reaching.withColumn("score", score))
    return (
        materialize(_best(scored, top_k))  # top_k rows a question
        .join(postings.names, "no")
        .select("query_id", "chunk_id", "doc_id", "ordinal", "score", "rank")
    )
