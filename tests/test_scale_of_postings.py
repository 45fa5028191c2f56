"""What a search shuffles, and blocks as runs of chunks."""

import re

from pyspark.sql import functions as F

from wardflow.operators import postings
from wardflow.session import materialize


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def chunks_df(spark, n, words):
    texts = spark.range(n, numPartitions=4).select(
        F.concat(F.lit("d"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("doc_id"),
        F.lit(0).alias("ordinal"),
        F.lit("t").alias("topic"),
        F.array_join(
            F.transform(F.sequence(F.lit(1), F.lit(words)), lambda k: F.concat(F.lit("w"), ((F.col("id") + k) % 40).cast("string"))),
            " ",
        ).alias("text"),
    )
    return texts.withColumn("chunk_id", F.concat_ws("::", "doc_id", "ordinal"))


def test_blocks_are_runs_of_chunks(spark, monkeypatch):
    """So a task holds whole blocks and combines their bounds before the shuffle."""
    monkeypatch.setattr(postings, "BLOCK_CHUNKS", 100)
    built = postings.build(chunks_df(spark, 2000, 20))
    assert built.rows.count() == 2000 * 20
    blocks = built.heads.select("block").distinct().count()
    assert 20 <= blocks <= 20 + 40  # and one more at the end of each range of chunks
    spans = built.rows.groupBy("block").agg((F.max("no") - F.min("no")).alias("span"))
    assert spans.filter("span >= 100").isEmpty()
    assert built.heads.count() == built.heads.select("term", "block").distinct().count() <= blocks * 40


def test_scores_are_summed_where_the_postings_arrive(spark, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK_CHUNKS", 20)
    built = postings.build(chunks_df(spark, 500, 20))
    queries = spark.createDataFrame([(f"q{i}", f"w{i} w{i + 1} w{i + 2}") for i in range(30)], ["query_id", "query"])
    weighted = materialize(postings.weighted_terms(queries, built.terms))
    blocks = materialize(postings.block_bounds(weighted, built.heads))
    scored = postings._scored(blocks, weighted, built)
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan_of(scored))
    # no sum for a question and a chunk is shuffled, before it is known to be among the best
    assert not any("no#" in k for k in keys)
    found = {(r["query_id"], r["no"]): r["score"] for r in scored.collect()}
    avgdl = built.corpus.select("avgdl").scalar()
    plain = (
        built.rows.join(weighted, ["bucket", "term"])
        .groupBy("query_id", "no")
        .agg(F.sum(F.col("weight") * postings.impact(avgdl)).alias("score"))
        .filter("score > 0")
    )
    wanted = {(r["query_id"], r["no"]): r["score"] for r in plain.collect()}
    assert found.keys() == wanted.keys() and all(abs(found[k] - wanted[k]) < 1e-9 for k in wanted)


def test_chunks_of_one_place_share_their_postings(spark):
    """As in a table of repeated rows: each has the postings of both, and its bound allows for that."""
    df = chunks_df(spark, 60, 10)
    twice = df.unionByName(df.filter("doc_id < 'd000005'"))
    built = postings.build(twice)
    assert built.corpus.first()["n"] == 65 and built.rows.count() == 55 * 10 + 5 * 2 * 2 * 10
    queries = spark.createDataFrame([("q", "w1 w2")], ["query_id", "query"])
    found = [(r["chunk_id"], r["score"]) for r in postings.search(queries, built, 4).orderBy("rank").collect()]
    assert len({c for c, _ in found[:2]}) == 1 and found[0][1] == found[1][1]
