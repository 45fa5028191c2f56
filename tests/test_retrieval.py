from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.config import Settings
from wardflow.functions.embedding import HashedWords, embed
from wardflow.functions.vectors import cosine
from wardflow.operators import answer as an
from wardflow.operators import cells
from wardflow.operators import postings
from wardflow.operators import retrieval as rt
from wardflow.operators import topk

WORDS = "oxygen target adult sepsis screen call team repeat pulse fever fluid dose the of and".split()


def chunks_df(spark, texts, per_doc=3):
    rows = [
        (f"d{i // per_doc:03d}::{i % per_doc}", f"d{i // per_doc:03d}", f"T{i}", "s", "t", f"H{i}", i % per_doc, t)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(
        rows,
        "chunk_id string, doc_id string, title string, source string, topic string,"
        " heading string, ordinal int, text string",
    ).repartition(3)


def queries_df(spark, texts):
    return spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(texts)], ["query_id", "query"])


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(WORDS, k=rng.randint(0, 25))) for _ in range(60)]
    texts += [texts[3]] * 25  # a third of all chunks are copies
    return texts, chunks_df(spark, texts).cache()


QUERIES = ["oxygen target adult", "the of and", "sepsis sepsis screen", "gift shop", "dose fluid fever"]


def tokenize(text):
    return re.findall("[a-z0-9]+", text.lower())


def okapi(texts, query):
    """BM25 written out term by term."""
    docs = [tokenize(t) for t in texts]
    n, avgdl = len(docs), sum(map(len, docs)) / len(docs)
    df = {t: sum(t in d for d in docs) for d in docs for t in d}
    idf = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {t: v if v >= 0 else floor for t, v in idf.items()}
    scores = []
    for d in docs:
        total = 0.0
        for t in tokenize(query):
            tf = d.count(t)
            total += idf.get(t, 0) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(d) / avgdl))
        scores.append(total)
    return scores


def best(ids, scores, k, positive):
    order = sorted(range(len(ids)), key=lambda i: (-round(scores[i], 8), ids[i]))[:k]
    return [ids[i] for i in order if not positive or scores[i] > 0]


def listed(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["chunk_id"])
    return out


def ids_of(texts, per_doc=3):
    return [f"d{i // per_doc:03d}::{i % per_doc}" for i in range(len(texts))]


@pytest.mark.parametrize("chunks, first", [(postings.BLOCK_CHUNKS, 4), (3, 1)])
def test_bm25_equals_brute_force(spark, corpus, chunks, first, monkeypatch):
    texts, df = corpus
    monkeypatch.setattr(postings, "BLOCK_CHUNKS", chunks)
    monkeypatch.setattr(postings, "FIRST_BLOCKS", first)
    got = listed(rt.bm25_search(queries_df(spark, QUERIES), df, 10))
    for i, query in enumerate(QUERIES):
        expected = best(ids_of(texts), okapi(texts, query), 10, positive=True)
        assert got.get(f"q{i}", []) == expected, query


def test_two_thousand_questions_take_the_same_way(spark):
    """Four blocks, each against the corpus where it lies."""
    rng = np.random.default_rng(8)
    vectors, wanted = rng.normal(size=(40, 4)), rng.normal(size=(2000, 4))
    index = spark.createDataFrame(
        [(f"v{i:02d}", f"v{i:02d}", 0, v.tolist()) for i, v in enumerate(vectors)],
        "chunk_id string, doc_id string, ordinal int, embedding array<double>",
    )
    queries = spark.createDataFrame(
        [(f"q{i:04d}", v.tolist()) for i, v in enumerate(wanted)],
        "query_id string, embedding array<double>",
    )
    got = listed(rt.dense_search(queries, index, 3))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for i, w in enumerate(wanted):
        scores = unit @ w / np.linalg.norm(w)
        assert got[f"q{i:04d}"] == best([f"v{k:02d}" for k in range(40)], list(scores), 3, positive=False)


def test_bm25_scores(spark, corpus):
    texts, df = corpus
    found = rt.bm25_search(queries_df(spark, QUERIES[:1]), df, 5).collect()
    by_id = dict(zip(ids_of(texts), okapi(texts, QUERIES[0])))
    assert all(abs(r["score"] - by_id[r["chunk_id"]]) < 1e-8 for r in found)


def test_bm25_by_hand(spark):
    """Three documents; "a" is in two of them, so its idf is negative and floored."""
    df = chunks_df(spark, ["a b", "a c c", "d"], per_doc=1)
    idf_rare = math.log(2.5) - math.log(1.5)
    idf_a = math.log(1.5) - math.log(2.5)
    floor = 0.25 * (3 * idf_rare + idf_a) / 4
    terms = {r["term"]: r["idf"] for r in rt.term_statistics(df).terms.collect()}
    assert terms["a"] == pytest.approx(floor) and terms["c"] == pytest.approx(idf_rare)
    [hit] = rt.bm25_search(queries_df(spark, ["c"]), df, 5).collect()
    assert hit["score"] == pytest.approx(idf_rare * 2 * 2.5 / (2 + 1.5 * (0.25 + 0.75 * 3 / 2)))


@pytest.mark.parametrize("limit", [topk.QUERY_BLOCK, 2])
def test_dense_equals_numpy(spark, limit, monkeypatch):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 16)).astype(np.float32)
    vectors[200:] = vectors[7]  # copies: a third of all rows tie
    vectors[5] = 0
    wanted = rng.normal(size=(7, 16)).astype(np.float32)
    rows = [(f"v{i:03d}", f"v{i:03d}", 0, v.tolist()) for i, v in enumerate(vectors)]
    index = spark.createDataFrame(rows, "chunk_id string, doc_id string, ordinal int, embedding array<float>")
    queries = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(wanted)], "query_id int, embedding array<float>"
    )
    original = topk.best_matches
    monkeypatch.setattr(rt, "best_matches", lambda *a: original(*a, query_block=limit))
    monkeypatch.setattr(topk, "BLOCK_ROWS", 37)
    got = listed(rt.dense_search(queries, index.repartition(4), 20))
    v64, w64 = vectors.astype(float), wanted.astype(float)
    lengths = np.linalg.norm(v64, axis=1)
    for i, w in enumerate(w64):
        scores = np.divide(v64 @ w, lengths * np.linalg.norm(w), out=np.zeros(300), where=lengths > 0)
        assert got[i] == best([r[0] for r in rows], list(scores), 20, positive=False)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_of_the_searches(spark, corpus):
    """BM25 is joins and sums on the JVM; a dense search returns a task's best k."""
    _, df = corpus
    plan = plan_of(rt.bm25_search(queries_df(spark, ["the of and"]), df, 4))
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))
    index = spark.createDataFrame([("c", "d", 0, [1.0])], "chunk_id string, doc_id string, ordinal int, embedding array<double>")
    plan = plan_of(rt.dense_search(index.select(F.lit(1).alias("query_id"), "embedding"), index, 4))
    assert "MapInArrow" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_postings_hold_every_term_once(spark, corpus):
    texts, df = corpus
    built = postings.build(df)
    wanted = {}
    for i, text in enumerate(texts):
        for term in tokenize(text):
            wanted[ids_of(texts)[i], term] = wanted.get((ids_of(texts)[i], term), 0) + 1
    rows = built.rows.join(built.names.select("no", "chunk_id"), "no").collect()
    assert {(r["chunk_id"], r["term"]): r["tf"] for r in rows} == wanted and len(rows) == len(wanted)
    heads = {(r["term"], r["block"]): r for r in built.heads.collect()}
    for r in rows:
        assert r["length"] == len(tokenize(texts[ids_of(texts).index(r["chunk_id"])]))
        assert heads[r["term"], r["block"]]["most"] > 0
    assert sum(h["df"] for h in heads.values()) == len(wanted)
    order = built.names.orderBy("no").select("chunk_id").collect()
    assert [r["chunk_id"] for r in order] == sorted(ids_of(texts))


def test_stored_postings_search_alike(spark, corpus, tmp_path):
    """Written, read, and pruned: blocks below a question's floor are not scored."""
    texts, df = corpus
    postings.write(df, str(tmp_path / "index"))
    assert len(list((tmp_path / "index/rows").glob("bucket=*"))) > 1
    stored = postings.read(spark, str(tmp_path / "index"))
    queries = queries_df(spark, QUERIES)
    assert listed(postings.search(queries, stored, 7)) == listed(rt.bm25_search(queries, df, 7))


def test_blocks_below_the_floor_are_left_out(spark, monkeypatch):
    texts = ["rare words here"] * 5 + [f"common filler number {k}" for k in range(200)]
    df = chunks_df(spark, texts, per_doc=1)
    monkeypatch.setattr(postings, "BLOCK_CHUNKS", 4)
    asked, scored = [], postings._scored
    monkeypatch.setattr(postings, "_scored", lambda blocks, *a: asked.append(blocks.count()) or scored(blocks, *a))
    built = postings.build(df)
    found = postings.search(queries_df(spark, ["rare words common"]), built, 3).collect()
    assert len(found) == 3 and {r["chunk_id"] for r in found} <= set(ids_of(texts, 1)[:5])
    assert built.heads.select("block").distinct().count() > 20 and sum(asked) < 12


def test_awkward_postings(spark):
    empty = chunks_df(spark, ["x"]).filter("false")
    assert postings.search(queries_df(spark, ["x"]), postings.build(empty), 3).count() == 0
    df = chunks_df(spark, ["", None, "one ONE one-two", "..."], per_doc=1)
    built = postings.build(df)
    assert built.corpus.first()["n"] == 4 and {(r["term"], r["tf"]) for r in built.rows.collect()} == {("one", 3), ("two", 1)}
    [hit] = postings.search(queries_df(spark, ["two", "", None, "zzz"]), built, 3).collect()
    assert hit["query_id"] == "q0" and hit["chunk_id"] == "d002::0"


def test_rrf(spark):
    """Three rankers over a handful of chunks, against the sum written out."""
    lists = {"one": "kmpqz", "two": "zpx", "three": "qyzk"}
    rows = [("q", ranker, c, i + 1) for ranker, ids in lists.items() for i, c in enumerate(ids)]
    rankings = spark.createDataFrame(rows, ["query_id", "ranker", "chunk_id", "rank"])
    for k in (60, 7):
        found = rt.reciprocal_rank_fusion(rankings, k).collect()
        wanted = {c: sum(1 / (k + 1 + ids.index(c)) for ids in lists.values() if c in ids) for c in "kmpqzxy"}
        assert {r["chunk_id"]: r["rrf_score"] for r in found} == pytest.approx(wanted)


def test_fused_ties_keep_dense_first(spark):
    def ranking(ids):
        return spark.createDataFrame([("q", c, c, 0, i + 1) for i, c in enumerate(ids)],
                                     "query_id string, chunk_id string, doc_id string, ordinal int, rank int")

    rows = rt.fuse_rankings(ranking(["x", "y"]), ranking(["a", "x"])).orderBy("fused_rank").collect()
    assert [r["chunk_id"] for r in rows] == ["x", "a", "y"]
    assert [(r["dense_rank"], r["bm25_rank"]) for r in rows] == [(1, 2), (None, 1), (2, None)]


def test_cosine(spark):
    rows = [([1.0, 0.0], [0.0, 2.0]), ([1.0, 2.0], [2.0, 4.0]), ([0.0, 0.0], [1.0, 1.0])]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    got = [r["c"] for r in df.select(cosine(F.col("a"), F.col("b")).alias("c")).collect()]
    assert got == pytest.approx([0.0, 1.0, 0.0])


def test_hashed_words_are_stable():
    model = HashedWords(16)
    a, b, c = model.encode(["Oxygen target", "target OXYGEN!", ""])
    assert (a == b).all() and a.sum() == 2 and c.sum() == 0


def test_a_custom_model_plugs_in(spark):
    class Lengths:
        def encode(self, texts):
            return np.array([[len(t), 1.0] for t in texts], dtype=np.float32)

    df = spark.createDataFrame([("abc",), ("",)], "t string")
    assert [r["e"] for r in df.select(embed(F.col("t"), Lengths).alias("e")).collect()] == [
        [3.0, 1.0], [0.0, 1.0],
    ]


# answers

GUIDES = [
    "Target an oxygen saturation of 94-98 percent in acutely unwell adults. "
    "Start oxygen at once when saturation is low. Too short. Recheck blood gases within one hour.",
    "Screen for sepsis when the early warning score is five or more. Take blood cultures first. "
    "Give antibiotics within one hour of recognition.",
    "Offer paracetamol for fever. - **Cool** the room and offer cold drinks to the patient.",
    "Fluid bolus of 500 ml over fifteen minutes for low blood pressure. Reassess after each bolus.",
    "The of and the of and the of and.",
    "Call the outreach team and the of and repeat observations.",
    "Document the escalation and the whole plan of care in the notes.",
]


@pytest.fixture(scope="module")
def index(spark):
    return rt.index_rows(chunks_df(spark, GUIDES, per_doc=1)).cache()


@pytest.fixture(scope="module")
def answers(spark, index):
    queries = queries_df(
        spark,
        [
            "What oxygen saturation should we target in acutely unwell adults?",
            "When do we screen for sepsis and give antibiotics?",
            "What time does the hospital gift shop close on Sundays?",
            "...",
        ],
    )
    out = an.answer_questions(queries, index, Settings(root="unused"))
    return {r["query_id"]: r for r in out.collect()}


def test_answer_is_grounded_and_cited(answers):
    a = answers["q0"]
    assert not a["refused"] and "94-98" in a["answer"] and "[1]" in a["answer"]
    markers = {int(m) for m in re.findall(r"\[(\d+)\]", a["answer"])}
    cited = {c["marker"]: c for c in a["citations"]}
    assert markers <= set(cited) and list(cited) == list(range(1, len(cited) + 1))
    assert cited[1]["chunk_id"] == "d000::0" and cited[1]["title"] == "T0"
    assert [c["chunk_id"] for c in a["contexts"]] == [c["chunk_id"] for c in a["citations"]]
    assert "Too short." not in a["answer"]
    for sentence in re.split(r" \[\d+\] ?", a["answer"]):
        assert any(sentence in re.sub(r"- \*\*(\w+)\*\*", r"\1", c["text"]) for c in a["contexts"])
    assert answers["q1"]["citations"][0]["chunk_id"] == "d001::0"


def test_trace_lists_ranks_best_first(answers):
    trace = answers["q0"]["retrieval"]
    assert trace[0]["chunk_id"] == "d000::0"
    assert trace[0]["dense_rank"] == 1 and trace[0]["bm25_rank"] == 1
    scores = [t["rrf_score"] for t in trace]
    assert scores == sorted(scores, reverse=True) and len(trace) <= 12


@pytest.mark.parametrize("query_id", ["q2", "q3"])
def test_off_topic_is_refused_with_its_trace(answers, query_id):
    a = answers[query_id]
    assert a["refused"] and a["answer"] == an.REFUSAL
    assert a["citations"] == [] and a["contexts"] == [] and a["retrieval"]


def test_relevance_cut(spark):
    rows = [("q", m, s) for m, s in [(1, -1.0), (2, -2.0), (3, 0.5), (4, 0.0), (5, -0.1)]]
    df = spark.createDataFrame(rows, ["query_id", "marker", "score"])
    assert sorted(r["marker"] for r in an.relevant_chunks(df).collect()) == [1, 2, 3]
    assert an.accepted(df, 0.5).count() == 5 and an.accepted(df, 0.6).count() == 0


def test_repeated_sentences_are_picked_once_and_ordered_by_marker(spark):
    rows = [
        ("q", "alpha beta gamma delta", 2, 0, "alpha beta gamma delta"),
        ("q", "alpha beta gamma delta", 1, 0, "alpha beta other words"),
        ("q", "alpha beta gamma delta", 3, 0, "alpha beta gamma delta"),
        ("q", "alpha beta gamma delta", 1, 1, "nothing in common here"),
    ]
    df = spark.createDataFrame(rows, ["query_id", "query", "marker", "position", "sentence"])
    picked = an.pick_sentences(df, max_sentences=2)
    assert an.assemble(picked).first()["answer"] == "alpha beta other words [1] alpha beta gamma delta [2]"


def test_a_pair_model_plugs_in(spark, index):
    class Shortest:
        def score(self, queries, texts):
            return [-float(len(t)) for t in texts]

    queries = queries_df(spark, ["oxygen sepsis the"])
    hits = rt.hybrid_search(queries, index)
    pairs = an.candidate_pairs(queries, hits, index, 12)
    top = an.rerank(pairs, an.model_scorer(Shortest), 2).orderBy("marker").collect()
    lengths = sorted((len(t), i) for i, t in enumerate(GUIDES))
    assert [r["chunk_id"] for r in top] == [f"d{i:03d}::0" for _, i in lengths[:2]]


def test_gold_window_links_to_cited_guidance(spark, index):
    from helpers import SEVERE, silver, silver_row

    from wardflow.operators import gold as g

    rows = [silver_row("a", **SEVERE), silver_row("b", "P100002", heart_rate=75, temperature_c=36.25)]
    gold = g.aggregate_gold(silver(spark, rows))
    questions = {r["patient_id"]: r["query"] for r in an.window_queries(gold).collect()}
    assert questions["P100001"] == (
        "NEWS2 17 (high risk), respiratory rate 27, SpO2 90% on oxygen, systolic BP 94, "
        "heart rate 118, temperature 39.9. Recommended escalation and immediate management?"
    )
    assert "SpO2 97%, systolic" in questions["P100002"] and "temperature 36.2." in questions["P100002"]
    out = an.explain_gold_window(gold, index, Settings(root="x", min_rerank_score=-9))
    [row] = out.collect()
    assert row["patient_id"] == "P100001" and row["query"] == questions["P100001"]
    assert not row["refused"] and row["citations"]


def vector_rows(spark, vectors):
    rows = [(f"v{i:04d}", f"v{i:04d}", 0, v.tolist()) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "chunk_id string, doc_id string, ordinal int, embedding array<float>")


def test_approximate_search(spark):
    """All cells give the exact lists; tuned probes give nine tenths of them on other questions."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 12))
    vectors = (centres[rng.integers(0, 30, 2000)] + 0.7 * rng.normal(size=(2000, 12))).astype(np.float32)
    vectors[:300] = vectors[0]  # a cell with many equal rows
    vectors[300] = 0
    index = vector_rows(spark, vectors)
    queries = spark.createDataFrame([(i, vectors[i].tolist()) for i in range(0, 2000, 25)], "query_id int, embedding array<float>")
    built = cells.build(index, cells=16)
    assert built.rows.count() == 2000 and 1 < built.rows.select("cell").distinct().count() <= 16
    exact = rt.dense_search(queries, index, 10)
    assert listed(cells.search(queries, built, 10, probes=16)) == listed(exact)
    probes = cells.tuned_probes(queries, built, 10)
    found = cells.search(queries, built, 10, probes)
    assert probes < 16 and cells.recall(found, exact) >= 0.9
    one = {(r["query_id"], r["chunk_id"]): r["score"] for r in found.collect()}
    for r in exact.collect():  # what is found has the exact score
        assert one.get((r["query_id"], r["chunk_id"]), r["score"]) == r["score"]


def test_recall_counts_exact_hits(spark):
    pairs = lambda *rows: spark.createDataFrame(rows, "query_id int, chunk_id string")
    assert cells.recall(pairs((1, "a"), (1, "x")), pairs((1, "a"), (1, "b"))) == 0.5
    assert cells.recall(pairs((2, "a")), pairs((1, "a"))) == 0
    nothing = pairs((1, "a")).filter("false")
    assert cells.recall(nothing, nothing) == 1
