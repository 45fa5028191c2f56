"""Language, quality and toxicity models; the pipeline."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import numpy as np
import pytest
from llm_fixtures import SF_DIR, documents, frame, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardflow.llm import decontaminate, language, quality, secrets, simhash, toxicity
from wardflow.llm.batches import ready
from wardflow.llm.queries import ORACLE_SQL, QUERIES
from wardflow.llm.terms import held_out

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def shared(spark):
    ready(spark)
    return {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "pages")}


def test_languages_agree_with_their_declarations(shared):
    rows = language.identify(shared["documents"]).select("doc.lang", "language", "kept").collect()
    assert len(rows) == shared["documents"].count()
    assert np.mean([r.lang == r.language for r in rows]) > 0.97
    assert all(r.kept for r in rows)


def test_text_alone_tells_the_language(spark, shared):
    docs = shared["documents"]
    model = spark.sparkContext.broadcast(language.learn(docs))
    blind = docs.select("doc_id", "text", F.col("lang").alias("true"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"))
    rows = language.identified(blind, language.host_priors(docs), model).select("doc.true", "language").collect()
    assert np.mean([r.true == r.language for r in rows]) > 0.97


def test_awkward_rows_and_evidence(spark, shared):
    docs = shared["documents"]
    model = spark.sparkContext.broadcast(language.learn(docs))
    rows = [(1, "", "en", "src0"), (2, None, "de", "src0"), (3, "12 !?", "en", None), (4, "la", "fr", None)]
    rows += [(5, "la", "es", None), (6, "la", None, "host.of.es"), (7, "字" * 400, "en", "src0")]
    table = frame(spark, rows)
    hosts = spark.createDataFrame([("es", "a.of.es")] * 50 + [("es", "host.of.es"), (None, None)], "lang string, source string")
    found = language.identified(table, language.host_priors(hosts), model)
    got = {r.doc_id: (r.language, r.kept) for r in found.select("doc.*", "language", "kept").collect()}
    assert [got[k] for k in (1, 2, 3, 7)] == [("und", False)] * 4
    assert [got[k][0] for k in (4, 5, 6)] == ["fr", "es", "es"]
    assert found.select("doc.*").columns == table.columns
    empty = language.identify(table.limit(0))
    assert empty.count() == 0


def test_host_priors_lean_on_their_parents(spark):
    rows = [("de", "a.x.org")] * 40 + [("en", "b.y.org")] * 40 + [("fr", "new.x.org")]
    priors = language.host_priors(spark.createDataFrame(rows, "lang string, source string"))
    prior = {r.host: np.exp(r.prior) for r in priors.collect()}
    assert prior["new.x.org"][1] > prior["new.x.org"][2] > prior["new.x.org"][3]
    assert prior["b.y.org"][0] > 0.7
    assert all(abs(sum(p) - 1) < 1e-9 for p in prior.values())


def test_pages(shared):
    pages = language.page_evidence(shared["pages"])
    rows = language.identify(pages, key="page_id", suffix=F.col("suffix")).select("doc.lang", "language").collect()
    assert np.mean([r.lang == r.language for r in rows]) > 0.97


def test_toxicity_on_held_out_rows(shared):
    rows = toxicity.score(shared["documents"], shared["labels"]).join(shared["labels"], "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_a_pair_is_worse_than_its_parts(spark):
    """Only an insult together with a group is toxic: additive weights cannot say that."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for k in range(600):
        insult, group = (rng.random(2) < 0.5).tolist()
        noise = [f"w{x}" for x in rng.integers(0, 30, 4)]
        rows.append((k, " ".join([*noise, *["dolt"] * insult, *["folk"] * group]), "en", "a"))
        labels.append((k, 1, int(insult and group)))
    docs = frame(spark, rows)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.score(docs, table).collect()}
    held = [k for k in found if found[k].held_out]
    assert len(held) > 60
    assert np.mean([found[k].predicted == labels[k][2] for k in held]) == 1


def test_models_on_awkward_rows(spark, shared):
    docs, labels = documents(spark), shared["labels"]
    for run in (toxicity.score, quality.grade):
        assert run(docs, labels).count() == docs.count()
        assert run(docs.limit(0), labels).count() == 0
        none = run(docs, labels.limit(0)).collect()
        assert len(none) == docs.count()
    scores = toxicity.score(docs, labels.limit(0)).select("score").distinct().collect()
    assert [round(r.score, 6) for r in scores] == [0.5]
    strange = spark.createDataFrame([(10, None, None), (None, 1, 1), (11, 0, 1)], "doc_id long, quality int, toxic int")
    assert quality.grade(docs, strange).count() == docs.count()


def test_quality_on_held_out_rows(shared):
    rows = quality.grade(shared["documents"], shared["labels"]).join(shared["labels"], "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.kept == (r.quality == 1) for r in held]) > 0.95
    assert all(0 <= r.expected_grade <= quality.GRADES - 1 for r in rows)
    grade = [0 if r.quality == 0 else 2 - r.toxic for r in held]
    assert np.mean(np.abs(np.array([r.expected_grade for r in held]) - grade)) < 0.3


def test_held_out_is_a_fifth(spark):
    rows = spark.range(5000).select(held_out(F.col("id")).alias("x")).collect()
    assert 0.17 < np.mean([r.x for r in rows]) < 0.23


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14))
    assert "pipeline" in QUERIES and set(ORACLE_SQL) <= set(QUERIES)
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_stages(spark, tmp_path):
    """Each stage against plain Python on its own input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = docs.withColumn("row", F.lit(1)).unionByName(
        documents(spark).select(*docs.columns, F.lit(2).alias("row"))
    )
    bench = [words(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        kept, given = after.collect(), docs.collect()
        if k < 4:
            assert after.columns == docs.columns
        if name == "language ID":
            assert all(r.text for r in kept) and len(kept) >= 200
        elif name == "SimHash near-dedup":
            prints = {simhash.fingerprint(r.text.encode()) for r in kept}
            assert len(prints) == len(kept)
            near = simhash.near_duplicates(docs).collect()
            assert {r.doc_id for r in kept if r.doc_id is not None} == {r.component_id for r in near} - {None}
        elif name == "benchmark decontamination":
            windows = {tuple(w[i : i + 10]) for w in bench for i in range(max(1, len(w) - 9))}
            def clean(r):
                w = words(r.text)
                return not any(tuple(w[i : i + 10]) in windows for i in range(len(w)))
            assert sorted(str(r.doc_id) for r in kept) == sorted(str(r.doc_id) for r in given if clean(r))
        elif name == "secret scans":
            scanner = secrets.Scanner()
            wanted = {r.doc_id: scanner.redacted(r.text, "[secret]") for r in given}
            assert {r.doc_id: r.text for r in kept} == wanted
            assert all(r.n_chars == len(r.text) for r in kept)
        else:
            assert len(kept) == len(given) and set(docs.columns) < set(after.columns)
            plain = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
            assert sorted(map(repr, given)) == sorted(repr(r) for r in after.select(docs.columns).collect())
            for r in kept:
                ids = np.frombuffer(r.ids, "<u4").tolist()
                assert len(ids) == r.n_tokens and hashlib.sha256(r.ids).hexdigest() == r.ids_sha256
                assert plain.decode(ids, skip_special_tokens=False) == r.text
                assert hashlib.sha256(r.text.encode()).hexdigest() == r.decoded_sha256
        docs = after


def test_pipeline_of_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.count() == 0


def test_decontamination_reads_the_benchmark_by_its_own_names(spark):
    docs = frame(spark, [(1, "q w e", "en", "a"), (2, "z", "en", "a")])
    bench = spark.createDataFrame([("q w", "x1")], "question string, name string")
    found = decontaminate.contamination(docs, bench, ["doc_id"], item="name", item_text="question")
    assert {r.doc_id: r["items"] for r in found.collect()} == {1: ["x1"], 2: []}


def test_language_query_covers_documents_and_pages(spark, shared):
    rows = QUERIES["op7_language_id"](spark, SF).collect()
    docs, pages = shared["documents"].collect(), shared["pages"].collect()
    assert sorted(r.doc_id for r in rows if r.page_id is None) == sorted(r.doc_id for r in docs)
    assert sorted(r.page_id for r in rows if r.doc_id is None) == sorted(r.page_id for r in pages)
    declared = {r.page_id: r.lang for r in language.page_evidence(shared["pages"]).collect()}
    found = {r.page_id: r.language for r in rows if r.doc_id is None}
    assert np.mean([found[k] == declared[k] for k in found]) > 0.97


def test_address_suffix_counts(spark):
    texts = {"de": "und der die das", "en": "the and of to"}
    rows = [
        (k, f"http://a{k}.example.org/", f'<html lang="{x}">{texts[x]}</html>')
        for k, x in enumerate(["de", "en"] * 20)
    ]
    both = f"<html>{texts['de']} {texts['en']}</html>"
    rows += [(100, "http://x.de/", both), (101, "http://x.uk/", both), (102, "http://x.org/", both), (103, "http://x.org/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    rows = language.identify_pages(pages).select("doc.page_id", "language", "probability").collect()
    found = {r.page_id: r for r in rows}
    assert len(found) == 44 and found[103].language == "und"
    assert {found[k].language for k in (100, 101, 102)} == {"de"}
    assert found[100].probability > found[102].probability > found[101].probability
