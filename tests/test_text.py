from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardflow.functions import text as tx
from wardflow.operators.chunking import build_chunks, chunk_documents, section_rows
from wardflow.sources.corpus import parse_documents, read_corpus


def document(spark, body, doc_id="d"):
    row = (doc_id, "Title", "src", "topic", body)
    return spark.createDataFrame([row], ["doc_id", "title", "source", "topic", "body"])


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t")).alias("x")).first()["x"]


def test_headings_and_metadata(spark):
    body = "# Airway\nLift the chin.\n### Suction\nKeep it short.\nLook first.\n\n# Notes\nSign them."
    rows = chunk_documents(document(spark, body, "g7")).orderBy("ordinal").collect()
    assert [(r["chunk_id"], r["heading"], r["text"]) for r in rows] == [
        ("g7::0", "Airway", "Lift the chin."),
        ("g7::1", "Suction", "Keep it short. Look first."),
        ("g7::2", "Notes", "Sign them."),
    ]
    assert {(r["title"], r["source"], r["topic"]) for r in rows} == {("Title", "src", "topic")}
    assert [r["ordinal"] for r in rows] == [0, 1, 2]


@pytest.mark.parametrize("n", [1, 129, 130, 131, 230, 231, 777])
def test_long_section_windows(spark, n):
    """Windows of 130 words start every 100 words, until one reaches the end."""
    body = "## Long\n" + " ".join(str(k) for k in range(n))
    rows = chunk_documents(document(spark, body)).orderBy("ordinal").collect()
    found = [[int(w) for w in r["text"].split()] for r in rows]
    starts = [0]
    while starts[-1] + 130 < n:
        starts.append(starts[-1] + 100)
    assert found == [list(range(k, min(k + 130, n))) for k in starts]


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ("lead in\n# A\ntext", [("A", "text")]),
        ("# A\n\n## B\ntext", [("B", "text")]),
        ("no heading at all", [("", "no heading at all")]),
        ("", [("", "")]),
        ("#\nfoo\nbar", [("foo", "bar")]),
        ("####### seven\nx", [("", "####### seven\nx")]),
        ("#tag\nx", [("", "#tag\nx")]),
        ("# only", []),
        ("a\n# A #\nx\ny\n###### Deep\nz", [("A #", "x\ny"), ("Deep", "z")]),
    ],
)
def test_section_rules(spark, body, expected):
    rows = section_rows(document(spark, body)).orderBy("position").collect()
    assert [(r["heading"], r["text"]) for r in rows] == expected


def test_preamble_and_empty_are_options(spark):
    rows = section_rows(document(spark, "lead in\n# A\ntext"), keep_preamble=True).collect()
    assert [(r["heading"], r["text"]) for r in rows] == [("", "lead in"), ("A", "text")]
    assert chunk_documents(document(spark, "")).first()["text"] == ""
    assert chunk_documents(document(spark, ""), drop_empty=True).count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12))
def test_window_count_and_coverage(spark, sizes):
    df = spark.createDataFrame([(n, " ".join(f"w{i}" for i in range(n))) for n in sizes], ["n", "t"])
    for row in df.select("n", tx.word_windows(F.col("t")).alias("w")).collect():
        n, windows = row["n"], row["w"]
        assert len(windows) == (1 if n <= 130 else 1 + math.ceil((n - 130) / 100))
        assert {w for piece in windows for w in piece.split()} == {f"w{i}" for i in range(n)}
        assert windows[-1].split()[-1:] == ([f"w{n - 1}"] if n else [])


def test_front_matter(spark):
    files = [
        ("a", "---\ntitle: T: sub\nsource:  S \nnot a pair\ntitle: Last: one\n---\n# H\nx"),
        ("b", "---\r\ntopic: t\r\n---\r\nbody\r\nline"),
        ("c", "no front matter\n---\ntitle: x\n---\n"),
        ("d", "---\ntitle:\n---\nbody"),
    ]
    out = parse_documents(spark.createDataFrame(files, ["doc_id", "value"])).orderBy("doc_id").collect()
    assert [tuple(r) for r in out] == [
        ("a", "Last: one", "S", "", "# H\nx"),
        ("b", "b", "unknown", "t", "body\nline"),
        ("c", "c", "unknown", "", "no front matter\n---\ntitle: x\n---"),
        ("d", "", "unknown", "", "body"),
    ]


def test_corpus_folder(spark, tmp_path):
    (tmp_path / "b guide+1.md").write_text("---\ntitle: B\n---\n# H\nbody text")
    (tmp_path / "a.md").write_text("plain body")
    (tmp_path / "ReadMe.md").write_text("# x\ny")
    (tmp_path / "note.txt").write_text("not markdown")
    docs = read_corpus(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [(d["doc_id"], d["title"]) for d in docs] == [("a", "a"), ("b guide+1", "B")]
    chunks = build_chunks(spark, str(tmp_path)).orderBy("doc_id", "ordinal").collect()
    assert [c["chunk_id"] for c in chunks] == ["a::0", "b guide+1::0"]


def test_tokens(spark):
    assert one(spark, "SpO2 94-98%, Größe naïve", tx.tokens) == [
        "spo2", "94", "98", "gr", "e", "na", "ve",
    ]
    assert one(spark, "...", tx.tokens) == []


def test_words_follow_unicode_whitespace(spark):
    assert one(spark, " a b\n c ", tx.words) == ["a", "b", "c"]
    assert one(spark, "   ", tx.words) == []


def test_sentences_and_cleaning(spark):
    text = "One is here. Two (see 3.5 mg) now! - **Bold** item? lower stays. 9 more"
    assert one(spark, text, tx.sentences) == [
        "One is here.", "Two (see 3.5 mg) now!", "- **Bold** item? lower stays.", "9 more",
    ]
    assert one(spark, " -  **Give** a\n **lot  of** it ", tx.clean_sentence) == "Give a lot of it"
    assert one(spark, "*not a list* here", tx.clean_sentence) == "*not a list* here"
