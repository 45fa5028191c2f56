"""The Jaccard join against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import LONG, ODD_TEXTS, SF_DIR, frame

from wardflow.llm import jaccard


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(found) < 5:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[k : k + 5]) for k in range(len(found) - 4))


def brute(rows):
    """(doc_id, n, smallest id reachable) of (doc_id, text)."""
    sets = [shingles(text) for _, text in rows]
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    having = {}
    for k, found in enumerate(sets):
        near = {}
        for s in found:
            for other in having.setdefault(s, []):
                near[other] = near.get(other, 0) + 1
            having[s].append(k)
        for other, overlap in near.items():
            if 100 * overlap >= 80 * (len(found) + len(sets[other]) - overlap):
                group[root(k)] = root(other)
    least = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            least[root(k)] = min(key, least.get(root(k), key))
    return sorted(((key, len(s), least.get(root(k))) for k, ((key, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def joined(docs):
    found = jaccard.similar(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted([tuple(r) for r in found.collect()], key=repr)


def test_shared_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    wanted = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert joined(docs) == wanted
    assert sum(key != least for key, _, least in wanted) > 5


def changed(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("block, close", [(512, True), (8, True), (8, False)])
def test_families_and_common_passages(spark, monkeypatch, block, close):
    """Chains, families around a base, passages in most texts, and every awkward text."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    if not close:  # everything is left to the pairs between components
        nothing = spark.createDataFrame([], "a long, b long")
        monkeypatch.setattr(jaccard, "_close_links", lambda rows: nothing)
    rng = random.Random(block)
    passage = [f"p{k}" for k in range(40)]
    texts = []
    for size in (8, 30, 120):
        base = [f"w{rng.randrange(500)}" for _ in range(size)]
        texts += [changed(base, rng.randrange(1 + size // 12), rng) for _ in range(25)]
    chain = [f"c{k}" for k in range(60)]
    for k in range(30):
        chain[k] = f"d{k}"
        texts.append(" ".join(chain))
    for k in range(80):
        own = [f"o{k}x{i}" for i in range(rng.choice([2, 6, 9, 14]))]
        texts.append(" ".join(own + passage) if k % 2 else " ".join(passage + own))
    texts += [*ODD_TEXTS, LONG, LONG.upper(), "a b c d", "A  b\tc d", "a b c d e", "\x00 \x00", None, None, "x"]
    texts += ["one two three four five six"] * 9
    rng.shuffle(texts)
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "without a key at all here"), (None, texts[0]), (5, texts[5])]
    docs = frame(spark, [(k, t, "en", "s") for k, t in rows])
    assert joined(docs) == brute(rows)


def test_no_documents(spark):
    assert joined(frame(spark, [])) == []


def test_sets_of_a_piece():
    texts = ["a b c d e f", "", None, "x y", "q q q q q q q", " B  c\n\x00 "]
    found, bounds = jaccard.shingle_sets(pa.array([t or "" for t in texts]))
    assert np.diff(bounds).tolist() == [len(shingles(t)) for t in texts]
    assert len(set(found.tolist())) == sum(len(shingles(t)) for t in texts)


def test_block_links_connect_what_is_linked():
    rng = random.Random(3)
    rows = [sorted(set(rng.choices(range(14), k=12))) for _ in range(200)]
    n = np.array([len(r) for r in rows])
    bounds = np.r_[0, np.cumsum(n)]
    links = jaccard.block_links(np.arange(200), n, np.concatenate(rows), bounds)
    group = list(range(200))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a, b in links:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            assert jaccard.linked(len(set(rows[x]) & set(rows[y])), n[x], n[y])
            group[root(x)] = root(y)
    assert sum(len(a) for a, _ in links) == 200 - len({root(k) for k in range(200)})
    for x in range(200):
        for y in range(x):
            if jaccard.linked(len(set(rows[x]) & set(rows[y])), n[x], n[y]):
                assert root(x) == root(y)
