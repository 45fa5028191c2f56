"""Decontamination, SimHash, components and top-k against brute force."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF_DIR, documents, frame, words
from pyspark.sql import functions as F

from wardflow.llm import decontaminate, simhash, topk_search
from wardflow.llm.components import components


def brute_hits(docs, benchmark):
    windows = {}
    for item, text in benchmark:
        found = words(text)
        for k in range(max(1, len(found) - 9) if found else 0):
            windows.setdefault(tuple(found[k : k + 10]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for key, text in docs:
        found, hit, items = words(text), set(), set()
        for n in sizes:
            for k in range(len(found) - n + 1):
                named = windows.get(tuple(found[k : k + n]))
                if named:
                    items |= named
                    hit |= set(range(k, k + n))
        out.append((key, len(found), len(hit), sorted(items)))
    return sorted(out, key=repr)


def hits(docs, benchmark):
    rows = decontaminate.contamination(docs, benchmark, ["doc_id"]).collect()
    return sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in rows], key=repr)


def test_hits_of_the_shared_tables(spark):
    docs, bench = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    wanted = brute_hits(
        [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()]
    )
    assert hits(docs, bench) == wanted
    assert sum(n for _, _, n, _ in wanted) > 0


def test_hits_of_awkward_rows(spark):
    ten = "one two three four five six seven eight nine ten"
    bench = [(1, ten + " eleven"), (2, "Short Item!"), (3, "x"), (4, None), (5, "..."), (6, ten)]
    bench += [(11, "a a a a a a a a a a a a"), (1, ten + " eleven"), (None, "never counted words")]
    rows = [(1, f"zero {ten} eleven twelve"), (2, f"{ten[4:]} {ten}"), (3, "a " * 30), (4, "short; ITEM")]
    rows += [(5, None), (6, ""), (7, "x-x x"), (7, "x-x x"), (None, ten.upper()), (8, "never counted words")]
    rows += [(9, "short"), (10, "item short item"), (12, "a a a a a a a a a")]
    docs = frame(spark, [(k, t, "en", "a") for k, t in rows])
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    known = [(i, t) for i, t in bench if i is not None and t is not None]
    assert hits(docs, benchmark) == brute_hits(rows, known)
    assert [h[2] for h in hits(docs, benchmark.limit(0))] == [0] * len(rows)
    assert hits(docs.limit(0), benchmark) == []
    clean = decontaminate.clean(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [5, 6, 8, 9, 12]


def fingerprint(text):
    found = (text or "").encode().lower().split()
    shingles = [b" ".join(found[k : k + 3]) for k in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest key reachable over links of at most 3 bits, for (key, fingerprint) pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for k, (key, _) in enumerate(prints):
        if key is not None:
            least[find(k)] = min(key, least.get(find(k), key))
    return [(key, fp, least.get(find(k))) for k, (key, fp) in enumerate(prints)]


def near(spark, docs):
    rows = simhash.near_duplicates(docs).collect()
    return sorted([(r.doc_id, r.fp % (1 << 64), r.component_id) for r in rows], key=repr)


def test_near_duplicates_of_the_shared_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    prints = [(r.doc_id, fingerprint(r.text)) for r in docs.collect()]
    assert near(spark, docs) == sorted(brute_components(prints), key=repr)


def test_near_duplicates_of_awkward_rows(spark):
    docs = documents(spark)
    prints = [(r.doc_id, fingerprint(r.text)) for r in docs.collect()]
    assert near(spark, docs) == sorted(brute_components(prints), key=repr)
    assert near(spark, docs.limit(0)) == []
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = brute_components(prints)
    named = {c for _, _, c in found if c is not None}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(named)
    assert kept.filter("doc_id is null").count() == len({f for _, f, c in found if c is None})


def test_fingerprint_definition():
    for text in ("", "  ", "One", "one two", "a b c", "A B c d\te\nf", "é ß É\x0bx"):
        assert simhash.fingerprint(text.encode()) == fingerprint(text)


@pytest.mark.parametrize("tile", [3, 2048])
def test_links_connect_what_all_close_pairs_connect(spark, tile, monkeypatch):
    """Balls of near copies, chains, and noise; small tiles split nearly every cell."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(4):
        x = rng.getrandbits(64)
        for _ in range(60):
            y = x
            for b in rng.sample(range(64), rng.randint(0, 4)):
                y ^= 1 << b
            prints.add(y)
        for _ in range(25):  # a chain
            for b in rng.sample(range(64), 3):
                x ^= 1 << b
            prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(200)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = components(simhash.links(table)).collect()
    root = {r.node: r.root for r in found}
    wanted = brute_components([(p, p % (1 << 64)) for p in signed])
    assert all(root.get(p, p) == c for p, _, c in wanted)


def test_every_close_pair_shares_a_cell():
    rng = np.random.default_rng(3)
    masks = np.array(simhash._masks(), np.uint64)
    one, two = np.uint64(1), simhash._FIRST

    def counts(x):
        high = x >> one
        return ((x & high & two) << one) | ((x ^ high) & two)

    x = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2)
    for bits in (1, 2, 3):
        y = x.copy()
        for k in range(len(y)):
            for b in rng.choice(64, bits, replace=False):
                y[k] ^= np.uint64(1) << np.uint64(b)
        same = (counts(x)[:, None] & masks) == (counts(y)[:, None] & masks)
        assert same.any(axis=1).all()
        assert simhash.close(x, y).all()
    assert not simhash.close(x, x ^ np.uint64(0b1111)).any()


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), min_size=1, max_size=60))
def test_components(spark, edges):
    low = {}

    def find(x):
        low.setdefault(x, x)
        while low[x] != x:
            x = low[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        low[y] = x
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(found) == len({r.node for r in found})
    assert all(r.root == find(r.node) for r in found)
    assert {r.node for r in found} == {x for a, b in edges if a != b for x in (a, b)}


def brute_topk(rows, k, step):
    out = []
    good = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    for i, v in good:
        if i % step == 0:
            scores = [(-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in good if j != i]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def topk(table, k, step):
    vectors = table.select("vec_id", topk_search.quantised(F.col("embedding")).alias("q"))
    found = topk_search.search(vectors, F.col("vec_id") % step == 0, k, vector="q").collect()
    return sorted(tuple(r) for r in found)


@pytest.mark.parametrize("block", [8, 4096])
def test_topk_of_the_shared_table(spark, block, monkeypatch):
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", block)
    monkeypatch.setattr(topk_search, "CHUNK_ROWS", 37)
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    assert topk(table, 20, 20) == brute_topk(rows, 20, 20)


def test_topk_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [-2.0, 0.25]), (4, None)]
    rows += [(5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [0.0, 0.0])]
    rows += [(9, [1e4, -1e4]), (10, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert topk(table, 3, 2) == brute_topk(rows, 3, 2)
    assert topk(table, 50, 2) == brute_topk(rows, 50, 2)
    assert topk(table.limit(0), 3, 2) == []
    # large numbers leave floating point
    big = [(k, [float(3 + k) * 2**20, 2.0**20 - k]) for k in range(6)]
    table = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    assert topk(table, 4, 1) == brute_topk(big, 4, 1)


def test_items_digest(spark):
    """The registered query's digest is of the items as strings in order."""
    bench = spark.createDataFrame([(10, "b c"), (9, "a b"), (100, "c")], "item_id long, text string")
    docs = frame(spark, [(1, "a b c", "en", "x")])
    found = hits(docs, bench)[0]
    assert found == (1, 3, 3, ["10", "100", "9"])
    assert hashlib.sha256(b"10,100,9").hexdigest() == docs.select(
        F.sha2(F.lit("10,100,9"), 256)
    ).first()[0]


def test_different_texts_under_one_key_are_rows_of_their_own(spark):
    rng = random.Random(5)
    one, two, three = (" ".join(f"w{rng.randrange(9999)}" for _ in range(60)) for _ in range(3))
    rows = [(1, one), (1, two), (0, two), (5, three), (5, one), (5, three), (None, "of no key")]
    docs = frame(spark, [(k, t, "en", "a") for k, t in rows])
    for parts in (1, 4):
        kept = simhash.keep_one(docs.repartition(parts)).collect()
        wanted = [(1, one), (0, two), (5, three), (None, "of no key")]
        assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted(wanted, key=repr)
    both = simhash.keep_one(frame(spark, [(7, one, "en", "a"), (7, two, "en", "a")])).collect()
    assert sorted(r.text for r in both) == sorted([one, two])
    bench = spark.createDataFrame([(1, " ".join(two.split()[20:40]))], "item_id long, text string")
    clean = [(1, one), (5, three), (5, one), (5, three), (None, "of no key")]
    got = decontaminate.clean(docs, bench).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(clean, key=repr)
