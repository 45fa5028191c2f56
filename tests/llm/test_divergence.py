"""Source divergence against a plain recomputation."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import LONG, ODD_TEXTS, SF_DIR, frame

from wardflow.llm import divergence


def terms_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_audit(rows, least=30, most=50):
    """The contract's rows from (lang, source, text)."""
    docs, counts, groups = {}, {}, {}
    for lang, source, text in rows:
        lang, source, found = lang or "", source or "", terms_of(text)
        groups.setdefault(lang, set()).add(source)
        docs.setdefault(lang, Counter()).update(set(found))
        counts.setdefault((lang, source), Counter()).update(found)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def p_of(count, kept=kept):
            whole = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // whole for t in kept}

        every = p_of(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: p_of(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            words = [(p[s][t] - every[t], t) for t in kept if counts[lang, s][t] and p[s][t] > every[t]]
            for part, items in (("pair", pairs), ("term", words)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                ranked = list(enumerate(items, 1))[: most if part == "term" else None]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in ranked]
    return sorted(out)


def audited(docs, **options):
    found = divergence.audit(docs, **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in found.collect())


def test_shared_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    wanted = brute_audit(rows)
    assert audited(docs) == wanted
    assert {r[2] for r in wanted} == {"pair", "term"}


def test_awkward_documents(spark):
    rng = random.Random(5)
    vocabulary = ["Über", "über", "ÜBER", "naïve", "x", "Y", "the", "的", "a1b"]
    rows = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(9))), "en", f"s{k % 7}") for k in range(200)]
    rows += [(900 + k, text, "xx", None) for k, text in enumerate(ODD_TEXTS)]
    rows += [(1, None, None, None), (2, LONG, "en", "s1"), (2, LONG, "en", "s1"), (3, None, "en", "only nulls")]
    rows += [(None, "the x", None, "s1"), (4, "alone", "yy", "s1"), (5, "", "xx", "empty")]
    wanted = brute_audit([(lang, source, text) for _, text, lang, source in rows], least=3, most=4)
    assert audited(frame(spark, rows), least_docs=3, most_terms=4) == wanted


def test_no_documents(spark):
    assert audited(frame(spark, [])) == []


def test_several_tiles(spark):
    """More sources and terms than a tile holds."""
    rng = random.Random(6)
    names = [f"t{chr(97 + k)}{chr(97 + k % 5)}" for k in range(23)]
    rows = [(k, " ".join(rng.choices(names[: 3 + k % 20], k=6)), "en", f"s{k % 11}") for k in range(120)]
    wanted = brute_audit([(lang, source, text) for _, text, lang, source in rows], least=3)
    assert audited(frame(spark, rows), least_docs=3, depth=1) == wanted


CELLS = st.dictionaries(st.tuples(st.integers(0, 15), st.integers(0, 15)), st.integers(1, 9), max_size=40)


@settings(max_examples=200, deadline=None)
@given(CELLS, CELLS, st.integers(0, 16))
def test_walk_of_two_trees(first, second, width):
    rng = np.random.default_rng(0)
    sides = []
    for cells in (first, second):
        cells = {k: v for k, v in cells.items() if k[1] < width}
        rows, columns = (np.array([k[x] for k in cells], np.int64) for x in (0, 1))
        values = np.array(list(cells.values()), np.int64)
        zeros = rng.integers(0, 5, 16)
        dense = np.repeat(zeros[:, None], 16, axis=1)
        dense[rows, columns] = values
        tree = divergence.Quadtree(rows, columns, depth=2)
        sides.append((tree, values[tree.order] if len(values) else values, zeros, dense))
    (a, leaf_a, zero_a, full_a), (b, leaf_b, zero_b, full_b) = sides
    x, y = (v.ravel() for v in np.meshgrid(np.arange(16), np.arange(16)))
    got = divergence.distances(a, b, (x, y), (leaf_a, leaf_b), (zero_a, zero_b), width)
    assert got.tolist() == np.abs(full_a[x, :width] - full_b[y, :width]).sum(axis=1).tolist()


@pytest.mark.parametrize("n, whole", [(5, 5), (5, 10**15), (10**15, 10**15 + 1), (7, 11), (123456789, 987654321012)])
def test_shares_are_exact(n, whole):
    assert divergence.shares(np.array([n]), np.array([whole])).tolist() == [1 + 10**9 * n // whole]
