"""Conversation repair against a plain shortest-path recomputation."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF_DIR
from pyspark.sql import types as T

from wardflow.llm import conversations

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
INSERTED = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}


def cheapest(rows):
    """(cost, edits, repaired) of (initial, fault, line): best of every state, row by row."""
    best = {0: (0, "", ())}

    def grown(now):
        out = dict(now)
        for _ in range(3):
            for s, (cost, edits, lines) in list(out.items()):
                role, t = INSERTED[s]
                new = (cost + 3, edits + "I", (*lines, role + ":"))
                if t not in out or new < out[t]:
                    out[t] = new
        return out

    for initial, fault, (role, text) in rows:
        step = {}
        for s, (cost, edits, lines) in grown(best).items():
            options = [(s, 4, "D", lines)]
            if fault in (0, 3):
                stays = 3 if fault else 0
                if (s, initial) in NEXT:
                    options.append((NEXT[s, initial], stays, "K", (*lines, f"{role}:{text}")))
                name, t = INSERTED[s]
                options.append((t, 3 + stays, "R", (*lines, f"{name}:{text}")))
            for t, more, letter, said in options:
                new = (cost + more, edits + letter, said)
                if t not in step or new < step[t]:
                    step[t] = new
        best = step
    return min(v for s, v in grown(best).items() if s in (0, 3))


def brute_audit(table):
    """The contract's rows, from (conv_id, turn, role, text)."""
    groups = {}
    for conv, turn, role, text in table:
        groups.setdefault(conv, [])
        spaced = [" " if x is None else str(x) for x in (conv, turn)]
        kind = zlib.crc32(":".join(spaced).encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        groups[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        counts, seen, marked = [0, 0, 0, 0], set(), []
        for _, role, text in rows:
            content = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = 1 if not content else 2 if (role, text) in seen else 3 if content[-1] not in ".!?" else 0
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role[:1], fault, (role, text)))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:], strict=False))
        turns = {r[0] for r in rows} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, edits, lines = cheapest(marked)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts[1:], illegal, cost, edits, digest))
    return sorted(out, key=repr)


SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("place", T.LongType()),
        T.StructField("fault", T.StringType()),
    ]
)
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def audited(spark, rows, size=conversations.SEGMENT):
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    found = conversations.audit(table, size)
    assert found.columns == COLUMNS
    return sorted([tuple(r) for r in found.collect()], key=repr)


def talk(conv, n, rng):
    roles = ["system"] + ["user", "assistant"] * n
    rows = []
    for turn, role in enumerate(roles[: n + 1]):
        role = rng.choice([role] * 6 + ["user", "assistant", "system", "tool", "", None])
        text = rng.choice([f"said {turn}.", f"said {turn}", "ok.", "ok.", "", " \t", None, "Ja! ", "é?\x0c"])
        rows.append((conv, rng.choice([turn] * 9 + [None, turn + 1]), role, text))
    return rows


def test_shared_conversations(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in table.collect()]
    assert audited(spark, rows) == brute_audit(rows)


@pytest.mark.parametrize("size", [2, conversations.SEGMENT])
def test_awkward_conversations(spark, size):
    rng = random.Random(size)
    rows = [r for conv in range(60) for r in talk(conv, rng.randrange(12), rng)]
    rows += [(None, None, None, None), (None, 1, "user", "no conversation."), (7, 2, "user", "word " * 50_000)]
    rows += [(61, None, "user", "again.")] * 9 + [(62, 5, "assistant", "same?")] * 30
    rows += [r for conv in (63, 64) for r in talk(conv, 900 if size == 2 else 300, rng)]
    assert audited(spark, rows, size) == brute_audit(rows)


def test_no_conversations(spark):
    assert audited(spark, []) == []


ROW = st.tuples(st.sampled_from("suaxt"), st.sampled_from([0, 0, 0, 1, 2, 3]), st.sampled_from([1, 1, 1, 3]))


@settings(max_examples=400, deadline=None)
@given(st.lists(ROW, max_size=12))
def test_search_finds_the_first_of_the_cheapest(rows):
    flat = []
    for k, (initial, fault, copies) in enumerate(rows):
        line = ({"s": "system", "u": "user", "a": "assistant"}.get(initial, initial), str(k))
        flat += [(initial, fault, line)] + [(initial, fault if fault == 1 else 2, line)] * (copies - 1)
    cost, edits, _ = cheapest(flat)
    search = conversations.Search(*[list(c) for c in zip(*rows, strict=True)] or [[], [], []])
    found = search.best(0)
    tail = conversations._TAIL_EDITS[found[2]]
    assert (found[0], found[1] + tail) == (cost, edits)


@settings(max_examples=200, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=8), st.lists(ROW, min_size=1, max_size=8))
def test_costs_of_two_segments_add_up(first, second):
    searches = [conversations.Search(*[list(c) for c in zip(*rows, strict=True)]) for rows in (first, second)]
    whole = conversations.Search(*[list(c) for c in zip(*first, *second, strict=True)])
    merged = conversations._cost_merge([s.matrix() for s in searches])
    alone = whole.matrix()
    # a whole segment may insert at the border just as the second one may before its first row
    assert merged == alone


def test_search_is_fast_on_long_conversations():
    rng = random.Random(1)
    initials = [rng.choice("uaua" + "us") if rng.random() < 0.2 else "ua"[k % 2] for k in range(4000)]
    faults = [rng.choice([0] * 12 + [1, 2, 3]) for _ in initials]
    found = 0
    for k in range(0, 4000, conversations.SEGMENT):
        part = slice(k, k + conversations.SEGMENT)
        search = conversations.Search(initials[part], faults[part], [1] * len(initials[part]))
        calls = []
        moves = search._moves
        search._moves = lambda i, s, moves=moves, calls=calls: calls.append(1) or moves(i, s)
        found += search.best(0)[0]
        assert len(calls) < 40 * conversations.SEGMENT
    assert found > 0
