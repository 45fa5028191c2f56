"""Conversation structure repair: the cheapest edits that make the turns of a conversation alternate.

A conversation is well formed if its role initials read ``(s?(ua)+)?``.  Each row is kept (cost 0),
given the role user or assistant (3) or deleted (4; blank rows and duplicates must be), and empty
user or assistant turns may be inserted anywhere (3); a truncated row that stays costs 3 more.
Written as one letter an edit (D, I, K, R), the answer is the cheapest string of edits, the first in
ASCII order among equals.  ``Search`` finds it by iterative-deepening A*: depth-first in that order
under a cost bound that rises until a path is accepted.  The estimate of the remaining cost is
what faults cost in any case, plus the largest weight of separate neighbours that cannot stay
beside each other; the transposition table keeps, for every state that failed, the cost it was
found to need at least.

Rows are range-partitioned in order, so a conversation may hold any share of them.  Each task
cuts its rows into segments of at most ``SEGMENT`` rows.  A conversation of one segment is searched
as it is.  For the others, each segment is searched for the cost between every pair of states of
the grammar; these matrices are combined in a tree of fan-out ``FAN``, which gives every segment the
cost of what follows it; it is then searched again with that, and a second tree finds the state in
which the chosen path enters it.  A path of a segment ends with a row, so two of them differ before
either ends and ties are settled inside a segment.

Defined cases.  A null role or text counts as one space, a null turn comes first, and rows with a
null ``conv_id`` form one conversation.  Rows of equal turn are ordered by role and text; rows equal
in all of these are duplicates of the first.  Very long texts are never gathered by conversation.
An empty table gives an empty result, a conversation that damage leaves without rows zeros, an empty
audit and the digest of the empty string.  Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.session import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# Rows of one search; and children of a node of the trees over segments.
SEGMENT = 128
FAN = 64

# Parts into which the rows of one (conversation, role, text) are dealt.
SALTS = 32

# States: nothing yet, after s, after u, after a.  The first and the last accept.
STATES = 4
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEEDS = ("u", "u", "a", "u")  # the role an inserted or renamed turn takes
_GIVES = (2, 2, 3, 2)
_ROLES = {"u": "user", "a": "assistant"}

# What is left to insert after the last row, by state.
TAIL = (0, 2 * INSERT, INSERT, 0)
_TAIL_EDITS = ("", "II", "I", "")

NEVER = 1 << 60

_FAULTS = {"blank": 1, "duplicate": 2, "truncated": 3}


class Search:
    """The edits of one segment: initials, faults and copies (equal rows in place) of its rows."""

    def __init__(self, initials: list[str], faults: list[int], copies: list[int]):
        self.initials, self.faults, self.copies = initials, faults, copies
        self.n = len(initials)
        self.forced = [f in (1, 2) for f in faults]
        self.extra = [DELETE * (c - 1) for c in copies]
        self.cut = [TRUNCATED if f == 3 else 0 for f in faults]

    def _estimates(self, suffix: tuple | list) -> list[int]:
        """Least remaining cost of each (row, state), at ``4 * row + state``."""
        n, low = self.n, min(suffix)
        need = [0] * (STATES * n) + [min(x, NEVER) for x in suffix]
        # the cheapest way to change a row that would otherwise stay, beyond what it costs anyway
        change = [1 if cut else REROLE for cut in self.cut]
        after, following, sure = [0, 0], -1, low
        for i in range(n - 1, -1, -1):
            sure += self.extra[i] + (DELETE if self.forced[i] else self.cut[i])
            if not self.forced[i]:
                role = self.initials[i]
                if following < 0:
                    ends = [suffix[t] for (_, r), t in _NEXT.items() if r == role]
                    best = min(min(ends, default=NEVER) - low, change[i])
                else:
                    best = after[0]
                    if role + self.initials[following] not in ("su", "ua", "au"):
                        best = max(best, min(change[i], change[following]) + after[1])
                after, following = [best, after[0]], i
            for s in range(STATES):
                if following < 0:
                    need[STATES * i + s] = sure - low + self._end(s, suffix)
                else:
                    more = after[0]
                    if (s, self.initials[following]) not in _NEXT:
                        more = max(more, change[following] + after[1])
                    need[STATES * i + s] = sure + more
        return need

    def _end(self, state: int, suffix) -> int:
        """Least cost beyond deletions where no row can stay."""
        reach, cost, s = suffix[state], 0, state
        for _ in range(2):
            s, cost = _GIVES[s], cost + INSERT
            reach = min(reach, cost + suffix[s])
        return min(reach, NEVER)

    def _moves(self, i: int, s: int) -> list[tuple[int, int, str]]:
        """(cost, next state, edit) in ASCII order of the edits."""
        at = STATES * (i + 1)
        moves = [(DELETE + self.extra[i], at + s, "D"), (INSERT, STATES * i + _GIVES[s], "I")]
        if not self.forced[i]:
            stays = self.cut[i] + self.extra[i]
            kept = _NEXT.get((s, self.initials[i]))
            if kept is not None:
                moves.append((KEEP + stays, at + kept, "K"))
            moves.append((REROLE + stays, at + _GIVES[s], "R"))
        return moves

    def best(self, entry: int, suffix=TAIL) -> tuple[int, str, int] | None:
        """(cost with what ``suffix`` adds, edits, state at the end) from state ``entry``."""
        if not any(x < NEVER and self._reaches(entry, t) for t, x in enumerate(suffix)):
            return None
        need = self._estimates(suffix)
        last = STATES * self.n
        while True:
            bound = need[entry]
            found = self._within(entry, bound, need, last)
            if found is not None:
                return bound, *found

    def _reaches(self, s: int, t: int) -> bool:
        if t == 0:
            return s == 0
        if t == 1:
            kept = any(r == "s" and not f for r, f in zip(self.initials, self.forced, strict=True))
            return s == 1 or s == 0 and kept
        return True

    def _within(self, entry: int, bound: int, need: list[int], last: int):
        """The first path of at most ``bound``; ``need`` learns from every state that fails."""
        if last == 0:
            return "", entry
        # frames: state, remaining cost, moves left, least need seen
        path: list[str] = []
        stack = [[entry, bound, iter(self._moves(entry // STATES, entry % STATES)), NEVER, 0]]
        while stack:
            frame = stack[-1]
            move = next(frame[2], None)
            if move is None:
                stack.pop()
                need[frame[0]] = max(need[frame[0]], frame[3])
                if stack:
                    path.pop()
                    above = stack[-1]
                    above[3] = min(above[3], frame[4] + need[frame[0]])
                continue
            cost, state, edit = move
            if cost + need[state] > frame[1]:
                frame[3] = min(frame[3], cost + need[state])
                continue
            path.append(edit)
            if state >= last:
                return self._with_copies(path), state - last
            moves = iter(self._moves(state // STATES, state % STATES))
            stack.append([state, frame[1] - cost, moves, NEVER, cost])
        return None

    def _with_copies(self, path: list[str]) -> str:
        """A row's copies are deleted right after it: D comes before I."""
        out, i = [], 0
        for edit in path:
            out.append(edit)
            if edit != "I":
                out.append("D" * (self.copies[i] - 1))
                i += 1
        return "".join(out)

    def matrix(self) -> list[int]:
        """Cost from each state to each state, row by row."""
        out = []
        for s in range(STATES):
            for t in range(STATES):
                goal = [0 if x == t else NEVER for x in range(STATES)]
                found = self.best(s, goal) if self._reaches(s, t) else None
                out.append(found[0] if found else NEVER)
        return out

    def steps(self, edits: str, entry: int) -> list[tuple[str, str | None]]:
        """(edits, role now; None if deleted) of each row; inserts before a row count to it."""
        out, at, s = [], 0, entry
        for i in range(self.n):
            start = at
            while edits[at] == "I":
                s, at = _GIVES[s], at + 1
            edit = edits[at]
            role = None
            if edit == "K":
                role = self.initials[i]
                s = _NEXT[s, role]
            elif edit == "R":
                role, s = _NEEDS[s], _GIVES[s]
            at += self.copies[i]
            out.append((edits[start:at], role))
        return out


# ---- rows and faults -------------------------------------------------------------------------


def conversation_key(conv_id: Column) -> Column:
    """A text for each id, null included."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage: ``key``, ``conv_id``, turn, role, text and copies of the rows left."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    conv, turn, role, text = spaced
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    return rows.select(
        conversation_key(F.col("conv_id")).alias("key"),
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
        (kind != 0).alias("left"),
    ).filter("left").drop("left")


def with_faults(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn become one with ``copies``; ``fault`` is 0 or the row's first fault.

    The first place of a text is looked up in parts, so one text repeated through a hot
    conversation is no single key.
    """
    sizes = F.concat_ws(",", F.length("key").cast("string"), F.length("role").cast("string"))
    merged = rows.groupBy("key", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    merged = merged.withColumn(
        "said", F.sha2(F.concat(sizes, F.lit(":"), "key", "role", "text"), 256)
    ).withColumn("salt", F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    parts = merged.groupBy("said", "salt").agg(F.min(place).alias("own"))
    first = F.min("own").over(Window.partitionBy("said"))
    parts = parts.withColumn("first", first).drop("own")
    content = r"[^\x20\x09-\x0D]"
    last = F.regexp_extract("text", rf"({content})[\x20\x09-\x0D]*\z", 1)
    return (
        merged.join(parts, ["said", "salt"])
        .withColumn(
            "fault",
            F.when(~F.col("text").rlike(content), _FAULTS["blank"])
            .when(place > F.col("first"), _FAULTS["duplicate"])
            .when(~last.isin(".", "!", "?"), _FAULTS["truncated"])
            .otherwise(0),
        )
        .select("key", "turn", "role", "text", "copies", "fault")
    )


def _segments(size: int):
    """Adds a segment to sorted rows: the task's number and the run of ``size`` rows in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = None, 0
        for batch in batches:
            keys = batch.column("key").to_pylist()
            out = np.empty(len(keys), np.int64)
            for k, key in enumerate(keys):
                held, seen = (key, 0) if key != held else (held, seen + 1)
                out[k] = seen // size
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out)], [*batch.schema.names, "chunk"]
            )

    return run


def in_segments(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Rows in order: ``place`` counts through the table, ``part`` and ``chunk`` name the segment."""
    ordered = rows.withColumn("start", F.substring("text", 1, 64)).repartitionByRange(
        "key", "turn", "role", "start"
    )
    ordered = ordered.drop("start").sortWithinPartitions("key", "turn", "role", "text")
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema)
    cut = ordered.mapInArrow(_segments(size), f"{kind}, chunk long")
    return materialize(
        cut.withColumn("place", F.monotonically_increasing_id()).withColumn(
            "part", F.spark_partition_id().cast("long")
        )
    )


# ---- searches over segments ------------------------------------------------------------------

def _arrow(returns: str) -> Callable:
    """An Arrow column function that is made when it is used, so that a session exists."""
    return lambda fn: lambda *columns: F.arrow_udf(fn, returns)(*columns)


def _search(rows: list[dict]) -> Search:
    return Search(
        [r["initial"] for r in rows], [r["fault"] for r in rows], [r["copies"] for r in rows]
    )


@_arrow("array<bigint>")
def _matrix(rows: pa.Array) -> pa.Array:
    return pa.array([_search(r).matrix() for r in rows.to_pylist()], pa.list_(pa.int64()))


_PATH = pa.struct([("cost", pa.int64()), ("edits", pa.string()), ("leaves", pa.int64())])


@_arrow("array<struct<cost:bigint,edits:string,leaves:bigint>>")
def _paths(rows: pa.Array, suffix: pa.Array, entries: pa.Array) -> pa.Array:
    """The best path from each of ``entries``; the cost is that of the segment alone."""
    out = []
    for r, after, starts in zip(rows.to_pylist(), suffix.to_pylist(), entries.to_pylist(), strict=True):
        search, found = _search(r), []
        for entry in starts:
            best = search.best(entry, after)
            found.append(best and {"cost": best[0] - after[best[2]], "edits": best[1], "leaves": best[2]})
        out.append(found)
    return pa.array(out, pa.list_(_PATH))


_STEP = pa.struct([("place", pa.int64()), ("edits", pa.string()), ("role", pa.string())])


@_arrow("array<struct<place:bigint,edits:string,role:string>>")
def _steps(rows: pa.Array, edits: pa.Array, entry: pa.Array) -> pa.Array:
    out = []
    for r, path, state in zip(rows.to_pylist(), edits.to_pylist(), entry.to_pylist(), strict=True):
        done = _search(r).steps(path, state)
        out.append(
            [{"place": x["place"], "edits": e, "role": role} for x, (e, role) in zip(r, done, strict=True)]
        )
    return pa.array(out, pa.list_(_STEP))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Costs through two segments."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), NEVER)


def _cost_merge(parts: list[list[int]]) -> list[int]:
    out = np.array(parts[0]).reshape(STATES, STATES)
    for m in parts[1:]:
        out = _product(out, np.array(m).reshape(STATES, STATES))
    return out.ravel().tolist()


def _cost_push(parts: list[list[int]], after: list[int]) -> list[list[int]]:
    out, now = [], np.array(after)
    for m in reversed(parts):
        out.append(now.tolist())
        now = np.minimum((np.array(m).reshape(STATES, STATES) + now).min(axis=1), NEVER)
    return out[::-1]


def _state_merge(parts: list[list[int]]) -> list[int]:
    out = list(range(STATES))
    for leaves in parts:
        out = [leaves[s] for s in out]
    return out


def _state_push(parts: list[list[int]], entry: list[int]) -> list[list[int]]:
    out, now = [], entry[0]
    for leaves in parts:
        out.append([now])
        now = leaves[now]
    return out


def _tree(leaves: DataFrame, merge, push, root: tuple) -> DataFrame:
    """``value`` of every leaf (key, at, item), handed down from the root of its key's tree.

    Items are merged upwards in runs of ``FAN``, so no task gets all of a long conversation.
    """

    @_arrow("array<bigint>")
    def merged(parts: pa.Array) -> pa.Array:
        return pa.array([merge(p) for p in parts.to_pylist()], pa.list_(pa.int64()))

    @_arrow("array<array<bigint>>")
    def pushed(parts: pa.Array, value: pa.Array) -> pa.Array:
        rows = zip(parts.to_pylist(), value.to_pylist(), strict=True)
        return pa.array([push(p, v) for p, v in rows], pa.list_(pa.list_(pa.int64())))

    levels, below = [], leaves
    while True:
        grouped = below.groupBy("key", F.floor(F.col("at") / FAN).alias("node")).agg(
            F.array_sort(F.collect_list(F.struct("at", "item"))).alias("parts")
        )
        level = materialize(grouped.withColumn("item", merged(F.col("parts.item"))))
        levels.append(level)
        if level.filter("node > 0").isEmpty():
            break
        below = level.select("key", F.col("node").alias("at"), "item")
    value = levels[-1].select("key", "node", F.array(*[F.lit(x).cast("long") for x in root]).alias("value"))
    for level in reversed(levels):
        each = level.join(value, ["key", "node"]).select(
            "key", F.explode(F.arrays_zip(F.col("parts.at"), pushed(F.col("parts.item"), "value"))).alias("x")
        )
        value = each.toDF("key", "x").select("key", F.col("x").getField("at").alias("node"), F.col("x").getField("1").alias("value"))
    return value.withColumnRenamed("node", "at")


def _numbered(segments: DataFrame) -> DataFrame:
    """``at`` counts the segments of a conversation; its parts are as many as tasks at most."""
    parts = segments.groupBy("key", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return segments.join(base, ["key", "part"]).withColumn("at", F.col("base") + F.col("chunk")).drop("base")


def edits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The steps ``(place, edits, role)`` of all rows, and each conversation's ``(key, cost, leaves)``.

    ``rows`` are those of ``in_segments``; ``leaves`` is the state after the last row.
    """
    each = F.struct("place", F.substring("role", 1, 1).alias("initial"), "fault", "copies")
    segments = rows.groupBy("key", "part", "chunk").agg(F.array_sort(F.collect_list(each)).alias("rows"))
    sizes = Window.partitionBy("key")
    parts = segments.groupBy("key", "part").agg(F.count("*").alias("n"))
    many = parts.withColumn("all", F.sum("n").over(sizes)).filter(F.col("all") > 1).select("key").distinct()
    # a search is costly for the bytes it reads, so tasks are not merged by bytes
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = segments.join(many.withColumn("long", F.lit(True)), "key", "left")
    segments = materialize(segments.repartition(tasks, "key", "part", "chunk"))
    tail = F.array(*[F.lit(x).cast("long") for x in TAIL])

    short = segments.filter("long is null").withColumn("path", _paths("rows", tail, F.array(F.lit(0).cast("long")))[0])
    short = short.select("key", "rows", F.lit(0).cast("long").alias("entry"), "path", F.lit(0).alias("at"))

    long = _numbered(segments.filter("long")).select("key", "at", "rows")
    long = materialize(long.repartition(tasks, "key", "at"))
    if not long.isEmpty():
        costs = long.select("key", "at", _matrix("rows").alias("item"))
        after = _tree(costs, _cost_merge, _cost_push, TAIL)
        entries = F.array(*[F.lit(s).cast("long") for s in range(STATES)])
        paths = materialize(
            long.join(after, ["key", "at"]).select("key", "at", "rows", _paths("rows", "value", entries).alias("paths"))
        )
        # a state from which nothing follows is never entered: any exit will do for it
        exits = F.transform(F.col("paths.leaves"), lambda x: F.coalesce(x, F.lit(0).cast("long")))
        entered = _tree(paths.select("key", "at", exits.alias("item")), _state_merge, _state_push, (0,))
        chosen = paths.join(entered, ["key", "at"]).withColumn("entry", F.col("value")[0])
        chosen = chosen.withColumn("path", F.get("paths", F.col("entry").cast("int")))
        short = short.unionByName(chosen.select("key", "rows", "entry", "path", F.col("at").cast("int").alias("at")))
    done = materialize(
        short.select("key", "at", "path", _steps("rows", "path.edits", "entry").alias("steps"))
    )
    last = F.max_by("path.leaves", "at")
    total = done.groupBy("key").agg(F.sum("path.cost").alias("cost"), last.alias("leaves"))
    total = total.withColumn("cost", F.col("cost") + F.get(tail, F.col("leaves").cast("int")))
    return done.select(F.inline("steps")), total


# ---- results ---------------------------------------------------------------------------------


def repaired_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with their step, in the order of ``key`` and ``place``, and the conversations' costs.

    ``before`` holds the roles of turns inserted ahead of a row, ``now`` its role (null: deleted).  A
    conversation's last row, of null ``role``, stands for the turns inserted at its end.
    """
    steps, total = edits(rows)
    names = F.create_map(*[F.lit(x) for pair in _ROLES.items() for x in pair])
    inserted = F.length(F.regexp_extract("edits", "^I*", 0))
    placed = rows.join(steps.withColumnRenamed("role", "given"), "place")
    now = F.when(F.col("given").isNotNull() & F.col("edits").rlike("^I*R"), F.element_at(names, F.col("given")))
    body = placed.select(
        "key", "place", "role", "text", "copies", "fault", "edits", inserted.alias("inserted"),
        F.coalesce(now, F.when(F.col("given").isNotNull(), F.col("role"))).alias("now"),
    )
    ending = total.select(
        "key",
        F.lit((1 << 63) - 1).alias("place"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"),
        F.lit(0).cast("long").alias("copies"),
        F.lit(0).alias("fault"),
        F.get(F.array(*map(F.lit, _TAIL_EDITS)), F.col("leaves").cast("int")).alias("edits"),
        F.get(F.array(*[F.lit(len(x)) for x in _TAIL_EDITS]), F.col("leaves").cast("int")).alias("inserted"),
        F.lit(None).cast("string").alias("now"),
    )
    return body.unionByName(ending), total


_SUMMARY = "key string, blank long, duplicate long, truncated long, illegal long, audit string, repaired_sha256 string"


class _Digest:
    """What the contract asks of one conversation, from its rows in order."""

    def __init__(self, key: str):
        self.key, self.sha, self.audit = key, hashlib.sha256(), []
        self.faults, self.illegal, self.initial, self.state, self.lines = [0, 0, 0, 0], 0, None, 0, 0

    def line(self, text: str) -> None:
        self.sha.update((("\n" if self.lines else "") + text).encode())
        self.lines += 1

    def add(self, role, text, copies, fault, edits, inserted, now) -> None:
        for _ in range(inserted):
            self.line(_ROLES[_NEEDS[self.state]] + ":")
            self.state = _GIVES[self.state]
        self.audit.append(edits)
        if now is not None:
            self.line(f"{now}:{text}")
            self.state = _NEXT[self.state, now[0]]
        if role is not None:
            self.faults[fault] += copies if fault in (1, 2) else 1
            if fault not in (1, 2):
                self.faults[2] += copies - 1
            if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.illegal += copies - 1
            self.initial = role[:1]

    def row(self) -> tuple:
        return self.key, *self.faults[1:], self.illegal, "".join(self.audit), self.sha.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation; its rows come sorted and pass through one by one."""
    names = [c.split()[0] for c in _SUMMARY.split(", ")]
    kinds = [pa.int64() if c.endswith("long") else pa.string() for c in _SUMMARY.split(", ")]
    now, done = None, []
    for batch in batches:
        for key, *rest in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if now is None or key != now.key:
                done += [now.row()] if now else []
                now = _Digest(key)
            now.add(*rest)
        if done:
            columns = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)
            done = []
    if now:
        columns = [pa.array([x], t) for x, t in zip(now.row(), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names)


def gaps(rows: DataFrame) -> DataFrame:
    """Turns missing between the first and the last of each ``key``."""
    turns = rows.filter("turn is not null").select("key", "turn").distinct()
    return turns.groupBy("key").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))


def audit(conversations: DataFrame, size: int = SEGMENT) -> DataFrame:
    """The contract's row for every original conversation.

    The digest of a repaired conversation runs over all its text in order, so that one step
    reads a conversation in one task, row by row; nothing of it is gathered.
    """
    left = damaged(conversations)
    rows = in_segments(with_faults(left), size)
    repaired, total = repaired_rows(rows)
    ordered = repaired.repartition("key").sortWithinPartitions("key", "place")
    found = ordered.select("key", "role", "text", "copies", "fault", "edits", "inserted", "now").mapInArrow(
        _digests, _SUMMARY
    )
    ids = conversations.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("key", conversation_key(F.col("conv_id")))
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    zero = F.lit(0).cast("long")
    return (
        ids.join(found.join(total, "key"), "key", "left")
        .join(gaps(left), "key", "left")
        .select(
            "conv_id",
            *[F.coalesce(c, zero).alias(c) for c in ["gaps", *counts]],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )
