"""The quality gate on stored states: each partition of a keyed table is measured once, then merged.

A state is one row per partition: the measure of every expectation that merges by sum, minimum or
maximum, and the oldest and newest reading, from which ages follow at any later instant.  It carries a
fingerprint of the partition's files and of the suite.  A gate lists the files, measures only partitions
whose fingerprint has changed, and merges the rows, so an increment costs what it touched.  Nothing has
to be noted when the table is written, and a partition that was written behind the table's back, or
whose state was lost in a crash, is measured again.

Uniqueness does not merge.  Keys of touched partitions are counted, and the key index names the other
partitions they may lie in: those few candidates are looked up and counted exactly.  Keys found twice
are kept with their count in each partition; for a sound table that is nothing.

Like ``KeyedTable`` this has one writer.  A table without rows has no state and fails its row count.
"""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.times import age_minutes, instant
from wardflow.operators import quality
from wardflow.operators.quality import Expectation, GateResult
from wardflow.session import materialize, work_tables
from wardflow.sources.files import Files
from wardflow.sources.key_index import Folders
from wardflow.sources.tables import KeyedTable

UNIQUE = "expect_column_values_to_be_unique"
ROWS = "expect_table_row_count_to_be_between"
MAXIMUM = "expect_column_max_to_be_between"
MINIMUM = "expect_column_min_to_be_between"
AGE, STAMP = "age_minutes", "recorded_at"

# Spark's folder name for a null partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

STATE = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("measures", T.ArrayType(T.DoubleType())),
        T.StructField("oldest", T.TimestampType()),
        T.StructField("newest", T.TimestampType()),
    ]
)


def measured(suite: list[Expectation]) -> list[Expectation]:
    """Those with a measure in the states, in order; bounds of age are judged by the stamps beside it."""
    return [e for e in suite if e.column != AGE and e.kind != UNIQUE]


def measure(e: Expectation) -> Column:
    """An expectation's measure of one partition."""
    if e.kind == ROWS:
        value = F.count(F.lit(1))
    elif e.kind in (MAXIMUM, MINIMUM):
        value = (F.max if e.kind == MAXIMUM else F.min)(e.column)
    else:
        value = F.count_if(e.bad)
    return value.cast("double")


def merged(e: Expectation, suite: list[Expectation], as_of: Column) -> Column:
    """The measure of the whole table, from the states of its partitions."""
    if e.column == AGE:
        # the greatest age is that of the oldest reading
        return age_minutes(F.min("oldest") if e.kind == MAXIMUM else F.max("newest"), as_of)
    value = stored(e, suite)
    if e.kind in (MAXIMUM, MINIMUM):
        return (F.max if e.kind == MAXIMUM else F.min)(value)
    return F.coalesce(F.sum(value), F.lit(0.0))


def stored(e: Expectation, suite: list[Expectation]) -> Column:
    return F.get("measures", F.lit(measured(suite).index(e)))


class GateStates:
    """States of ``table`` under ``path``, for the suite they were last brought up to date with."""

    def __init__(self, table: KeyedTable, path: str):
        self.table, self.spark = table, table.spark
        key = T.StructType([f for f in table.schema.fields if f.name in table.keys])
        pairs = [T.StructField("part", T.StringType()), T.StructField("n", T.LongType())]
        self._states = Folders(self.spark, f"{path}/states", STATE)
        self._repeats = Folders(self.spark, f"{path}/repeats", T.StructType([*key.fields, *pairs]))

    def _fingerprints(self, suite: list[Expectation]) -> dict[str, str]:
        """Of each partition, from the names of its files, which no two writes share."""
        files = Files(self.spark, self.table.path)
        suite_text = repr([(e.kind, e.column) if e.bad is None else e for e in measured(suite)])
        found = {}
        for part in self.table.parts():
            if part == NO_VALUE:
                raise ValueError(f"{self.table.path} has rows without a partition value")
            names = sorted(files.names(f"{self.table.path}/{self.table.PART}={part}"))
            text = "\n".join([suite_text, *names])
            found[part] = hashlib.sha256(text.encode()).hexdigest()
        return found

    def refresh(self, suite: list[Expectation]) -> list[str]:
        """Measure the partitions that have changed; returns them."""
        for e in suite:
            if e.kind == UNIQUE and list(self.table.keys) != [e.column]:
                raise ValueError(f"stored uniqueness needs the table's key, not {e.column!r}")
        now = self._fingerprints(suite)
        known = {}
        if self._states.exists():  # a row for each partition
            rows = self._states.rows().select("part", "fingerprint").collect()
            known = {r["part"]: r["fingerprint"] for r in rows}
        stale = sorted(p for p, f in now.items() if known.get(p) != f)
        gone = sorted(set(known) - set(now))
        if not stale and not gone and known:
            return []
        with work_tables(self.spark):
            # repeats first: after a crash in between the partitions are still stale
            self._renew_repeats(stale, gone, set(now))
            self._renew_states(suite, {p: now[p] for p in stale}, gone)
        return stale

    def _renew_states(self, suite, fresh: dict[str, str], gone: list[str]) -> None:
        part = F.col(self.table.PART)
        marks = self.spark.createDataFrame(list(fresh.items()), "part string, fingerprint string")
        rows = (
            self.table.rows_of(list(fresh))
            .groupBy(part.alias("part"))
            .agg(
                F.array(*[measure(e) for e in measured(suite)]).alias("measures"),
                F.min(STAMP).alias("oldest"),
                F.max(STAMP).alias("newest"),
            )
            .join(marks, "part")
            .select(*STATE.fieldNames())
        )
        if self._states.exists():
            kept = self._states.rows().filter(~F.col("part").isin([*fresh, *gone]))
            rows = kept.unionByName(rows)
        self._states.keep_only(self._states.add(materialize(rows).coalesce(1)))

    def _renew_repeats(self, stale: list[str], gone: list[str], present: set[str]) -> None:
        keys, part = list(self.table.keys), self.table.PART
        counts = materialize(self._key_counts(self.table.rows_of(stale)))
        elsewhere = sorted(present - set(stale))
        seen = counts
        if self.table.index is not None:
            places = self._places(counts)
            candidates = places.filter(F.col(part).isin(elsewhere))
            if elsewhere and not candidates.isEmpty():
                # as many values as partitions
                parts = [r[0] for r in candidates.select(part).distinct().collect()]
                rows = self.table.rows_of(parts).join(candidates, [*keys, part], "left_semi")
                seen = seen.unionByName(self._key_counts(rows))
        if self._repeats.exists():
            # counts of one key in one partition are the same wherever they come from
            kept = self._repeats.rows().filter(~F.col("part").isin([*stale, *gone]))
            seen = seen.unionByName(kept).dropDuplicates([*keys, "part"])
        twice = seen.groupBy(*keys).agg(F.sum("n").alias("_all")).filter("_all > 1")
        found = materialize(seen.join(twice, keys, "left_semi"))
        self._repeats.keep_only(self._repeats.add(found))

    def _key_counts(self, rows: DataFrame) -> DataFrame:
        keys = list(self.table.keys)
        known = rows.dropna(subset=keys)  # nulls are no repeats
        by = [*keys, F.col(self.table.PART).alias("part")]
        return known.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))

    def _places(self, counts: DataFrame) -> DataFrame:
        """Where the index says these keys may lie; it learns those it did not know."""
        keys, part = list(self.table.keys), self.table.PART
        pairs = counts.select(*keys, F.col("part").alias(part))
        if not self.table.index.exists():
            self.table.index.replace(self.table.rows_of())
        places = materialize(self.table.index.find(pairs))
        self.table.index.add(pairs.join(places, [*keys, part], "left_anti"))
        return places

    def measures(self, suite: list[Expectation], as_of: datetime | str | None = None) -> DataFrame:
        """One row ``m0, m1, ...`` as ``quality.expectation_measures`` gives, from the states alone."""
        at = instant(as_of)
        row = self._states.rows().agg(
            *[merged(e, suite, at).alias(f"m{i}") for i, e in enumerate(suite) if e.kind != UNIQUE]
        )
        repeated = self._repeats.rows().agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double"))
        for i, e in enumerate(suite):
            if e.kind == UNIQUE:
                row = row.withColumn(f"m{i}", repeated.scalar())
        return row.select(*[f"m{i}" for i in range(len(suite))])

    def results(self, suite: list[Expectation], as_of: datetime | str | None = None) -> DataFrame:
        """One row per expectation, of the table as it is now."""
        self.refresh(suite)
        return quality.results_of(self.measures(suite, as_of), suite)

    def failing_rows(self, suite: list[Expectation], failed: list[int]) -> DataFrame:
        """Rows of the partitions in which the expectations at these positions fail."""
        chosen = [suite[i - 1] for i in failed]
        hit = F.lit(False)
        for e in chosen:
            if e.bad is not None:
                hit = hit | (stored(e, suite) > 0)
        parts = self._states.rows().filter(hit).select("part")
        if any(e.kind == UNIQUE for e in chosen):
            parts = parts.union(self._repeats.rows().select("part"))
        return self.table.rows_of([r[0] for r in parts.distinct().collect()])  # partitions


def run_stored_gate(
    states: GateStates,
    *,
    max_age_minutes: int = quality.DEFAULT_MAX_AGE_MINUTES,
    raise_on_failure: bool = True,
    freshness: str = "oldest",
    not_in_future: bool = False,
    as_of: datetime | str | None = None,
    results_path: str | None = None,
) -> GateResult:
    """``quality.run_silver_quality_gate`` with the same outcome, read from stored states.

    A failing gate reads the partitions that fail, for the values it shows.
    """
    suite = quality.silver_suite(max_age_minutes, freshness, not_in_future)
    return quality.conclude(
        states.results(suite, as_of),
        suite,
        lambda failed: states.failing_rows(suite, failed),
        raise_on_failure=raise_on_failure,
        as_of=as_of,
        results_path=results_path,
    )
