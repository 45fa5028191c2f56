from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from helpers import AS_OF, bronze, bronze_row, minutes
from pyspark.sql import functions as F

from wardflow.operators import quality as q
from wardflow.operators import silver as s
from wardflow.operators import stored_gate as sg

DAY = 24 * 60
SUITE = q.silver_suite(20 * DAY)


@pytest.fixture
def silver(spark, settings):
    return s.silver_table(spark, settings)


@pytest.fixture
def states(silver, settings):
    return sg.GateStates(silver, settings.gate_path)


def load(spark, silver, *rows):
    """Rows as ``(reading, day, ingested, vitals)``."""
    made = [
        bronze_row(r, recorded_at=AS_OF - minutes(d * DAY + 5), ingested_at=AS_OF + minutes(i), **v)
        for r, d, i, v in rows
    ]
    silver.upsert(s.shape_silver(bronze(spark, made), AS_OF))


def behind(silver, reading, day, copies=1):
    """Copies of a stored reading put into a day's folder without the table's knowledge."""
    rows = silver.read().filter(F.col("reading_id") == reading).limit(1)
    for _ in range(copies):
        path = f"{silver.path}/_part={day}"
        moved = rows.withColumn("recorded_at", F.lit(f"{day} 12:00:00").cast("timestamp"))
        moved.coalesce(1).write.mode("append").parquet(path)


def day_of(d):
    return str((AS_OF - minutes(d * DAY + 5)).date())


def same(silver, states, suite=SUITE):
    """Both gates agree on every expectation; returns the failing ones with their counts."""
    order = lambda df: sorted(map(tuple, df.collect()))
    full = order(q.suite_results(q.with_age(silver.read(), AS_OF), suite))
    assert order(states.results(suite, AS_OF)) == full
    return {kind: n for _, kind, _, ok, n in full if not ok}


def test_only_touched_days_are_measured(spark, silver, states):
    load(spark, silver, *[(f"r{d}{k}", d, 0, {}) for d in range(3) for k in range(4)])
    assert states.refresh(SUITE) == sorted(day_of(d) for d in range(3))
    assert states.refresh(SUITE) == [] and same(silver, states) == {}
    load(spark, silver, ("r10", 1, 1, {"spo2": 3}), ("new", 5, 1, {}))
    assert states.refresh(SUITE) == sorted([day_of(1), day_of(5)])
    assert same(silver, states) == {"expect_column_values_to_be_between": 1}
    load(spark, silver, ("r10", 2, 2, {}))  # mended, and moved to another day
    assert states.refresh(SUITE) == sorted([day_of(1), day_of(2)])
    assert same(silver, states) == {}


def test_repeats_across_days_are_counted_exactly(spark, silver, states):
    load(spark, silver, ("a", 0, 0, {}), ("b", 1, 0, {}), ("c", 2, 0, {}))
    assert same(silver, states) == {}
    behind(silver, "a", day_of(2))
    assert same(silver, states) == {"expect_column_values_to_be_unique": 2}
    # a third day, later: the index did not know of the second
    behind(silver, "a", day_of(4), copies=3)
    behind(silver, "b", day_of(1))
    assert same(silver, states) == {"expect_column_values_to_be_unique": 7}
    shutil.rmtree(Path(silver.path) / f"_part={day_of(4)}")
    assert same(silver, states) == {"expect_column_values_to_be_unique": 4}
    load(spark, silver, ("b", 1, 1, {}))  # the upsert leaves one row of b
    assert same(silver, states) == {"expect_column_values_to_be_unique": 2}


def test_verdicts_and_samples_equal_the_full_gate(spark, silver, states, settings):
    load(spark, silver, ("a", 0, 0, {"heart_rate": 999}), ("b", 3, 0, {}), ("c", 30, 0, {"spo2": 1}))
    behind(silver, "b", day_of(0))
    options = {"as_of": AS_OF, "not_in_future": True, "max_age_minutes": 60}
    plain = q.run_silver_quality_gate(silver.read(), raise_on_failure=False, **options)
    stored = sg.run_stored_gate(
        states, raise_on_failure=False, results_path=settings.quality_path, **options
    )
    assert stored == plain and len(plain.failures) == 4
    assert q.read_results(spark, settings.quality_path).count() == 1
    with pytest.raises(q.QualityGateError):
        sg.run_stored_gate(states, **options)


def test_lost_states_and_a_changed_suite_are_measured_again(spark, silver, states, settings):
    load(spark, silver, ("a", 0, 0, {}), ("b", 1, 0, {}))
    both = sorted([day_of(0), day_of(1)])
    assert states.refresh(SUITE) == both
    # the age bound is judged on stored stamps, a range is not
    assert states.refresh(q.silver_suite(5, freshness="newest")) == []
    narrow = [*SUITE[:-1], q.between("heart_rate", 0, 10), SUITE[-1]]
    assert states.refresh(narrow) == both
    assert same(silver, states, narrow) == {"expect_column_values_to_be_between": 2}
    shutil.rmtree(f"{settings.gate_path}/states")
    assert states.refresh(narrow) == both
    bounds = [q.column_max_between("spo2", 90, 99), q.column_min_between("spo2", 99, None)]
    assert same(silver, states, [*SUITE, *bounds]) == {"expect_column_min_to_be_between": 0}


def test_an_emptied_table_fails_and_other_keys_are_refused(spark, silver, states):
    load(spark, silver, ("a", 0, 0, {}))
    states.refresh(SUITE)
    silver.replace(silver.read().limit(0))
    failing = same(silver, states)
    assert set(failing) == {"expect_table_row_count_to_be_between", "expect_column_max_to_be_between"}
    with pytest.raises(ValueError, match="patient_id"):
        states.refresh([q.unique("patient_id")])


def test_an_increment_opens_only_its_days(spark, silver, states):
    load(spark, silver, *[(f"r{d}", d, 0, {}) for d in range(4)])
    states.refresh(SUITE)
    load(spark, silver, ("r1", 1, 1, {}))
    opened = []
    rows_of = silver.rows_of
    silver.rows_of = lambda parts=None: opened.append(parts) or rows_of(parts)
    states.refresh(SUITE)
    assert opened and all(parts == [day_of(1)] for parts in opened)
