from __future__ import annotations

import pytest
from helpers import AS_OF, SEVERE, T0, bronze, bronze_row, minutes, silver, silver_row
from pyspark.sql import functions as F

from wardflow.operators import gold as g
from wardflow.operators import silver as s
from wardflow.sources.tables import KeyedTable
from wardflow.streaming.ingest import refresh_after


@pytest.fixture
def tables(spark, settings):
    return (
        s.bronze_table(spark, settings),
        s.silver_table(spark, settings),
        g.gold_table(spark, settings),
    )


def current(silver_table):
    return {r["reading_id"]: r for r in silver_table.read().collect()}


def test_a_late_correction_updates_in_place(spark, tables):
    log, sv, _ = tables
    log.append(bronze(spark, [bronze_row("R1", heart_rate=80), bronze_row("R2", heart_rate=90)]))
    assert s.build_silver(log, sv).num_target_rows_inserted == 2
    log.append(bronze(spark, [bronze_row("R1", heart_rate=125, ingested_at=T0 + minutes(5))]))
    metrics = s.build_silver(log, sv)
    assert (metrics.num_target_rows_updated, metrics.num_target_rows_inserted) == (1, 0)
    assert {k: r["heart_rate"] for k, r in current(sv).items()} == {"R1": 125, "R2": 90}
    log.append(bronze(spark, [bronze_row("R3", ingested_at=T0 + minutes(10))]))
    assert s.build_silver(log, sv).num_target_rows_inserted == 1
    assert s.build_silver(log, sv).source_rows == 0


def test_equal_stamp_is_missed_by_the_watermark_but_not_by_offsets(spark, tables):
    log, sv, _ = tables
    log.append(bronze(spark, [bronze_row("R1", offset=1)]))
    s.build_silver(log, sv)
    seen = s.last_offsets(log.rows())
    log.append(bronze(spark, [bronze_row("R2", offset=2)]))
    assert s.build_silver(log, sv).source_rows == 0
    assert s.build_silver(log, sv, mode="offsets", seen_offsets=seen).num_target_rows_inserted == 1


def test_remerge_keeps_and_rebuild_drops_rows_bronze_lacks(spark, tables):
    log, sv, _ = tables
    sv.upsert(silver(spark, [silver_row("OLD")]))
    log.append(bronze(spark, [bronze_row("R1")]))
    s.build_silver(log, sv, mode="remerge")
    assert set(current(sv)) == {"OLD", "R1"}
    s.build_silver(log, sv, mode="rebuild")
    assert set(current(sv)) == {"R1"}


def test_duplicates_keep_the_latest_and_ties_the_later_offset(spark):
    rows = [
        bronze_row("R1", heart_rate=60, offset=9),
        bronze_row("R1", heart_rate=70, ingested_at=T0 + minutes(1), offset=1),
        bronze_row("R1", heart_rate=80, ingested_at=T0 + minutes(1), offset=2),
    ]
    out = s.shape_silver(bronze(spark, rows), AS_OF).collect()
    assert [r["heart_rate"] for r in out] == [80]
    assert out[0]["updated_at"] == AS_OF.replace(tzinfo=None)


def test_hour_is_floored(spark):
    row = bronze_row(recorded_at=T0 + minutes(59.9))
    assert s.shape_silver(bronze(spark, [row])).first()["recorded_hour"] == T0.replace(tzinfo=None)


def test_only_one_row_per_key_and_task_is_shuffled(spark):
    plan = s.latest_readings(bronze(spark, [bronze_row()]))._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_readings_fall_into_patient_hours(spark):
    rows = [
        silver_row(f"{p}/{k}", f"P20000{p}", T0 + minutes(25 * k)) for p in range(3) for k in range(p + 6)
    ]
    out = g.aggregate_gold(silver(spark, rows)).collect()
    found = {(r["patient_id"], r["window_start"].hour): r["readings_in_window"] for r in out}
    wanted = {}
    for p in range(3):
        for k in range(p + 6):
            key = f"P20000{p}", T0.hour + 25 * k // 60
            wanted[key] = wanted.get(key, 0) + 1
    assert found == wanted
    assert {r["worst_risk_band"] for r in out} == {"low"}


def test_an_hour_is_as_bad_as_its_worst_reading(spark):
    times = [T0 + minutes(k) for k in (3, 20, 41, 59)]
    rows = [silver_row(str(k), recorded_at=t) for k, t in enumerate(times[:3])]
    rows.append(silver_row("bad", recorded_at=times[3], **SEVERE))
    row = g.aggregate_gold(silver(spark, rows)).first()
    assert (row["readings_in_window"], row["max_news2"], row["mean_news2"]) == (4, 17, 4.25)
    assert (row["worst_risk_band"], row["min_spo2"], row["max_resp_rate"]) == ("high", 90, 27)
    assert row["pct_readings_on_oxygen"] == 0.25
    assert [row["first_reading_at"], row["last_reading_at"]] == [
        t.replace(tzinfo=None) for t in (times[0], times[3])
    ]


def test_means_round_half_to_even(spark):
    rows = [silver_row(str(i), on_supplemental_o2=i == 0) for i in range(16)]
    assert g.aggregate_gold(silver(spark, rows)).first()["pct_readings_on_oxygen"] == 0.062


def test_windowed_gold_equals_the_hour_aggregate(spark):
    rows = [silver_row(str(i), recorded_at=T0 + minutes(17 * i), heart_rate=60 + i) for i in range(20)]
    df = silver(spark, rows)
    a = sorted(map(tuple, g.aggregate_gold(df).drop("computed_at").collect()))
    assert a == sorted(map(tuple, g.windowed_gold(df).collect()))


def test_rerun_refreshes_the_open_hour(spark, tables):
    _, sv, gd = tables
    sv.upsert(silver(spark, [silver_row("a")]))
    assert g.build_gold(sv, gd)["num_target_rows_inserted"] == 1
    sv.upsert(silver(spark, [silver_row("b")]))
    metrics = g.build_gold(sv, gd)
    assert metrics == {
        "gold_rows": 1, "silver_rows": 2, "num_target_rows_updated": 1, "num_target_rows_inserted": 0,
    }
    assert gd.read().first()["readings_in_window"] == 2


def test_empty_silver_builds_nothing(spark, tables):
    _, sv, gd = tables
    sv.replace(silver(spark, []))
    assert g.build_gold(sv, gd) == {"gold_rows": 0, "silver_rows": 0}
    assert not gd.exists()


def test_an_emptied_hour_stays_unless_pruned(spark, tables):
    _, sv, gd = tables
    sv.upsert(silver(spark, [silver_row("a")]))
    g.build_gold(sv, gd)
    sv.upsert(silver(spark, [silver_row("a", recorded_at=T0 + minutes(120))]))
    g.build_gold(sv, gd)
    assert gd.read().count() == 2
    g.build_gold(sv, gd, prune=True)
    assert gd.read().count() == 1


def test_touched_buckets_cover_where_a_reading_was_and_is(spark):
    before = silver(spark, [silver_row("a")])
    moved = silver(spark, [silver_row("a", recorded_at=T0 + minutes(120))])
    hours = {r["recorded_hour"].hour for r in g.touched_buckets(moved, before).collect()}
    assert hours == {10, 12}


@pytest.fixture
def gold_rows(spark):
    rows = []
    for p, h, severe in [("P1", 0, 0), ("P1", 1, 1), ("P1", 3, 0), ("P2", 0, 1), ("P2", 24 * 40, 0)]:
        rows.append(silver_row(f"{p}{h}", p, T0 + minutes(60 * h), **(SEVERE if severe else {})))
    return g.aggregate_gold(silver(spark, rows)).cache()


def test_worst_windows(gold_rows):
    assert [r["patient_id"] for r in g.worst_windows(gold_rows, 2).collect()] == ["P1", "P2"]
    per_patient = {r["patient_id"]: r["window_start"].hour for r in g.worst_window_per_patient(gold_rows).collect()}
    assert per_patient == {"P1": 11, "P2": 10}


def test_trend_carries_over_months(gold_rows):
    rows = {(r["patient_id"], r["window_start"]): r["change"] for r in g.trend(gold_rows).collect()}
    t0 = T0.replace(tzinfo=None)
    assert rows[("P1", t0)] is None
    assert rows[("P1", t0 + minutes(60))] == 17.0
    assert rows[("P1", t0 + minutes(180))] == -17.0
    assert rows[("P2", t0 + minutes(60 * 24 * 40))] == -17.0


def test_find_windows(gold_rows):
    assert g.find_windows(gold_rows, "P1").count() == 3
    assert g.find_windows(gold_rows, "P1", T0).count() == 1
    with pytest.raises(LookupError, match="no matching Gold row"):
        g.find_windows(gold_rows, "P9")


def test_profiles(gold_rows, spark):
    assert {r["worst_risk_band"]: r["windows"] for r in g.band_histogram(gold_rows).collect()} == {
        "low": 3, "high": 2,
    }
    assert g.reduction(gold_rows).first().asDict() == {
        "silver_rows": 5, "gold_rows": 5, "reduction_ratio": 1.0,
    }
    profile = s.table_profile(bronze(spark, [bronze_row("a"), bronze_row("b", spo2=90)])).first()
    assert (profile["row_count"], profile["distinct_patients"], profile["min_spo2"]) == (2, 1, 90)


def test_gold_partial_aggregation_in_the_plan(spark):
    plan = g.aggregate_gold(silver(spark, [silver_row()]))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "partial_max" in plan and "SortAggregate" not in plan
    assert F is not None


def test_a_refresh_reads_only_the_days_it_touches(spark, settings, tables, monkeypatch):
    """Neither the watermark, nor the places of corrected readings, nor Gold scan all of Silver."""
    log, sv, gd = tables
    days = [T0 - minutes(1440 * d) for d in range(6)]
    log.append(bronze(spark, [bronze_row(f"R{d}", recorded_at=at) for d, at in enumerate(days)]))
    refresh_after(spark, settings)
    late = T0 + minutes(5)
    log.append(bronze(spark, [bronze_row("R2", recorded_at=days[3], ingested_at=late, heart_rate=140)]))
    read, load = [], KeyedTable._load
    monkeypatch.setattr(KeyedTable, "_load", lambda self, parts=None: read.append((self.path, parts)) or load(self, parts))
    done = refresh_after(spark, settings)
    assert done["silver"]["num_target_rows_updated"] == 1 and done["gold"]["gold_rows"] == 1
    wanted = {str(days[2].date()), str(days[3].date())}
    assert read and all(parts is not None and set(parts) <= wanted for _, parts in read)
    assert {sv.path, gd.path} == {path for path, _ in read}
    assert current(sv)["R2"]["heart_rate"] == 140 and gd.read().count() == 5
