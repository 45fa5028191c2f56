from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from helpers import T0, bronze, bronze_row, minutes
from hypothesis import HealthCheck, given
from hypothesis import settings as hsettings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.upsert import merge_metrics, merge_rows, newest_rows
from wardflow.schemas import BRONZE, SchemaError, enforce_schema
from wardflow.session import materialize, shared_dir, work_tables
from wardflow.sources import key_index
from wardflow.sources.tables import AppendLog, KeyedTable, TableMissing, merge_statement

KV = T.StructType().add("k", "integer", False).add("day", "string", False).add("v", "string", False)


def kv(spark, rows):
    return spark.createDataFrame(rows, KV)


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), KV, ("k",), "day", partition_on=("day",))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_bronze_round_trip(spark, tmp_path):
    log = AppendLog(spark, str(tmp_path / "b"), BRONZE, day="ingested_at")
    assert not log.exists()
    assert log.append(bronze(spark, [bronze_row("R1"), bronze_row("R1"), bronze_row("R2")])) == 3
    assert log.append(bronze(spark, [])) == 0
    assert log.rows().count() == 3
    assert log.rows().schema.fieldNames() == BRONZE.fieldNames()


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    log = AppendLog(spark, str(tmp_path / "b"), BRONZE, day="ingested_at")
    for _ in range(2):
        log.append(bronze(spark, [bronze_row("R1")]), "s-1")
    log.append(bronze(spark, [bronze_row("R2")]), "s-2")
    assert log.rows().count() == 2


def test_since_prunes_days(spark, tmp_path):
    log = AppendLog(spark, str(tmp_path / "b"), BRONZE, day="ingested_at")
    log.append(bronze(spark, [bronze_row(str(d), ingested_at=T0 + minutes(1440 * d)) for d in range(4)]))
    newer = log.since("ingested_at", T0 + minutes(1440 * 2))
    assert [r["reading_id"] for r in newer.collect()] == ["3"]
    plan = newer._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_day" in plan


@pytest.mark.parametrize(
    "change",
    [
        lambda df: df.withColumn("heart_rate", F.col("heart_rate").cast("string")),
        lambda df: df.withColumn("triage_note", F.lit("x")),
        lambda df: df.drop("spo2"),
    ],
)
def test_schema_refusals(spark, tmp_path, change):
    log = AppendLog(spark, str(tmp_path / "b"), BRONZE)
    with pytest.raises(SchemaError):
        log.append(change(bronze(spark, [bronze_row()])))
    assert not log.exists()


def test_a_null_in_a_required_column_fails_the_write(spark, tmp_path):
    df = bronze(spark, [bronze_row()]).withColumn(
        "spo2", F.when(F.col("heart_rate") < 0, F.col("spo2"))
    )
    log = AppendLog(spark, str(tmp_path / "b"), BRONZE)
    with pytest.raises(Exception, match="required column spo2"):
        log.append(df)


def test_enforce_schema_puts_columns_in_order(spark):
    df = bronze(spark, [bronze_row()])
    assert enforce_schema(df.select(*reversed(df.columns)), BRONZE).columns == BRONZE.fieldNames()


def test_missing_table(table):
    with pytest.raises(TableMissing):
        table.read()


def test_upsert_counts_and_contents(spark, table):
    first = table.upsert(kv(spark, [(1, "a", "x"), (2, "b", "x"), (3, "b", "x")]))
    assert first.as_dict() == {
        "source_rows": 3, "num_target_rows_updated": 0, "num_target_rows_inserted": 3,
    }
    second = table.upsert(kv(spark, [(2, "b", "y"), (4, "c", "y")]))
    assert (second.num_target_rows_updated, second.num_target_rows_inserted) == (1, 1)
    assert rows(table.read()) == [(1, "a", "x"), (2, "b", "y"), (3, "b", "x"), (4, "c", "y")]


def test_a_row_that_changes_partition_leaves_no_copy(spark, table):
    table.upsert(kv(spark, [(1, "a", "x"), (2, "a", "x"), (3, "c", "x")]))
    table.upsert(kv(spark, [(1, "b", "y"), (3, "b", "y")]))
    assert rows(table.read()) == [(1, "b", "y"), (2, "a", "x"), (3, "b", "y")]


def files(table, part):
    return sorted(p.name for p in Path(table.path, f"_part={part}").glob("part-*"))


def test_untouched_partitions_keep_their_files(spark, table):
    table.upsert(kv(spark, [(1, "a", "x"), (2, "b", "x")]))
    before = files(table, "a"), files(table, "b")
    table.upsert(kv(spark, [(2, "b", "y")]))
    assert files(table, "a") == before[0] and files(table, "b") != before[1]


def test_reads_prune_partitions(spark, tmp_path):
    """A table partitioned by its key reads only the arriving partitions."""
    table = KeyedTable(spark, str(tmp_path / "t"), KV, ("k", "day"), "day", partition_on=("day",))
    table.upsert(kv(spark, [(1, "a", "x"), (2, "b", "x"), (3, "c", "x")]))
    plan = table.read(["b"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan or "PartitionFilters: [_part" in plan
    located = table.locate(kv(spark, [(2, "b", "y"), (2, "c", "y")]))
    assert [(r["k"], r["_part"]) for r in located.collect()] == [(2, "b")]
    assert table._parts_of(kv(spark, [(2, "b", "y")])) == ["b"]
    assert table._parts_of(kv(spark, [(2, "b", "y")]).select("k")) is None


def test_an_older_row_does_not_replace_a_newer_one(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), KV, ("k",), "day", ("day",), newest="v")
    table.upsert(kv(spark, [(1, "a", "5"), (2, "a", "5")]))
    out = table.upsert(kv(spark, [(1, "b", "4"), (2, "b", "6"), (3, "b", "1")]))
    assert rows(table.read()) == [(1, "a", "5"), (2, "b", "6"), (3, "b", "1")]
    assert (out.num_target_rows_updated, out.num_target_rows_inserted) == (1, 1)
    assert table.parts() == ["a", "b"]


def test_an_upsert_cut_short_is_completed_by_the_same_one(spark, table):
    """As if the job had died after putting one of two partitions in place."""
    first, second = [(1, "a", "x"), (2, "b", "x")], [(1, "b", "y"), (2, "a", "y")]
    table.upsert(kv(spark, first))
    table._put(kv(spark, [(2, "a", "y")]).withColumn("_part", F.lit("a")))
    assert rows(table.read()) == [(2, "a", "y"), (2, "b", "x")]
    table.upsert(kv(spark, second))
    assert rows(table.read()) == sorted(second)


def test_merge_statement():
    assert merge_statement("delta.`/t`", "s", ("a", "b"), "at") == (
        "MERGE INTO delta.`/t` t USING s s ON t.a = s.a AND t.b = s.b "
        "WHEN MATCHED AND s.at >= t.at THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def test_replacing_and_prune(spark, table):
    table.upsert(kv(spark, [(1, "a", "x"), (2, "b", "x"), (3, "b", "x")]))
    days = spark.createDataFrame([("b",)], "day string")
    table.upsert(kv(spark, [(2, "b", "y"), (5, "b", "y")]), replacing=days)
    assert rows(table.read()) == [(1, "a", "x"), (2, "b", "y"), (5, "b", "y")]
    table.upsert(kv(spark, [(2, "b", "z")]), prune=True)
    assert rows(table.read()) == [(2, "b", "z")]


def test_upserts_leave_no_work_tables(spark, table):
    work = Path(shared_dir(spark).removeprefix("file:"), "work")
    before = set(work.glob("*"))
    table.upsert(kv(spark, [(1, "a", "x")]))
    table.upsert(kv(spark, [(1, "b", "y"), (2, "a", "y")]))
    table.replace(kv(spark, [(3, "c", "z")]))
    assert set(work.glob("*")) == before
    kept = materialize(kv(spark, [(1, "a", "x")]))
    with work_tables(spark):
        inner = materialize(kept)
        assert inner.count() == 1
    assert len(set(work.glob("*")) - before) == 1 and kept.count() == 1


def test_empty_source_changes_nothing(spark, table):
    table.upsert(kv(spark, [(1, "a", "x")]))
    assert table.upsert(kv(spark, [])).source_rows == 0
    assert rows(table.read()) == [(1, "a", "x")]


def test_repeated_source_key_is_refused(spark, table):
    with pytest.raises(ValueError, match="repeats a key"):
        table.upsert(kv(spark, [(1, "a", "x"), (1, "a", "y")]))


def test_a_failed_write_leaves_the_old_rows(spark, table):
    table.upsert(kv(spark, [(1, "a", "x")]))
    bad = kv(spark, [(1, "a", "x")]).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        table.upsert(bad)
    assert rows(table.read()) == [(1, "a", "x")]


def test_plain_merge_and_metrics(spark):
    target, source = kv(spark, [(1, "a", "x"), (2, "a", "x")]), kv(spark, [(2, "a", "y"), (3, "a", "y")])
    assert rows(merge_rows(target, source, ["k"])) == [(1, "a", "x"), (2, "a", "y"), (3, "a", "y")]
    assert merge_metrics(target, source, ["k"]).first().asDict() == {
        "source_rows": 2, "num_target_rows_updated": 1, "num_target_rows_inserted": 1,
    }
    newest = newest_rows(target, kv(spark, [(1, "b", "w"), (2, "b", "x")]), ["k"], "v")
    assert rows(newest) == [(1, "a", "x"), (2, "b", "x")]


BATCH = st.dictionaries(st.integers(0, 8), st.tuples(st.sampled_from("abc"), st.text("xyz", max_size=2)), max_size=6)


@hsettings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(BATCH, min_size=1, max_size=3))
def test_upserts_equal_last_write_wins(spark, tmp_path_factory, batches):
    table = KeyedTable(
        spark, str(tmp_path_factory.mktemp("t") / "t"), KV, ("k",), "day", ("day",)
    )
    expected: dict = {}
    for batch in batches:
        table.upsert(kv(spark, [(k, d, v) for k, (d, v) in batch.items()]))
        expected.update(batch)
    assert rows(table.read()) == sorted((k, d, v) for k, (d, v) in expected.items())


def test_an_upsert_reads_only_the_days_of_its_keys(spark, table, monkeypatch):
    """Keys are looked up beside the table; no read of all of it, however keys move."""
    table.upsert(kv(spark, [(k, f"d{k % 5}", "x") for k in range(50)]))
    read, load = [], KeyedTable._load
    monkeypatch.setattr(KeyedTable, "_load", lambda self, parts=None: read.append(parts) or load(self, parts))
    metrics = table.upsert(kv(spark, [(1, "d3", "y"), (77, "d9", "y")]))
    assert (metrics.num_target_rows_updated, metrics.num_target_rows_inserted) == (1, 1)
    assert read and all(parts is not None and set(parts) <= {"d1", "d3", "d9"} for parts in read)
    found = {r["k"]: (r["day"], r["v"]) for r in table.read(["d0", "d1", "d2", "d3", "d4", "d9"]).collect()}
    assert len(found) == 51 and found[1] == ("d3", "y") and found[77] == ("d9", "y")


def test_a_key_that_moved_often_is_one_row(spark, table):
    for turn, day in enumerate(["a", "b", "c", "a", "b"]):
        table.upsert(kv(spark, [(1, day, str(turn)), (2, "z", str(turn))]))
    assert rows(table.read()) == [(1, "b", "4"), (2, "z", "4")]


def test_a_job_that_dies_before_the_table_is_written(spark, table, monkeypatch):
    """The index is written ahead, so it may name a place the table does not have yet."""
    table.upsert(kv(spark, [(1, "a", "x")]))
    put = KeyedTable._put
    monkeypatch.setattr(KeyedTable, "_put", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        table.upsert(kv(spark, [(1, "b", "y"), (2, "b", "y")]))
    monkeypatch.setattr(KeyedTable, "_put", put)
    assert table.upsert(kv(spark, [(1, "c", "z"), (2, "b", "z")])).num_target_rows_updated == 1
    assert rows(table.read()) == [(1, "c", "z"), (2, "b", "z")]


def test_many_writes_of_an_index_become_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "MOST_FOLDERS", 3)
    index = key_index.KeyIndex(spark, str(tmp_path / "i"), [KV["k"]], "_part")
    for k in range(5):
        index.add(spark.createDataFrame([(k, "a"), (k, "b")], "k int, _part string"))
    assert len(index._stored.folders()) <= 3
    wanted = spark.createDataFrame([(0,), (4,), (9,)], "k int")
    assert rows(index.find(wanted)) == [(0, "a"), (0, "b"), (4, "a"), (4, "b")]


def test_the_index_of_a_table_from_before_is_made_once(spark, table, tmp_path):
    table.upsert(kv(spark, [(1, "a", "x"), (2, "b", "x")]))
    shutil.rmtree(tmp_path / "t_keys")
    assert table.upsert(kv(spark, [(1, "b", "y")])).num_target_rows_updated == 1
    assert rows(table.read()) == [(1, "b", "y"), (2, "b", "x")]


def test_the_newest_value_is_noted(spark, tmp_path):
    schema = T.StructType([*KV.fields, T.StructField("n", T.LongType(), False)])
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ("k",), "day", partition_on=("day",), newest="n")
    frame = lambda *values: spark.createDataFrame([(k, "a", "x", n) for k, n in values], schema)
    table.upsert(frame((1, 5), (2, 9)))
    assert table.newest_value() == 9 and table.mark.value() == 9
    table.upsert(frame((1, 7)))
    assert table.newest_value() == 9
    table.upsert(frame((1, 12)))
    assert table.newest_value() == 12
    table.replace(frame((1, 3)))
    assert table.newest_value() == 3
    table.mark = key_index.Mark(spark, str(tmp_path / "none"), schema["n"])
    assert table.newest_value() == 3
