from __future__ import annotations

import json
from pathlib import Path

import pytest
from helpers import AS_OF, SEVERE, T0, messages, minutes, reading

from wardflow.functions.ids import uuid5
from wardflow.operators import gold as g
from wardflow.operators import lineage as ln
from wardflow.operators import quality as q
from wardflow.operators import silver as s
from wardflow.plans import run as r
from wardflow.schemas import CHUNK
from wardflow.sources import messages as msg
from wardflow.streaming import ingest as ing

GUIDE = """---
title: Low oxygen
source: Ward handbook
topic: oxygen
---
# Oxygen target
Aim for a saturation of 94-98 percent in most adults. Give oxygen early when saturation falls.

## When to call
Call the outreach team when the early warning score reaches seven. Repeat observations hourly.
"""


def write_corpus(settings):
    folder = Path(settings.corpus_dir)
    folder.mkdir(parents=True)
    (folder / "low-oxygen.md").write_text(GUIDE)
    (folder / "README.md").write_text("# Not a guideline\nignored text here")


def iso(t):
    return t.isoformat()


def write_input(tmp_path, extra=()):
    lines = []
    for i in range(12):
        vitals = SEVERE if i % 6 == 5 else {}
        lines.append(
            json.dumps(
                {
                    **reading(
                        reading_id=f"r{i}",
                        patient_id=f"P10000{i % 3}",
                        recorded_at=iso(AS_OF - minutes(10 * i + 1)),
                        **vitals,
                    ),
                    "_corruption": "none",
                }
            )
        )
    lines += ["", "   ", json.dumps(reading(spo2=3)), "[1]", *extra]
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(lines))
    return str(path)


def test_full_run_and_its_lineage(spark, settings, tmp_path):
    write_corpus(settings)
    run_id = "night-shift-42"
    out = r.run_pipeline(spark, settings, write_input(tmp_path), run_id, as_of=AS_OF)
    assert out["parent_run_id"] == run_id
    assert out["ingest"] == {"consumed": 14, "valid": 12, "rejected": 2}
    assert out["silver"]["num_target_rows_inserted"] == 12
    assert out["gold"]["silver_rows"] == 12 and out["gold"]["gold_rows"] < 12
    assert out["rag_index"] == 2

    events = ln.read_events(spark, settings.lineage_path)
    summary = ln.run_summary(events).orderBy("started_at").collect()
    assert [x["job"] for x in summary] == [
        "ingest", "build_silver", "quality_gate", "build_gold", "rag_index",
    ]
    assert {x["status"] for x in summary} == {"COMPLETE"}
    assert {x["events"] for x in summary} == {2} and all(x["seconds"] >= 0 for x in summary)
    [total] = ln.events_per_run(events).collect()
    assert (total["parent_run_id"], total["events"], total["failed"]) == (run_id, 10, 0)

    dead = ing.deadletter_table(spark, settings).rows().collect()
    assert sorted(e for x in dead for e in x["errors"]) == [
        "record: expected a JSON object, got list",
        "spo2: Input should be greater than or equal to 50",
    ]


def test_a_failing_gate_halts_the_run(spark, settings, tmp_path):
    write_corpus(settings)
    late = json.dumps(reading(reading_id="old", recorded_at=iso(AS_OF - minutes(5000))))
    with pytest.raises(q.QualityGateError):
        r.run_pipeline(spark, settings, write_input(tmp_path, [late]), as_of=AS_OF)
    assert not g.gold_table(spark, settings).exists()
    assert not r.index_table(spark, settings).exists()
    rows = ln.run_summary(ln.read_events(spark, settings.lineage_path)).collect()
    status = {x["job"]: x["status"] for x in rows}
    assert status == {"ingest": "COMPLETE", "build_silver": "COMPLETE", "quality_gate": "FAIL"}


def test_a_broken_stage_is_told_from_the_ones_around_it(spark, settings):
    steps = ln.Lineage(spark, settings, "night")
    with steps.stage("ingest", outputs=["table.bronze"]) as run:
        run.rows(valid=3)
    with pytest.raises(KeyError), steps.stage("build_silver", inputs=["table.bronze"]):
        {}["no such reading"]
    with steps.stage("build_gold", outputs=["table.gold"]):
        pass
    told = {}
    for event in ln.read_events(spark, settings.lineage_path).collect():
        told.setdefault(event["job"]["name"], {})[event["eventType"]] = event
    ends = {job: (set(kinds) - {"START"}).pop() for job, kinds in told.items()}
    assert ends == {"ingest": "COMPLETE", "build_silver": "FAIL", "build_gold": "COMPLETE"}
    errors = {job: told[job][end]["run"]["facets"]["errorMessage"] for job, end in ends.items()}
    assert errors["ingest"] is None and errors["build_gold"] is None
    assert "no such reading" in errors["build_silver"]["message"]
    assert "test_a_broken_stage" in errors["build_silver"]["stackTrace"]
    ids = {kind["run"]["runId"] for kinds in told.values() for kind in kinds.values()}
    assert len(ids) == 3
    [total] = ln.events_per_run(ln.read_events(spark, settings.lineage_path)).collect()
    assert (total["parent_run_id"], total["events"], total["failed"]) == ("night", 6, 1)


def test_run_id_comes_from_the_environment(spark, settings, monkeypatch):
    monkeypatch.setenv("PIPELINE_RUN_ID", "from-env")
    assert ln.Lineage(spark, settings).parent_run_id == "from-env"
    assert ln.Lineage(spark, settings, "given").parent_run_id == "given"


def test_uuid5_equals_pythons(spark):
    import uuid

    names = ["a::0", "sepsis::12", "é::3"]
    df = spark.createDataFrame([(n,) for n in names], ["n"])
    namespace = "6f9619ff-8b86-d011-b42d-00cf4fc964ff"
    got = [x["u"] for x in df.select(uuid5(df["n"]).alias("u")).collect()]
    assert got == [str(uuid.uuid5(uuid.UUID(namespace), n)) for n in names]


def test_records_are_keyed_by_patient_without_the_mark(spark):
    marked = json.dumps({"_corruption": "x", **reading(), "on_supplemental_o2": False})
    lines = spark.createDataFrame([(marked,), ("[1,  2]",), ("  ",)], "value string")
    keyed = msg.keyed_records(msg.nonblank_lines(lines))
    rows = {x["key"]: x["value"] for x in keyed.collect()}
    assert json.loads(rows["P100001"]) == reading() and rows[None] == "[1,  2]"


def test_lines_of_several_files_are_ingested_in_their_order(spark, settings, tmp_path):
    """The first file stays first, so the last line of the second wins."""
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [json.dumps(reading(reading_id=f"q{k}", heart_rate=60 + k % 40)) for k in range(300)]
    again = [json.dumps(reading(reading_id="q0", heart_rate=91)), ""]
    (folder / "a.jsonl").write_text("\n".join(lines[:5]))
    (folder / "b.jsonl").write_text("\n".join(lines[5:] + again))
    path = f"{folder}/*.jsonl"
    rows = msg.read_lines(spark, path, "t", split_bytes=1000).orderBy("offset").collect()
    assert [json.loads(x["value"])["reading_id"] for x in rows] == [*[f"q{k}" for k in range(300)], "q0"]
    ing.ingest_available(msg.stream_lines(spark, path, "t"), settings, as_of=AS_OF)
    ing.refresh_after(spark, settings, AS_OF)
    silver = s.silver_table(spark, settings).read().filter("reading_id = 'q0'").collect()
    assert [x["heart_rate"] for x in silver] == [91]


def test_rejected_messages_go_to_a_sink_as_json(spark, settings, tmp_path):
    sent = []
    ing.ingest_batch(
        messages(spark, [reading(), reading(spo2=1), "no json"]), settings, "b", AS_OF,
        deadletters=lambda rows: sent.extend(rows.collect()),
    )
    found = sorted((json.loads(x["value"]) for x in sent), key=lambda d: d["source"]["offset"])
    assert [x["key"] for x in sent] == [None, None]
    assert found[0]["raw"]["spo2"] == 1 and found[1]["raw"] == "no json"
    assert found[1]["errors"] == ["record: invalid JSON"]


# streaming


def feed(spark, folder, name, values):
    messages(spark, values).coalesce(1).write.json(f"{folder}/{name}")


def stream(spark, folder):
    return msg.stream_messages(spark, f"{folder}/*", max_files=1)


def test_stream_equals_batch_and_restarts_where_it_stopped(spark, settings, tmp_path):
    topic = tmp_path / "topic"
    feed(spark, topic, "a", [reading(reading_id="a"), reading(spo2=1)])
    feed(spark, topic, "b", [reading(reading_id="b")])
    stats = ing.ingest_available(stream(spark, topic), settings, as_of=AS_OF)
    assert stats.as_dict() == {"consumed": 3, "valid": 2, "rejected": 1}
    assert ing.ingest_available(stream(spark, topic), settings, as_of=AS_OF).consumed == 0
    feed(spark, topic, "c", [reading(reading_id="c")])
    assert ing.ingest_available(stream(spark, topic), settings, as_of=AS_OF).valid == 1
    ids = {x["reading_id"] for x in s.bronze_table(spark, settings).rows().collect()}
    assert ids == {"a", "b", "c"}


def test_a_batch_whose_commit_was_lost_is_replayed_without_copies(spark, settings, tmp_path):
    topic = tmp_path / "topic"
    feed(spark, topic, "a", [reading(reading_id="a"), reading(spo2=1)])
    ing.ingest_available(stream(spark, topic), settings, as_of=AS_OF)
    commits = Path(settings.checkpoint_path) / "ingest" / "commits"
    for name in ("0", ".0.crc"):
        (commits / name).unlink(missing_ok=True)
    ing.ingest_available(stream(spark, topic), settings, as_of=AS_OF)
    assert s.bronze_table(spark, settings).rows().count() == 1
    assert ing.deadletter_table(spark, settings).rows().count() == 1


def test_incremental_refresh_equals_a_full_rebuild(spark, settings):
    def ingest(values, batch, at):
        ing.ingest_batch(messages(spark, values), settings, batch, AS_OF, ingested_at=at)

    first = [
        reading(reading_id=f"r{i}", patient_id=f"P10000{i % 2}", recorded_at=iso(T0 + minutes(35 * i)))
        for i in range(8)
    ]
    ingest(first, "1", T0 + minutes(300))
    ing.refresh_after(spark, settings, AS_OF)
    lonely = reading(reading_id="r7", patient_id="P100001", recorded_at=iso(T0 + minutes(5)))
    moved = reading(reading_id="r1", patient_id="P100001", recorded_at=iso(T0 + minutes(61)), **SEVERE)
    ingest([moved, lonely, reading(reading_id="new", recorded_at=iso(T0))], "2", T0 + minutes(301))
    out = ing.refresh_after(spark, settings, AS_OF)
    assert out["silver"]["num_target_rows_updated"] == 2
    assert out["gold"]["silver_rows"] < 9

    current = g.gold_table(spark, settings).read().drop("computed_at")
    full = g.aggregate_gold(s.silver_table(spark, settings).read()).drop("computed_at")
    assert sorted(map(tuple, current.collect())) == sorted(map(tuple, full.collect()))


def one(reading_id, at, rate=80):
    return reading(
        reading_id=reading_id, patient_id="P100001", recorded_at=iso(T0 + minutes(at)), heart_rate=rate
    )


def hours(spark, settings):
    rows = g.gold_table(spark, settings).read().orderBy("window_start").collect()
    return [(x["window_start"].hour, x["mean_heart_rate"]) for x in rows]


@pytest.mark.parametrize("by_batch", [True, False])
def test_a_crash_between_silver_and_gold_leaves_no_stale_hour(spark, settings, monkeypatch, by_batch):
    """A correction moves a reading two hours on; the job dies before Gold, then runs again."""

    def ingest(values, batch, at):
        ing.ingest_batch(messages(spark, values), settings, batch, AS_OF, ingested_at=at)

    ingest([one("x", 0)], "1", T0)
    ing.refresh_after(spark, settings, AS_OF, "1" if by_batch else None)
    assert hours(spark, settings) == [(T0.hour, 80.0)]
    ingest([one("x", 120, 90)], "2", T0 + minutes(5))
    with monkeypatch.context() as patch:
        patch.setattr(g, "build_gold", lambda *a, **k: 1 / 0)
        for _ in range(2):
            with pytest.raises(ZeroDivisionError):
                ing.refresh_after(spark, settings, AS_OF, "2" if by_batch else None)
    ing.refresh_after(spark, settings, AS_OF, "2" if by_batch else None)
    assert hours(spark, settings) == [(T0.hour + 2, 90.0)]
    assert not ing.pending_hours(spark, settings).exists()


@pytest.mark.parametrize("mode", ["batch", "offsets"])
def test_an_older_version_that_comes_later_changes_nothing(spark, settings, mode):
    log, silver_ = s.bronze_table(spark, settings), s.silver_table(spark, settings)
    for label, value, at in (("new", 125, 5), ("old", 70, 0)):
        batch = messages(spark, [one("x", 0, value)])
        ing.ingest_batch(batch, settings, label, AS_OF, ingested_at=T0 + minutes(at))
        if mode == "batch":
            ing.refresh_after(spark, settings, AS_OF, label)
        else:
            s.build_silver(log, silver_, mode="offsets", as_of=AS_OF)
    assert [x["heart_rate"] for x in silver_.read().collect()] == [125]


def test_a_new_checkpoint_adds_to_bronze(spark, settings, tmp_path):
    feed(spark, tmp_path / "old", "a", [reading(reading_id="a"), reading(reading_id="b")])
    feed(spark, tmp_path / "new", "c", [reading(reading_id="c")])
    ing.ingest_available(stream(spark, tmp_path / "old"), settings, as_of=AS_OF)
    moved = Path(settings.checkpoint_path)
    moved.rename(moved.with_name("checkpoints-before"))
    ing.ingest_available(stream(spark, tmp_path / "new"), settings, as_of=AS_OF)
    ids = sorted(x["reading_id"] for x in s.bronze_table(spark, settings).rows().collect())
    assert ids == ["a", "b", "c"]


def test_each_micro_batch_can_refresh_the_tables(spark, settings, tmp_path):
    topic = tmp_path / "topic"
    feed(spark, topic, "a", [reading(reading_id="a")])
    feed(spark, topic, "b", [reading(reading_id="a", heart_rate=200), reading(reading_id="b")])
    ing.ingest_available(
        stream(spark, topic),
        settings,
        as_of=AS_OF,  # so every batch has the same stamp: a watermark alone would miss the second
        tasks=2,
        after_batch=lambda batch: ing.refresh_after(spark, settings, AS_OF, batch),
    )
    [row] = g.gold_table(spark, settings).read().collect()
    assert row["readings_in_window"] == 2 and row["mean_heart_rate"] == 133.0


def test_windowed_stream_emits_closed_hours_once(spark, settings, tmp_path):
    from helpers import silver, silver_row

    rows = [silver_row(f"r{i}", recorded_at=T0 + minutes(20 * i)) for i in range(12)]
    silver(spark, rows).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(silver(spark, []).schema).parquet(str(tmp_path / "in"))
    query = (
        g.windowed_gold(source, lateness="10 minutes")
        .writeStream.format("memory").queryName("closed_hours").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    hours = spark.table("closed_hours").orderBy("window_start").collect()
    assert [(x["window_start"].hour, x["readings_in_window"]) for x in hours] == [
        (10, 3), (11, 3), (12, 3),
    ]


# index


def test_index_upsert_and_prune(spark, settings):
    from wardflow.operators.chunking import build_chunks

    write_corpus(settings)
    table = r.index_table(spark, settings)
    chunks = build_chunks(spark, settings.corpus_dir)
    assert chunks.columns == CHUNK.fieldNames()
    assert r.build_index(chunks, table) == 2
    shorter = chunks.filter("ordinal = 0")
    r.build_index(shorter, table, recreate=False)
    assert table.read().count() == 2
    r.build_index(shorter, table, recreate=False, prune=True)
    assert table.read().count() == 1


def test_the_package_is_shipped_to_the_workers_once(spark):
    from wardflow.session import prepare

    prepare(spark)
    prepare(spark)
    shipped = [f for f in spark.sparkContext.listFiles if f.endswith("/wardflow.zip")]
    assert len(shipped) == 1
