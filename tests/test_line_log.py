from __future__ import annotations

import io

import pytest
from helpers import AS_OF, reading
from hypothesis import given
from hypothesis import strategies as st

from wardflow.operators import silver as s
from wardflow.sources import line_log as ll
from wardflow.sources import messages as msg
from wardflow.streaming import ingest as ing


@given(st.binary(max_size=60).map(lambda b: b.translate(bytes(b"\n\r ab"[k % 5] for k in range(256)))),
       st.integers(1, 9))
def test_ranges_of_any_size_give_every_line_once(text, size):
    whole = list(ll.lines_of(io.BytesIO(text), 0, len(text)))
    assert all(text[at : at + len(line)] == line for at, line in whole)
    assert b"".join(line for _, line in whole) == text.replace(b"\n", b"").replace(b"\r", b"")
    ends = [(a, min(a + size, len(text))) for a in range(0, len(text), size)]
    assert [x for a, b in ends for x in ll.lines_of(io.BytesIO(text), a, b)] == whole


def test_files_are_in_natural_order_and_hidden_ones_left_out(tmp_path):
    for name in ("part-99999.txt", "part-100000.txt", "_SUCCESS", ".part.crc", "sub/part-1", "_tmp/part-0"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("ab\n")
    found = ll.segments(str(tmp_path))
    assert [f.path[len(str(tmp_path)) + 1 :] for f in found] == ["part-99999.txt", "part-100000.txt", "sub/part-1"]
    assert [f.base for f in found] == [0, 3, 6]
    assert [f.base for f in ll.segments(f"file:{tmp_path}/part-9*")] == [0]
    assert ll.segments(str(tmp_path / "absent")) == []


def test_offsets_are_byte_positions_however_the_file_is_cut(spark, tmp_path):
    (tmp_path / "a").write_bytes("é1\r\n\n  \nlong line\n".encode())
    (tmp_path / "b").write_bytes(b"last \xff")
    got = []
    for size in (1, 5, 1000):
        rows = msg.read_lines(spark, str(tmp_path), "t", split_bytes=size).orderBy("offset").collect()
        got.append([(x["offset"], x["value"]) for x in rows])
        assert {(x["topic"], x["partition"]) for x in rows} == {("t", 0)}
    assert got[0] == [(0, "é1"), (9, "long line"), (19, "last �")]
    assert got[1] == got[0] and got[2] == got[0]


def test_an_empty_folder_is_an_empty_log(spark, tmp_path):
    assert msg.read_lines(spark, str(tmp_path), "t").collect() == []


def test_appends_keep_order_and_are_counted(spark, tmp_path):
    log = str(tmp_path / "log")
    for start in (0, 500):
        rows = spark.range(start, start + 500, 1, 7).selectExpr("CAST(id AS STRING) AS value")
        assert msg.append_lines(rows, log) == 500
    back = msg.read_lines(spark, log, "t", split_bytes=100).orderBy("offset").collect()
    assert [x["value"] for x in back] == [str(k) for k in range(1000)]
    broken = spark.createDataFrame([("a\nb",)], "value string")
    with pytest.raises(Exception, match="line break"):
        msg.append_lines(broken, log)
    assert msg.append_lines(spark.range(1).selectExpr("'z' AS value"), log) == 1
    assert msg.read_lines(spark, log, "t").orderBy("offset").tail(1)[0]["value"] == "z"


def test_a_stream_goes_on_where_it_stopped_and_refuses_a_changed_past(spark, settings, tmp_path):
    import json

    folder = tmp_path / "in"
    folder.mkdir()

    def drain():
        lines = msg.stream_lines(spark, str(folder), "vitals.raw")
        return ing.ingest_available(lines, settings, as_of=AS_OF).as_dict()

    (folder / "f1").write_text(json.dumps(reading(reading_id="a")) + "\n" + json.dumps(reading(spo2=1)))
    assert drain() == {"consumed": 2, "valid": 1, "rejected": 1}
    assert drain()["consumed"] == 0
    (folder / "f2").write_text(json.dumps(reading(reading_id="b")))
    assert drain() == {"consumed": 1, "valid": 1, "rejected": 0}
    rows = s.bronze_table(spark, settings).rows().orderBy("kafka_offset").collect()
    assert [x["reading_id"] for x in rows] == ["a", "b"]
    (folder / "f0").write_text(json.dumps(reading(reading_id="late")))
    with pytest.raises(Exception, match="must stay"):
        drain()
