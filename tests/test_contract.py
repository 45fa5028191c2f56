from __future__ import annotations

import json

import pytest
from helpers import AS_OF, messages, reading
from pyspark.sql import functions as F

from wardflow.operators import contract

GOOD = reading()


def errors_of(spark, values):
    out = contract.validate(messages(spark, values), AS_OF)
    return [r["errors"] for r in out.orderBy("offset").collect()]


def test_good_reading_becomes_a_bronze_row(spark):
    good, bad = contract.route(messages(spark, [GOOD]), AS_OF)
    row = good.collect()[0].asDict()
    assert bad.count() == 0
    assert row["reading_id"] == "r-1" and row["heart_rate"] == 66
    assert row["temperature_c"] == 37.1 and row["on_supplemental_o2"] is False
    assert (row["kafka_partition"], row["kafka_offset"]) == (0, 0)
    assert good.schema.fieldNames()[-3:] == ["ingested_at", "kafka_partition", "kafka_offset"]


# One fault each, by the kind of rule it breaks.
NOT_A_RECORD = {
    "{broken": "record: invalid JSON",
    "": "record: invalid JSON",
    "[]": "record: expected a JSON object, got list",
    '"lone"': "record: expected a JSON object, got str",
    "17": "record: expected a JSON object, got int",
    "-0.25": "record: expected a JSON object, got float",
    "false": "record: expected a JSON object, got bool",
    "null": "record: expected a JSON object, got NoneType",
    None: "record: expected a JSON object, got NoneType",
}
LIMITS = {
    "heart_rate": (20, 250),
    "resp_rate": (4, 60),
    "systolic_bp": (50, 260),
    "spo2": (50, 100),
    "temperature_c": (30, 45),
}
LATER = "2024-02-01T00:05:01+00:00"
MUTATIONS = [
    *[(reading(**{f: ...}), f"{f}: Field required") for f in ("systolic_bp", "recorded_at", "source_device")],
    *[
        (reading(**{f: low - 1}), f"{f}: Input should be greater than or equal to {low}")
        for f, (low, _) in LIMITS.items()
    ],
    *[
        (reading(**{f: high + 1}), f"{f}: Input should be less than or equal to {high}")
        for f, (_, high) in LIMITS.items()
    ],
    (
        reading(resp_rate="rapid"),
        "resp_rate: Input should be a valid integer, unable to parse string as an integer",
    ),
    (reading(consciousness="drowsy"), "consciousness: Input should be 'A', 'V', 'P' or 'U'"),
    (reading(patient_id="P12345"), r"patient_id: String should match pattern '^P\d{6}$'"),
    (reading(reading_id=" "), "reading_id: String should have at least 1 character"),
    (reading(bed="7b"), "bed: Extra inputs are not permitted"),
    (reading(recorded_at=LATER), f"recorded_at: Value error, recorded_at {LATER} is in the future"),
    *NOT_A_RECORD.items(),
]


def test_each_fault_names_its_reason(spark):
    found = errors_of(spark, [value for value, _ in MUTATIONS])
    assert found == [[reason] for _, reason in MUTATIONS]


def test_structurally_broken_record_lists_all_fields_then_the_unknown_one(spark):
    [got] = errors_of(spark, [{"payload": ["x"]}])
    assert got == [f"{f}: Field required" for f in contract.FIELDS] + [
        "payload: Extra inputs are not permitted"
    ]


def test_all_reasons_are_collected_in_field_order_and_unknown_fields_in_input_order(spark):
    value = {"zeta": 1, **reading(spo2=200, heart_rate=1), "alpha": 2}
    assert errors_of(spark, [value]) == [
        [
            "heart_rate: Input should be greater than or equal to 20",
            "spo2: Input should be less than or equal to 100",
            "zeta: Extra inputs are not permitted",
            "alpha: Extra inputs are not permitted",
        ]
    ]


INT = "Input should be a valid integer"
INT_TEXT = f"{INT}, unable to parse string as an integer"
# JSON text of heart_rate -> stored value, or reason
INTEGERS = [
    ("78", 78), ("78.0", 78), ("1e2", 100), ('"78"', 78), ('" 78 "', 78), ('"78.0"', 78),
    ('"+78"', 78), ('"1_00"', 100), ('"078"', 78), ('"78.00"', 78),
    ("78.5", f"{INT}, got a number with a fractional part"),
    ('"78.5"', INT_TEXT), ('"78."', INT_TEXT), ('""', INT_TEXT), ('"1__0"', INT_TEXT),
    ('"0x10"', INT_TEXT), ('"1e2"', INT_TEXT),
    ("null", INT), ("[1]", INT), ('{"a": 1}', INT),
    ("true", "Input should be greater than or equal to 20"),
    ("99999999999999999999999", "Input should be less than or equal to 250"),
    ("1e20", "Unable to parse input string as an integer, exceeded maximum size"),
]
NUM_TEXT = "Input should be a valid number, unable to parse string as a number"
FLOATS = [
    ("30", 30.0), ("36.8", 36.8), ('"36.8"', 36.8), ('" 36.8 "', 36.8), ('"3.65e1"', 36.5),
    ('"36."', 36.0), ('"3_6.8"', 36.8), ('"+36"', 36.0),
    ('"abc"', NUM_TEXT), ('""', NUM_TEXT), ('"36f"', NUM_TEXT), ('"36d"', NUM_TEXT),
    ("null", "Input should be a valid number"), ("{}", "Input should be a valid number"),
    ("true", "Input should be greater than or equal to 30"),
    ('"inf"', "Input should be less than or equal to 45"),
    ('"nan"', "Input should be less than or equal to 45"),
    ('"-inf"', "Input should be greater than or equal to 30"),
]
BOOL_TEXT = "Input should be a valid boolean, unable to interpret input"
BOOLS = [
    ("true", True), ("false", False), ("0", False), ("1", True), ("1.0", True), ('"yes"', True),
    ('"ON"', True), ('"t"', True), ('"1"', True), ('"Off"', False), ('"n"', False),
    ("2", BOOL_TEXT), ('"maybe"', BOOL_TEXT), ('"Y "', BOOL_TEXT), ('""', BOOL_TEXT),
    ("0.5", "Input should be a valid boolean"), ("null", "Input should be a valid boolean"),
    ("[]", "Input should be a valid boolean"),
]
DT = "Input should be a valid datetime"
EXTRA_CHARS = f"{DT} or date, unexpected extra characters at the end of the input"
INSTANTS = [
    ('"2024-01-01T00:00:00+00:00"', "2024-01-01 00:00:00"),
    ('"2024-01-01T00:00:00Z"', "2024-01-01 00:00:00"),
    ('"2024-01-01t00:00:00z"', "2024-01-01 00:00:00"),
    ('"2024-01-01 00:00"', "2024-01-01 00:00:00"),
    ('"2024-01-01_00:00:00"', "2024-01-01 00:00:00"),
    ('"2024-01-01"', "2024-01-01 00:00:00"),
    ('"2024-01-01T00:00:00.123456789"', "2024-01-01 00:00:00.123456"),
    ('"2024-01-01T00:00:00,5"', "2024-01-01 00:00:00.5"),
    ('"2024-01-01T00:00:00.1234567+05:30"', "2023-12-31 18:30:00.123456"),
    ('"2024-01-01T00:00:00-0530"', "2024-01-01 05:30:00"),
    ('"2024-01-01T00:00:00+23:59"', "2023-12-31 00:01:00"),
    ('"1704067200"', "2024-01-01 00:00:00"),
    ('"1704067200000"', "2024-01-01 00:00:00"),
    ("1704067200", "2024-01-01 00:00:00"),
    ("1704067200.5", "2024-01-01 00:00:00.5"),
    ("-5", "1969-12-31 23:59:55"),
    ('"bad"', f"{DT} or date, input is too short"),
    ('""', f"{DT} or date, input is too short"),
    ('"2024-13-01"', f"{DT} or date, month value is outside expected range of 1-12"),
    ('"2024-02-30"', f"{DT} or date, day value is outside expected range"),
    ('"2024-01-01T24:00:00"', EXTRA_CHARS),
    ('"2024-01-01T00:00:60"', EXTRA_CHARS),
    ('"2024-01-01T00"', EXTRA_CHARS),
    ('"2024-01-01T00:00:00+05"', EXTRA_CHARS),
    ('"2024-01-01T00:00:00+24:00"', EXTRA_CHARS),
    ('" 2024-01-01T00:00:00 "', f"{DT} or date, invalid character in year"),
    ("true", DT), ("null", DT), ("[1]", DT),
]
STRINGS = [
    ('" a "', "a"), ('"\\u00a0a\\u00a0"', "a"),
    ('" "', "String should have at least 1 character"),
    (json.dumps("a" * 101), "String should have at most 100 characters"),
    ("5", "Input should be a valid string"), ("null", "Input should be a valid string"),
]
LEVELS = [
    ('"U"', "U"), ('" A"', contract.NOT_LEVEL), ('"a"', contract.NOT_LEVEL),
    ('""', contract.NOT_LEVEL), ("1", contract.NOT_LEVEL), ("null", contract.NOT_LEVEL),
]
PATIENTS = [
    ('" P123456"', "P123456"), ('"P123456\\n"', "P123456"),
    ('"P1234567"', r"String should match pattern '^P\d{6}$'"),
    ('"\\u0050\\u0661\\u0662\\u0663\\u0664\\u0665\\u0666"', "P١٢٣٤٥٦"),
]


@pytest.mark.parametrize(
    ("field", "cases"),
    [
        ("heart_rate", INTEGERS),
        ("temperature_c", FLOATS),
        ("on_supplemental_o2", BOOLS),
        ("recorded_at", INSTANTS),
        ("source_device", STRINGS),
        ("consciousness", LEVELS),
        ("patient_id", PATIENTS),
    ],
)
def test_coercion(spark, field, cases):
    def with_text(text):
        body = json.dumps(reading(**{field: "@@"}))
        return body.replace('"@@"', text)

    out = contract.validate(messages(spark, [with_text(t) for t, _ in cases]), AS_OF)
    value = F.col(field).cast("string") if field == "recorded_at" else F.col(field)
    rows = out.orderBy("offset").select(value.alias("v"), "errors").collect()
    reasons_of_field = {f"{field}: {want}" for _, want in cases if isinstance(want, str)}
    for (text, want), row in zip(cases, rows):
        if f"{field}: {want}" in reasons_of_field and row["errors"]:
            assert row["errors"] == [f"{field}: {want}"], text
        else:
            assert row["errors"] == [] and row["v"] == want, (text, row)


def test_a_repeated_key_keeps_its_last_value(spark):
    body = json.dumps(GOOD)[:-1] + ', "heart_rate": 99}'
    good, _ = contract.route(messages(spark, [body]), AS_OF)
    assert good.first()["heart_rate"] == 99


def test_skew_of_five_minutes_is_allowed(spark):
    values = [reading(recorded_at=f"2024-02-01T00:0{m}:00Z") for m in (5, 6)]
    assert [len(e) for e in errors_of(spark, values)] == [0, 1]


def test_missing_differs_from_null(spark):
    got = errors_of(spark, [reading(spo2=...), reading(spo2=None)])
    assert got == [["spo2: Field required"], ["spo2: Input should be a valid integer"]]


def test_deadletter_keeps_the_exact_text_and_the_source(spark):
    text = '{"b":1,  "a":2.50}'
    _, bad = contract.route(messages(spark, [GOOD, text]), AS_OF)
    row = bad.first()
    assert row["raw"] == text
    assert row["rejected_at"] == "2024-02-01T00:00:00+00:00"
    assert row["source"].asDict() == {"topic": "vitals.raw", "partition": 0, "offset": 1}
    payload = json.loads(contract.deadletter_payload(bad).first()["value"])
    assert list(payload) == ["raw", "errors", "rejected_at", "source"]
    assert payload["raw"] == {"a": 2.5, "b": 1}


def test_broken_json_is_a_text_in_the_payload(spark):
    _, bad = contract.route(messages(spark, ["{oops"]), AS_OF)
    payload = json.loads(contract.deadletter_payload(bad).first()["value"])
    assert payload["raw"] == "{oops" and payload["errors"] == ["record: invalid JSON"]


def test_stats_and_profile(spark):
    values = [GOOD, reading(spo2=3), reading(spo2=300, heart_rate=1), {"payload": 1}]
    validated = contract.validate(messages(spark, values), AS_OF)
    assert contract.ingest_stats(validated).first().asDict() == {
        "consumed": 4,
        "valid": 1,
        "rejected": 3,
    }
    bad = contract.deadletter_rows(validated, AS_OF)
    profile = {r["field"]: (r["reasons"], r["first_reasons"]) for r in contract.rejection_profile(bad).collect()}
    assert profile["spo2"] == (3, 1) and profile["heart_rate"] == (2, 1)
    assert profile["payload"] == (1, 0) and profile["reading_id"] == (1, 1)
    samples = {r["field"]: r for r in contract.first_reason_samples(bad).collect()}
    assert set(samples) == {"spo2", "heart_rate", "reading_id"}
    assert samples["spo2"]["sample_offset"] == 1
