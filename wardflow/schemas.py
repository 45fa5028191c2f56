"""Fixed table schemas and their strict enforcement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaError(ValueError):
    """A DataFrame does not have exactly the columns and types its table prescribes."""


def _schema(nullable: bool, **columns: T.DataType | str) -> T.StructType:
    out = T.StructType()
    for name, kind in columns.items():
        out.add(name, kind, nullable)
    return out


_READING = {
    "reading_id": "string",
    "patient_id": "string",
    "recorded_at": "timestamp",
    "heart_rate": "integer",
    "resp_rate": "integer",
    "systolic_bp": "integer",
    "spo2": "integer",
    "temperature_c": "double",
    "consciousness": "string",
    "on_supplemental_o2": "boolean",
    "source_device": "string",
}

READING = _schema(False, **_READING)

BRONZE = _schema(
    False, **_READING, ingested_at="timestamp", kafka_partition="integer", kafka_offset="long"
)

SILVER = _schema(
    False,
    reading_id="string",
    patient_id="string",
    recorded_at="timestamp",
    recorded_hour="timestamp",
    heart_rate="integer",
    resp_rate="integer",
    systolic_bp="integer",
    spo2="integer",
    temperature_c="double",
    consciousness="string",
    on_supplemental_o2="boolean",
    source_device="string",
    ingested_at="timestamp",
    updated_at="timestamp",
)

GOLD = _schema(
    False,
    patient_id="string",
    window_start="timestamp",
    readings_in_window="integer",
    mean_news2="double",
    max_news2="integer",
    max_single_parameter_score="integer",
    worst_risk_band="string",
    pct_readings_on_oxygen="double",
    mean_heart_rate="double",
    min_spo2="integer",
    max_resp_rate="integer",
    min_systolic_bp="integer",
    max_temperature_c="double",
    first_reading_at="timestamp",
    last_reading_at="timestamp",
    computed_at="timestamp",
)

_POSITION = _schema(True, topic="string", partition="integer", offset="long")
DEADLETTER = _schema(
    True,
    raw="string",
    errors=T.ArrayType(T.StringType()),
    rejected_at="string",
    source=_POSITION,
)

MESSAGE = _schema(
    True,
    key="string",
    value="string",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
)

CHUNK = _schema(
    False,
    chunk_id="string",
    doc_id="string",
    title="string",
    source="string",
    topic="string",
    heading="string",
    ordinal="integer",
    text="string",
)

INDEX = T.StructType(
    [
        T.StructField("point_id", T.StringType(), False),
        *CHUNK.fields,
        T.StructField("embedding", T.ArrayType(T.FloatType()), False),
    ]
)

_NAMED = _schema(True, namespace="string", name="string")
_RUN_FACETS = _schema(
    True,
    parent=_schema(True, run=_schema(True, runId="string"), job=_NAMED),
    errorMessage=_schema(True, message="string", programmingLanguage="string", stackTrace="string"),
    outputStatistics=T.MapType(T.StringType(), T.LongType()),
)
LINEAGE_EVENT = _schema(
    True,
    eventTime="string",
    eventType="string",
    producer="string",
    schemaURL="string",
    run=_schema(True, runId="string", facets=_RUN_FACETS),
    job=_NAMED,
    inputs=T.ArrayType(_NAMED),
    outputs=T.ArrayType(_NAMED),
)

QUALITY_RESULT = _schema(
    True,
    evaluated_at="timestamp",
    success="boolean",
    statistics=_schema(
        True,
        evaluated_expectations="integer",
        successful_expectations="integer",
        unsuccessful_expectations="integer",
        success_percent="double",
    ),
    failures=T.ArrayType(
        _schema(
            True,
            expectation="string",
            column="string",
            unexpected_count="long",
            partial_unexpected=T.ArrayType(T.StringType()),
        )
    ),
)


def _required(name: str) -> Column:
    """The column, or a task failure naming it where a value is missing."""
    message = F.lit(f"null value in required column {name}")
    return F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.col(name))


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the order of ``schema``; refuses extra, missing or wrongly typed columns.

    Types are checked on the plan, so a bad write fails before any job starts.  A null in a
    required column fails the write itself.  (A plain parquet append checks neither, and
    ``DataFrame.to`` drops extra columns without a word.)
    """
    # by their text, which leaves out whether parts of a nested type may be null
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in schema.fields}
    problems = [f"unexpected column {c}" for c in have if c not in want]
    problems += [f"missing column {c}" for c in want if c not in have]
    problems += [
        f"column {c} is {have[c]}, expected {t}"
        for c, t in want.items()
        if c in have and have[c] != t
    ]
    if problems:
        raise SchemaError("; ".join(problems))
    nullable = {f.name: f.nullable for f in df.schema.fields}
    return df.select(
        *[
            F.col(f.name) if f.nullable or not nullable[f.name] else _required(f.name).alias(f.name)
            for f in schema.fields
        ]
    )
