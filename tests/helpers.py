"""Small row builders shared by the tests."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from wardflow.schemas import BRONZE, SILVER

AS_OF = datetime(2024, 2, 1, tzinfo=timezone.utc)
T0 = datetime(2024, 1, 31, 10, 0, tzinfo=timezone.utc)

HEALTHY = {
    "heart_rate": 66,
    "resp_rate": 14,
    "systolic_bp": 127,
    "spo2": 97,
    "temperature_c": 37.1,
    "consciousness": "A",
    "on_supplemental_o2": False,
}
SEVERE = {
    "heart_rate": 118,
    "resp_rate": 27,
    "systolic_bp": 94,
    "spo2": 90,
    "temperature_c": 39.9,
    "consciousness": "U",
    "on_supplemental_o2": True,
}


def reading(**changes) -> dict:
    base = {
        "reading_id": "r-1",
        "patient_id": "P100001",
        "recorded_at": "2024-01-31T10:00:00+00:00",
        **HEALTHY,
        "source_device": "dev-1",
    }
    base.update(changes)
    return {k: v for k, v in base.items() if v is not ...}


def messages(spark, values, topic="vitals.raw"):
    rows = [
        (None, v if isinstance(v, str) or v is None else json.dumps(v), topic, 0, i, T0)
        for i, v in enumerate(values)
    ]
    from wardflow.schemas import MESSAGE

    return spark.createDataFrame(rows, MESSAGE)


def bronze_row(reading_id="R1", patient_id="P100001", recorded_at=T0, ingested_at=T0, offset=0, **v):
    vitals = {**HEALTHY, **v}
    return (
        reading_id, patient_id, recorded_at, vitals["heart_rate"], vitals["resp_rate"],
        vitals["systolic_bp"], vitals["spo2"], vitals["temperature_c"], vitals["consciousness"],
        vitals["on_supplemental_o2"], "dev-1", ingested_at, 0, offset,
    )


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


def silver_row(reading_id="R1", patient_id="P100001", recorded_at=T0, **v):
    vitals = {**HEALTHY, **v}
    return (
        reading_id, patient_id, recorded_at,
        recorded_at.replace(minute=0, second=0, microsecond=0) if recorded_at else T0,
        vitals["heart_rate"], vitals["resp_rate"], vitals["systolic_bp"], vitals["spo2"],
        vitals["temperature_c"], vitals["consciousness"], vitals["on_supplemental_o2"], "dev-1",
        T0, T0,
    )


def nullable(schema):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def silver(spark, rows):
    return spark.createDataFrame(rows, nullable(SILVER))


def minutes(n: float) -> timedelta:
    return timedelta(minutes=n)
