"""NEWS2 early-warning score as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published NEWS2 chart (SpO2 scale 1).  Each entry is (highest reading
# of the band, points); the last number is the score above the highest band.
RESP_RATE_BANDS = ([(8, 3), (11, 1), (20, 0), (24, 2)], 3)
SYSTOLIC_BANDS = ([(90, 3), (100, 2), (110, 1), (219, 0)], 3)
PULSE_BANDS = ([(40, 3), (50, 1), (90, 0), (110, 1), (130, 2)], 3)
TEMPERATURE_BANDS = ([(35.0, 3), (36.0, 1), (38.0, 0), (39.0, 1)], 2)
SPO2_FLOORS = ([(96, 0), (94, 1), (92, 2)], 3)  # (lowest reading of the band, points)
OXYGEN_POINTS = 2
NOT_ALERT_POINTS = 3

PARAMETERS = (
    "resp_rate",
    "spo2",
    "oxygen",
    "systolic_bp",
    "pulse",
    "consciousness",
    "temperature",
)


def _banded(value: Column, bands: tuple[list[tuple[float, int]], int]) -> Column:
    steps, above = bands
    (top, points), *rest = steps
    out = F.when(value <= top, points)
    for top, points in rest:
        out = out.when(value <= top, points)
    return out.otherwise(above)


def resp_rate_score(value: Column) -> Column:
    return _banded(value, RESP_RATE_BANDS)


def spo2_score(value: Column) -> Column:
    (floor, points), *rest = SPO2_FLOORS[0]
    out = F.when(value >= floor, points)
    for floor, points in rest:
        out = out.when(value >= floor, points)
    return out.otherwise(SPO2_FLOORS[1])


def oxygen_score(on_oxygen: Column) -> Column:
    return F.when(on_oxygen, OXYGEN_POINTS).otherwise(0)


def systolic_bp_score(value: Column) -> Column:
    return _banded(value, SYSTOLIC_BANDS)


def pulse_score(value: Column) -> Column:
    return _banded(value, PULSE_BANDS)


def consciousness_score(value: Column) -> Column:
    return F.when(value == "A", 0).otherwise(NOT_ALERT_POINTS)


def temperature_score(value: Column) -> Column:
    return _banded(value, TEMPERATURE_BANDS)


def subscores() -> dict[str, Column]:
    """The seven parameter scores over the columns of a reading."""
    return {
        "resp_rate": resp_rate_score(F.col("resp_rate")),
        "spo2": spo2_score(F.col("spo2")),
        "oxygen": oxygen_score(F.col("on_supplemental_o2")),
        "systolic_bp": systolic_bp_score(F.col("systolic_bp")),
        "pulse": pulse_score(F.col("heart_rate")),
        "consciousness": consciousness_score(F.col("consciousness")),
        "temperature": temperature_score(F.col("temperature_c")),
    }


def total_score() -> Column:
    first, *rest = subscores().values()
    total = first
    for part in rest:
        total = total + part
    return total


def max_parameter_score() -> Column:
    return F.greatest(*subscores().values())


def risk_band(total: Column, max_parameter: Column) -> Column:
    """high from 7, medium from 5, low-medium for a single parameter at 3, else low."""
    return (
        F.when(total >= 7, "high")
        .when(total >= 5, "medium")
        .when(max_parameter == 3, "low-medium")
        .otherwise("low")
    )
