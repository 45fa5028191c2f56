from __future__ import annotations

import pytest
from helpers import HEALTHY, SEVERE
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardflow.functions import news2
from wardflow.operators.gold import score_readings

# The published chart, as points for each closed interval of readings.
CHART = {
    "resp_rate": {3: [(0, 8), (25, 80)], 1: [(9, 11)], 0: [(12, 20)], 2: [(21, 24)]},
    "spo2": {3: [(50, 91)], 2: [(92, 93)], 1: [(94, 95)], 0: [(96, 100)]},
    "systolic_bp": {3: [(40, 90), (220, 300)], 2: [(91, 100)], 1: [(101, 110)], 0: [(111, 219)]},
    "pulse": {3: [(20, 40), (131, 260)], 2: [(111, 130)], 1: [(41, 50), (91, 110)], 0: [(51, 90)]},
    "temperature": {
        3: [(30.0, 35.0)], 1: [(35.1, 36.0), (38.1, 39.0)], 0: [(36.1, 38.0)], 2: [(39.1, 45.0)],
    },
}


@pytest.mark.parametrize("parameter", sorted(CHART))
def test_every_step_of_the_range(spark, parameter):
    """Each whole number, or tenth of a degree, against the interval that holds it."""
    steps = 10 if parameter == "temperature" else 1
    wanted = {}
    for points, intervals in CHART[parameter].items():
        for low, high in intervals:
            for k in range(round(low * steps), round(high * steps) + 1):
                assert k not in wanted
                wanted[k] = points
    assert sorted(wanted) == list(range(min(wanted), max(wanted) + 1))
    df = spark.createDataFrame([(k,) for k in wanted], "k int")
    value = F.col("k") / 10 if steps == 10 else F.col("k")
    score = getattr(news2, f"{parameter}_score")(value)
    assert {r["k"]: r["s"] for r in df.select("k", score.alias("s")).collect()} == wanted


def test_consciousness_and_oxygen(spark):
    df = spark.createDataFrame([(level,) for level in "UAXPV"], "v string")
    got = {r["v"]: r["s"] for r in df.select("v", news2.consciousness_score(F.col("v")).alias("s")).collect()}
    assert got == {level: 0 if level == "A" else 3 for level in "UAXPV"}
    flags = spark.createDataFrame([(False,), (True,)], "v boolean")
    got = [r["s"] for r in flags.select(news2.oxygen_score(F.col("v")).alias("s")).collect()]
    assert got == [0, 2]


READINGS = [
    (HEALTHY, 0, 0, "low"),
    (SEVERE, 17, 3, "high"),
    ({**HEALTHY, "heart_rate": 37}, 3, 3, "low-medium"),
    ({**HEALTHY, "heart_rate": 104, "temperature_c": 38.6, "spo2": 94, "resp_rate": 23}, 5, 2, "medium"),
    ({**SEVERE, "consciousness": "A", "on_supplemental_o2": False, "spo2": 99}, 9, 3, "high"),
]


def test_worked_readings(spark):
    for vitals, total, highest, band in READINGS:
        row = score_readings(spark.createDataFrame([vitals])).first()
        found = row["news2_total"], row["max_parameter_score"], row["risk_band"]
        assert found == (total, highest, band)
        assert sum(row[f"score_{p}"] for p in news2.PARAMETERS) == total


def test_bands_over_every_total(spark):
    """All totals with all highest scores they allow."""

    def band(total, highest):
        if total > 6:
            return "high"
        return "medium" if total > 4 else "low-medium" if highest > 2 else "low"

    cases = [(t, m, band(t, m)) for t in range(21) for m in range(4) if m <= t <= 7 * m]
    df = spark.createDataFrame(cases, ["t", "m", "want"])
    rows = df.select("want", news2.risk_band(F.col("t"), F.col("m")).alias("got")).collect()
    assert [r["got"] for r in rows] == [r["want"] for r in rows]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 3)), min_size=1, max_size=30))
def test_band_of_the_maxima_is_the_worst_band(spark, pairs):
    """So a bucket's band can be taken from its maxima without looking at each reading."""
    pairs = [(max(t, m), m) for t, m in pairs]
    order = F.lit(["low", "low-medium", "medium", "high"])
    df = spark.createDataFrame(pairs, ["t", "m"])
    each = F.array_position(order, news2.risk_band(F.col("t"), F.col("m")))
    row = df.agg(
        news2.risk_band(F.max("t"), F.max("m")).alias("bucket"), F.max(each).alias("worst")
    ).select(F.array_position(order, F.col("bucket")).alias("a"), F.col("worst").alias("b")).first()
    # the bucket may be worse when total and parameter maxima come from different readings
    assert row["a"] >= row["b"]
