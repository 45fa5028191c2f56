from __future__ import annotations

import pytest
from helpers import AS_OF, minutes, silver, silver_row

from wardflow.operators import quality as q


def table(spark, n=30, **overrides):
    """Rows a minute apart; ``overrides`` maps a row number (as ``_i``) to changed fields."""
    rows = []
    for i in range(n):
        changes = {"reading_id": f"r{i}", "recorded_at": AS_OF - minutes(i), **overrides.get(f"_{i}", {})}
        rows.append(silver_row(**changes))
    return silver(spark, rows)


def gate(df, **options):
    return q.run_silver_quality_gate(df, as_of=AS_OF, **options)


def failure(df, **options):
    with pytest.raises(q.QualityGateError) as caught:
        gate(df, **options)
    return caught.value


def test_clean_table_passes(spark):
    result = gate(table(spark))
    assert result.success and result.statistics == {
        "evaluated_expectations": 14, "successful_expectations": 14,
        "unsuccessful_expectations": 0, "success_percent": 100.0,
    }


def test_range(spark):
    error = failure(table(spark, _3={"heart_rate": 999}))
    assert str(error) == (
        "Silver quality gate failed: 1 expectation(s) not met\n"
        "  - expect_column_values_to_be_between(heart_rate): 1 unexpected"
    )
    assert error.failures[0]["partial_unexpected"] == ["999"]


def test_every_row_of_a_duplicate_group_counts(spark):
    error = failure(table(spark, _5={"reading_id": "r4"}))
    assert [(f["expectation"], f["unexpected_count"]) for f in error.failures] == [
        ("expect_column_values_to_be_unique", 2)
    ]


@pytest.mark.parametrize(
    ("change", "kind"),
    [
        ({"patient_id": "patient-2"}, "expect_column_values_to_match_regex"),
        ({"consciousness": "C"}, "expect_column_values_to_be_in_set"),
        ({"patient_id": None}, "expect_column_values_to_not_be_null"),
        ({"on_supplemental_o2": None}, "expect_column_values_to_not_be_null"),
        ({"temperature_c": 45.1}, "expect_column_values_to_be_between"),
    ],
)
def test_single_faults(spark, change, kind):
    assert [f["expectation"] for f in failure(table(spark, _2=change)).failures] == [kind]


def test_null_vitals_are_not_out_of_range(spark):
    assert gate(table(spark, _1={"spo2": None})).success


def test_stale_table(spark):
    rows = [silver_row(f"r{i}", recorded_at=AS_OF - minutes(3 * 1440)) for i in range(3)]
    error = failure(silver(spark, rows), max_age_minutes=60)
    assert error.failures[0]["expectation"] == "expect_column_max_to_be_between"
    assert error.failures[0]["unexpected_count"] == 0


def test_freshness_modes_on_mixed_ages(spark):
    one_old = table(spark, _0={"recorded_at": AS_OF - minutes(2000)})
    assert not gate(one_old, raise_on_failure=False).success
    assert gate(one_old, freshness="newest").success
    future = table(spark, _0={"recorded_at": AS_OF + minutes(60)})
    assert gate(future).success
    assert not gate(future, not_in_future=True, raise_on_failure=False).success
    with pytest.raises(ValueError):
        gate(future, freshness="other")


def test_empty_table_fails(spark):
    kinds = {f["expectation"] for f in failure(silver(spark, [])).failures}
    assert kinds == {"expect_table_row_count_to_be_between", "expect_column_max_to_be_between"}


def test_result_without_raising_is_persisted(spark, settings):
    result = gate(
        table(spark, _1={"spo2": 5}), raise_on_failure=False, results_path=settings.quality_path
    )
    assert result.success is False
    row = q.read_results(spark, settings.quality_path).first()
    assert row["success"] is False and row["statistics"]["unsuccessful_expectations"] == 1
    assert row["failures"][0]["column"] == "spo2"
    assert row["evaluated_at"] == AS_OF.replace(tzinfo=None)


def test_sample_is_bounded(spark):
    rows = [silver_row(f"r{i}", recorded_at=AS_OF, heart_rate=300 + i) for i in range(50)]
    [found] = failure(silver(spark, rows)).failures
    assert found["unexpected_count"] == 50 and len(found["partial_unexpected"]) == q.SAMPLE_VALUES
