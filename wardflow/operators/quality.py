"""Declarative quality gate over Silver."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.functions.times import age_minutes, instant
from wardflow.operators.contract import CONSCIOUSNESS_LEVELS, PATIENT_PATTERN, RANGES
from wardflow.schemas import QUALITY_RESULT

DEFAULT_MAX_AGE_MINUTES = 24 * 60
SAMPLE_VALUES = 20


@dataclass(frozen=True)
class Expectation:
    """One check.  ``bad`` marks unexpected rows; table-level kinds leave it unset."""

    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    pattern: str | None = None
    allowed: tuple[str, ...] = ()

    @property
    def bad(self) -> Column | None:
        """Row predicate.  Nulls are only unexpected to the not-null check."""
        value = F.col(self.column) if self.column else None
        if self.kind == "expect_column_values_to_not_be_null":
            return value.isNull()
        if self.kind == "expect_column_values_to_match_regex":
            return ~value.rlike(self.pattern)
        if self.kind == "expect_column_values_to_be_between":
            return ~value.between(self.low, self.high)
        if self.kind == "expect_column_values_to_be_in_set":
            return ~value.isin(*self.allowed)
        return None


def row_count_between(low: float | None = None, high: float | None = None) -> Expectation:
    return Expectation("expect_table_row_count_to_be_between", None, low, high)


def not_null(column: str) -> Expectation:
    return Expectation("expect_column_values_to_not_be_null", column)


def unique(column: str) -> Expectation:
    return Expectation("expect_column_values_to_be_unique", column)


def match_regex(column: str, pattern: str) -> Expectation:
    return Expectation("expect_column_values_to_match_regex", column, pattern=pattern)


def between(column: str, low: float, high: float) -> Expectation:
    return Expectation("expect_column_values_to_be_between", column, low, high)


def in_set(column: str, allowed: tuple[str, ...]) -> Expectation:
    return Expectation("expect_column_values_to_be_in_set", column, allowed=tuple(allowed))


def column_max_between(column: str, low: float | None, high: float | None) -> Expectation:
    return Expectation("expect_column_max_to_be_between", column, low, high)


def column_min_between(column: str, low: float | None, high: float | None) -> Expectation:
    return Expectation("expect_column_min_to_be_between", column, low, high)


def silver_suite(
    max_age_minutes: int = DEFAULT_MAX_AGE_MINUTES,
    freshness: str = "oldest",
    not_in_future: bool = False,
) -> list[Expectation]:
    """The 14 expectations on Silver.

    ``freshness="oldest"`` bounds the age of the oldest reading; ``"newest"`` only that of
    the newest, so history in the table does not fail it.  ``not_in_future`` adds a check
    that no reading at all lies in the future.
    """
    if freshness not in ("oldest", "newest"):
        raise ValueError(f"unknown freshness {freshness!r}")
    bound = column_max_between if freshness == "oldest" else column_min_between
    suite = [
        row_count_between(low=1),
        not_null("reading_id"),
        unique("reading_id"),
        not_null("patient_id"),
        match_regex("patient_id", PATIENT_PATTERN),
        not_null("recorded_at"),
        not_null("on_supplemental_o2"),
        *[between(name, low, high) for name, (low, high) in RANGES.items()],
        in_set("consciousness", CONSCIOUSNESS_LEVELS),
        bound("age_minutes", 0, max_age_minutes),
    ]
    if not_in_future:
        suite.append(column_min_between("age_minutes", 0, None))
    return suite


@dataclass(frozen=True)
class GateResult:
    success: bool
    statistics: dict
    failures: list[dict] = field(default_factory=list)


class QualityGateError(RuntimeError):
    """One or more expectations failed."""

    def __init__(self, failures: list[dict]):
        self.failures = failures
        lines = [f"Silver quality gate failed: {len(failures)} expectation(s) not met"]
        for f in failures:
            where = f["column"] or ""
            lines.append(f"  - {f['expectation']}({where}): {f['unexpected_count']} unexpected")
        super().__init__("\n".join(lines))


def with_age(silver: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    return silver.withColumn("age_minutes", age_minutes(F.col("recorded_at"), instant(as_of)))


def _single_pass(suite: list[Expectation]) -> list[Column]:
    """One aggregate per expectation but uniqueness; all run in the same scan."""
    out = []
    for i, e in enumerate(suite):
        if e.kind == "expect_table_row_count_to_be_between":
            measure = F.count(F.lit(1))
        elif e.kind == "expect_column_max_to_be_between":
            measure = F.max(e.column)
        elif e.kind == "expect_column_min_to_be_between":
            measure = F.min(e.column)
        elif e.bad is not None:
            measure = F.count_if(e.bad)
        else:
            continue
        out.append(measure.cast("double").alias(f"m{i}"))
    return out


def duplicate_rows(df: DataFrame, column: str) -> DataFrame:
    """One row: how many rows share their (non-null) value with another row."""
    per_value = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per_value.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n"))


def expectation_measures(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """One row ``m0, m1, ...`` with each expectation's measure, from one pass over the rows.

    Uniqueness needs its own shuffle and comes in as a scalar subquery.
    """
    base = df.agg(*_single_pass(suite))
    for i, e in enumerate(suite):
        if e.kind == "expect_column_values_to_be_unique":
            duplicates = duplicate_rows(df, e.column).scalar()
            base = base.withColumn(f"m{i}", duplicates.cast("double"))
    return base.select(*[f"m{i}" for i in range(len(suite))])


_TABLE_KINDS = (
    "expect_table_row_count_to_be_between",
    "expect_column_max_to_be_between",
    "expect_column_min_to_be_between",
)


def _success(i: int, e: Expectation) -> Column:
    value = F.col(f"m{i}")
    if e.kind not in _TABLE_KINDS:
        return value == 0
    ok = F.lit(True)
    if e.low is not None:
        ok = ok & (value >= e.low)
    if e.high is not None:
        ok = ok & (value <= e.high)
    return F.coalesce(ok, F.lit(False))  # no value at all is not within any bounds


def suite_results(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """One row per expectation: position, kind, column, success, unexpected rows.

    Table-level kinds have no unexpected rows and report 0.
    """
    return results_of(expectation_measures(df, suite), suite)


def results_of(measures: DataFrame, suite: list[Expectation]) -> DataFrame:
    """The same rows from the one row of measures."""
    results = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(e.kind).alias("expectation"),
            F.lit(e.column).cast("string").alias("column"),
            _success(i, e).alias("success"),
            (F.lit(0.0) if e.kind in _TABLE_KINDS else F.col(f"m{i}"))
            .cast("bigint")
            .alias("unexpected_count"),
        )
        for i, e in enumerate(suite)
    ]
    return measures.select(F.inline(F.array(*results)))


def failure_samples(df: DataFrame, suite: list[Expectation], failed: list[int]) -> DataFrame:
    """``position, rank, value``: up to 20 unexpected values of each failed expectation.

    ``failed`` lists positions in the suite, from 1.  The values come in the order of their
    texts, so every run shows the same ones, and one pass finds those of all expectations but
    uniqueness, which needs the counts of its column.
    """
    parts = []
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.col(e.column).cast("string").alias("value"),
            F.coalesce(e.bad, F.lit(False)).alias("bad"),
        )
        for i, e in enumerate(suite, 1)
        if i in failed and e.bad is not None
    ]
    if rows:
        parts.append(df.select(F.inline(F.array(*rows))).filter("bad").drop("bad"))
    for i, e in enumerate(suite, 1):
        if i in failed and e.kind == "expect_column_values_to_be_unique":
            known = df.filter(F.col(e.column).isNotNull())
            repeated = known.groupBy(e.column).count().filter("count > 1")
            parts.append(
                repeated.select(F.lit(i).alias("position"), F.col(e.column).cast("string").alias("value"))
            )
    if not parts:
        return df.sparkSession.createDataFrame([], "position int, rank int, value string")
    order = Window.partitionBy("position").orderBy("value")
    ranked = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= SAMPLE_VALUES).select("position", "rank", "value")


def run_silver_quality_gate(
    silver: DataFrame,
    *,
    max_age_minutes: int = DEFAULT_MAX_AGE_MINUTES,
    raise_on_failure: bool = True,
    freshness: str = "oldest",
    not_in_future: bool = False,
    as_of: datetime | str | None = None,
    results_path: str | None = None,
) -> GateResult:
    """Check Silver; raise ``QualityGateError`` with every failure, or return the result."""
    suite = silver_suite(max_age_minutes, freshness, not_in_future)
    return conclude(
        suite_results(with_age(silver, as_of), suite),
        suite,
        lambda failed: silver,
        raise_on_failure=raise_on_failure,
        as_of=as_of,
        results_path=results_path,
    )


def conclude(
    results: DataFrame,
    suite: list[Expectation],
    failing_rows: Callable[[list[int]], DataFrame],
    *,
    raise_on_failure: bool = True,
    as_of: datetime | str | None = None,
    results_path: str | None = None,
) -> GateResult:
    """The gate's verdict on a suite's results: stored if asked for, raised if it failed.

    ``failing_rows`` gives rows that hold all unexpected values at the given positions.
    """
    # One row per expectation, so this collect has the size of the suite.
    outcomes = sorted(results.collect(), key=lambda r: r["position"])
    failed = [r["position"] for r in outcomes if not r["success"]]
    samples: dict[int, list[str]] = {}
    if failed:  # at most 20 values for each
        aged = with_age(failing_rows(failed), as_of)
        for row in failure_samples(aged, suite, failed).orderBy("position", "rank").collect():
            samples.setdefault(row["position"], []).append(str(row["value"]))
    failures = [
        {
            "expectation": r["expectation"],
            "column": r["column"],
            "unexpected_count": r["unexpected_count"],
            "partial_unexpected": samples.get(r["position"], []),
        }
        for r in outcomes
        if not r["success"]
    ]
    met = len(outcomes) - len(failures)
    statistics = {
        "evaluated_expectations": len(outcomes),
        "successful_expectations": met,
        "unsuccessful_expectations": len(failures),
        "success_percent": 100.0 * met / len(outcomes),
    }
    result = GateResult(not failures, statistics, failures)
    if results_path:
        persist_result(results.sparkSession, result, results_path, as_of)
    if failures and raise_on_failure:
        raise QualityGateError(failures)
    return result


def persist_result(
    spark: SparkSession, result: GateResult, path: str, as_of: datetime | str | None = None
) -> None:
    """Append one row per gate run."""
    row = (None, result.success, result.statistics, result.failures)
    (
        spark.createDataFrame([row], QUALITY_RESULT)
        .withColumn("evaluated_at", instant(as_of))
        .coalesce(1)
        .write.mode("append")
        .json(path)
    )


def read_results(spark, path: str) -> DataFrame:
    return spark.read.schema(QUALITY_RESULT).json(path)
