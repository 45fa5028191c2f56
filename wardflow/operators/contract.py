"""Data contract over raw JSON messages: coercion, every rejection reason, routing.

A message is parsed once into a VARIANT; each rule is a column expression, so a batch of any
size is one narrow (shuffle-free) projection and no Python runs per row.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions import coerce
from wardflow.functions.times import instant, iso_utc
from wardflow.schemas import READING

# The contract.
FIELDS = tuple(READING.fieldNames())
PATIENT_PATTERN = r"^P\d{6}$"
CONSCIOUSNESS_LEVELS = ("A", "V", "P", "U")
RANGES = {
    "heart_rate": (20, 250),
    "resp_rate": (4, 60),
    "systolic_bp": (50, 260),
    "spo2": (50, 100),
    "temperature_c": (30, 45),
}
LENGTHS = {"reading_id": (1, None), "source_device": (1, 100)}
FUTURE_SKEW_MINUTES = 5

# Reason texts not tied to one type.
MISSING = "Field required"
EXTRA = "Extra inputs are not permitted"
NOT_LEVEL = "Input should be 'A', 'V', 'P' or 'U'"
INVALID_JSON = "record: invalid JSON"
NOT_OBJECT = "record: expected a JSON object, got "

def _range_reason(value: Column, bounds: tuple[int, int]) -> Column:
    low, high = bounds
    return F.when(value < low, f"Input should be greater than or equal to {low}").when(
        value > high, f"Input should be less than or equal to {high}"
    )


def _length_reason(value: Column, bounds: tuple[int, int | None]) -> Column:
    low, high = bounds
    reason = F.when(
        F.length(value) < low, f"String should have at least {low} character"
    )
    if high is not None:
        reason = reason.when(
            F.length(value) > high, f"String should have at most {high} characters"
        )
    return reason


def _value(name: str, kind: Column, text: Column) -> Column:
    """The coerced value, before range and length checks."""
    if name == "recorded_at":
        return coerce.to_instant(kind, text)
    if name == "consciousness":
        return F.when((kind == "STRING") & text.isin(*CONSCIOUSNESS_LEVELS), text)
    if name == "on_supplemental_o2":
        return coerce.to_bool(kind, text)
    if name == "temperature_c":
        return coerce.to_float(kind, text)
    if name in RANGES:
        return coerce.to_int(kind, text)
    return coerce.to_string(kind, text)


def _reason(name: str, kind: Column, text: Column, value: Column, as_of: Column) -> Column:
    """Why a present field is refused, or null."""
    if name == "recorded_at":
        latest = as_of + F.make_dt_interval(mins=F.lit(FUTURE_SKEW_MINUTES))
        shown = coerce.shown_instant(text, value)
        future = F.concat(F.lit("Value error, recorded_at "), shown, F.lit(" is in the future"))
        return F.coalesce(
            coerce.instant_reason(kind, text, value), F.when(value > latest, future)
        )
    if name == "consciousness":
        return F.when(value.isNull(), NOT_LEVEL)
    if name == "on_supplemental_o2":
        return coerce.bool_reason(kind, text, value)
    if name == "temperature_c":
        found = coerce.float_reason(kind, text, value)
        return F.coalesce(found, _range_reason(value, RANGES[name]))
    if name in RANGES:
        found = coerce.int_reason(kind, text, value)
        return F.coalesce(found, _range_reason(value, RANGES[name]))
    if name == "patient_id":
        bad = ~value.rlike(f"(?U){PATIENT_PATTERN}")
        further = F.when(bad, f"String should match pattern '{PATIENT_PATTERN}'")
    else:
        further = _length_reason(value, LENGTHS[name])
    return F.coalesce(coerce.string_reason(kind, text, value), further)


def _record_reason() -> Column:
    """Why the message is not a JSON object at all, or null if it is one."""
    kind = F.expr("schema_of_variant(_doc)")
    python_name = (
        F.when(kind.startswith("ARRAY"), "list")
        .when(kind == "STRING", "str")
        .when(kind == "BOOLEAN", "bool")
        .when(kind == "VOID", "NoneType")
        .when(kind == "BIGINT", "int")
        .when(kind.endswith(",0)") & ~F.col("value").contains("."), "int")
        .otherwise("float")
    )
    return (
        F.when(F.col("value").isNull(), f"{NOT_OBJECT}NoneType")
        .when(F.col("_doc").isNull(), INVALID_JSON)
        .when(F.col("_others").isNull(), F.concat(F.lit(NOT_OBJECT), python_name))
    )


def decode(messages: DataFrame) -> DataFrame:
    """Adds the parsed message, its unknown fields, and kind and text of every contract field.

    The text is parsed once, into a VARIANT, which tells "78" from 78, and the fields are taken out of
    that once, into a map.  A VARIANT sorts its keys, so only a message with two unknown fields or more
    is looked at again for their input order, which decides the order of its reasons.
    """
    known = F.lit(list(FIELDS))
    parsed = messages.withColumn("_doc", F.expr("try_parse_json(value)"))
    in_order = F.array_except(F.expr("array_distinct(json_object_keys(value))"), known)
    return (
        parsed.withColumn("_fields", F.expr("try_variant_get(_doc, '$', 'map<string,variant>')"))
        .withColumns({f"_field_{name}": F.try_element_at("_fields", F.lit(name)) for name in FIELDS})
        .withColumn("_others", F.array_except(F.map_keys("_fields"), known))
        .withColumn("_unknown", F.when(F.size("_others") > 1, in_order).otherwise(F.col("_others")))
        .withColumns(
            {
                f"_{part}_{name}": F.expr(expression.format(f"_field_{name}"))
                for name in FIELDS
                for part, expression in (
                    ("kind", "schema_of_variant({})"),
                    ("text", "try_variant_get({}, '$', 'string')"),
                )
            }
        )
        .drop("_fields", *[f"_field_{name}" for name in FIELDS])
    )


def validate(messages: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """``messages`` plus the typed contract fields and ``errors ARRAY<STRING>``.

    ``errors`` lists every broken rule as ``field: reason``, in declared field order, then
    unknown fields in input order; it is empty for a valid message.
    """
    now = instant(as_of)
    # One projection per step: each refers to the columns of the one before by name, so no
    # expression is repeated inside another.
    decoded = decode(messages)
    fields = {n: (F.col(f"_kind_{n}"), F.col(f"_text_{n}")) for n in FIELDS}
    coerced = decoded.withColumns({f"_value_{n}": _value(n, *f) for n, f in fields.items()})
    reasons = []
    for n, f in fields.items():
        reason = _reason(n, *f, F.col(f"_value_{n}"), now)
        # A field set to JSON null has a kind, a missing one has none.
        reasons.append(
            F.when(f[0].isNull(), f"{n}: {MISSING}").otherwise(F.concat(F.lit(f"{n}: "), reason))
        )
    unknown = F.transform("_unknown", lambda key: F.concat(key, F.lit(f": {EXTRA}")))
    # Dropping nulls with array_except keeps the rules in generated code; array_compact is a
    # lambda function, and everything inside one is interpreted.
    nothing = F.array(F.lit(None).cast("string"))
    broken = F.concat(F.array_except(F.array(*reasons), nothing), unknown)
    judged = coerced.withColumns({"_broken": broken, "_record": _record_reason()})
    errors = F.when(F.col("_record").isNotNull(), F.array("_record")).otherwise(F.col("_broken"))
    # An out-of-range number is already refused; try_cast keeps it from failing the job.
    typed = [F.col(f"_value_{f.name}").try_cast(f.dataType).alias(f.name) for f in READING.fields]
    result = F.struct(*typed, errors.alias("errors"))
    # A one-element inline: filters on ``errors`` stay above it.  Pushed below, the optimizer
    # would copy every rule into the filter and evaluate it again.
    return judged.select(*messages.columns, F.inline(F.array(result)))


def bronze_rows(validated: DataFrame, ingested_at: datetime | str | Column | None = None) -> DataFrame:
    """Valid messages as Bronze rows."""
    stamp = ingested_at if isinstance(ingested_at, Column) else instant(ingested_at)
    return validated.filter(F.size("errors") == 0).select(
        *FIELDS,
        stamp.alias("ingested_at"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
    )


def deadletter_rows(
    validated: DataFrame, rejected_at: datetime | str | Column | None = None
) -> DataFrame:
    """Refused messages with every reason; ``raw`` is the original text, byte for byte."""
    stamp = rejected_at if isinstance(rejected_at, Column) else instant(rejected_at)
    return validated.filter(F.size("errors") > 0).select(
        F.col("value").alias("raw"),
        "errors",
        iso_utc(stamp).alias("rejected_at"),
        F.struct(
            F.col("topic"),
            F.col("partition").cast("int").alias("partition"),
            F.col("offset").cast("bigint").alias("offset"),
        ).alias("source"),
    )


def deadletter_payload(deadletter: DataFrame) -> DataFrame:
    """Dead-letter rows as one JSON text ``value`` each; ``raw`` is nested JSON where it is JSON."""
    rest = [F.col(c) for c in ("errors", "rejected_at", "source")]
    doc = F.expr("try_parse_json(raw)")
    keep = {"ignoreNullFields": "false"}
    as_json = F.to_json(F.struct(doc.alias("raw"), *rest), keep)
    as_text = F.to_json(F.struct(F.col("raw"), *rest), keep)
    return deadletter.select(F.when(doc.isNotNull(), as_json).otherwise(as_text).alias("value"))


def route(
    messages: DataFrame, as_of: datetime | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(Bronze rows, dead-letter rows) of a batch of messages."""
    validated = validate(messages, as_of)
    return bronze_rows(validated, as_of), deadletter_rows(validated, as_of)


def ingest_stats(validated: DataFrame) -> DataFrame:
    """One row: messages consumed, valid and rejected."""
    valid = F.count_if(F.size("errors") == 0)
    return validated.agg(
        F.count(F.lit(1)).alias("consumed"),
        valid.alias("valid"),
        F.count_if(F.size("errors") > 0).alias("rejected"),
    )


def rejection_profile(deadletter: DataFrame) -> DataFrame:
    """Reasons counted per field: all of them, and those that come first in their message."""
    exploded = deadletter.select(F.posexplode("errors").alias("pos", "reason"))
    return exploded.groupBy(
        F.substring_index("reason", ":", 1).alias("field")
    ).agg(
        F.count(F.lit(1)).alias("reasons"),
        F.count_if(F.col("pos") == 0).alias("first_reasons"),
    )


def first_reason_samples(deadletter: DataFrame) -> DataFrame:
    """Per field of the first reason: its message count and the earliest sample.

    Earliest is by partition, then offset; ``min_by`` combines before the shuffle, so one
    dominating field is no hot spot.
    """
    first = F.element_at("errors", 1)
    position = F.struct("source.partition", "source.offset")
    return (
        deadletter.withColumns({"first": first, "position": position})
        .groupBy(F.substring_index("first", ":", 1).alias("field"))
        .agg(
            F.count(F.lit(1)).alias("rejected"),
            F.min_by("first", "position").alias("sample_reason"),
            F.min("position").alias("position"),
        )
        .select(
            "field",
            "rejected",
            "sample_reason",
            F.col("position.partition").alias("sample_partition"),
            F.col("position.offset").alias("sample_offset"),
        )
    )
