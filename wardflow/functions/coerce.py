"""Lax coercion of JSON field values, with the reason where a value is refused.

``to_*`` takes a field's JSON kind (``schema_of_variant`` text) and its text and gives the
value, null where it is refused.  ``*_reason`` takes the same and the value's column and gives
the reason, null where there is none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardflow.functions.text import strip, strip_column
from wardflow.functions.times import iso_utc


# Reason texts.
VALID_STRING = "Input should be a valid string"
VALID_INT = "Input should be a valid integer"
INT_TEXT = "Input should be a valid integer, unable to parse string as an integer"
INT_FRACTION = "Input should be a valid integer, got a number with a fractional part"
INT_SIZE = "Unable to parse input string as an integer, exceeded maximum size"
VALID_NUMBER = "Input should be a valid number"
NUMBER_TEXT = "Input should be a valid number, unable to parse string as a number"
VALID_BOOL = "Input should be a valid boolean"
BOOL_TEXT = "Input should be a valid boolean, unable to interpret input"
VALID_DATETIME = "Input should be a valid datetime"
DATETIME_TEXT = "Input should be a valid datetime or date, "

# Accepted spellings and patterns.
TRUE_WORDS = ["1", "on", "t", "true", "y", "yes"]
FALSE_WORDS = ["0", "off", "f", "false", "n", "no"]
INT_PATTERN = r"^[+-]?[0-9]+(_[0-9]+)*(\.0+)?$"
FLOAT_PATTERN = (
    r"^(?i)[+-]?(([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+)(e[+-]?[0-9]+)?"
    r"|inf|infinity|nan)$"
)
EPOCH_PATTERN = r"^[+-]?[0-9]+(\.[0-9]+)?$"
ISO_PATTERN = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2})"
    r"(?:[Tt _]([0-9]{2}:[0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]{1,9}))?)?"
    r"([Zz]|[+-](?:[01][0-9]|2[0-3]):?[0-5][0-9])?)?$"
)
# Epoch numbers above this many units are milliseconds, below it seconds.
EPOCH_SECONDS_LIMIT = 20_000_000_000.0
LAST_EPOCH_SECOND = 253_402_300_799.0  # end of year 9999
INT64_LIMIT = 9_223_372_036_854_775_807.0


def _is_number(kind: Column) -> Column:
    return (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")


def _from_bool(text: Column) -> Column:
    return F.when(text == "true", 1.0).otherwise(0.0)


def to_string(kind: Column, text: Column) -> Column:
    return F.when(kind == "STRING", strip_column(text))


def string_reason(kind: Column, text: Column, value: Column) -> Column:
    return F.when(kind != "STRING", VALID_STRING)


def to_int(kind: Column, text: Column) -> Column:
    """Whole number as a double, so that any size can still be range checked."""
    digits = F.replace(strip(text), F.lit("_"), F.lit(""))
    return (
        F.when(_is_number(kind), text.try_cast("double"))
        .when((kind == "STRING") & strip(text).rlike(INT_PATTERN), digits.try_cast("double"))
        .when(kind == "BOOLEAN", _from_bool(text))
    )


def int_reason(kind: Column, text: Column, value: Column) -> Column:
    return (
        F.when(_is_number(kind) & (value % 1 != 0), INT_FRACTION)
        .when((kind == "DOUBLE") & (F.abs(value) > INT64_LIMIT), INT_SIZE)
        .when(value.isNull() & (kind == "STRING"), INT_TEXT)
        .when(value.isNull(), VALID_INT)
    )


def to_float(kind: Column, text: Column) -> Column:
    digits = F.replace(strip(text), F.lit("_"), F.lit(""))
    return (
        F.when(_is_number(kind), text.try_cast("double"))
        .when((kind == "STRING") & strip(text).rlike(FLOAT_PATTERN), digits.try_cast("double"))
        .when(kind == "BOOLEAN", _from_bool(text))
    )


def float_reason(kind: Column, text: Column, value: Column) -> Column:
    return F.when(value.isNull() & (kind == "STRING"), NUMBER_TEXT).when(
        value.isNull(), VALID_NUMBER
    )


def to_bool(kind: Column, text: Column) -> Column:
    number, word = text.try_cast("double"), F.lower(text)
    return (
        F.when(kind == "BOOLEAN", text == "true")
        .when(_is_number(kind) & number.isin(0.0, 1.0), number == 1.0)
        .when((kind == "STRING") & word.isin(TRUE_WORDS), True)
        .when((kind == "STRING") & word.isin(FALSE_WORDS), False)
    )


def bool_reason(kind: Column, text: Column, value: Column) -> Column:
    whole = _is_number(kind) & (text.try_cast("double") % 1 == 0)
    return F.when(
        value.isNull(), F.when(whole | (kind == "STRING"), BOOL_TEXT).otherwise(VALID_BOOL)
    )


def _is_epoch(kind: Column, text: Column) -> Column:
    return _is_number(kind) | ((kind == "STRING") & text.rlike(EPOCH_PATTERN))


def _iso_part(text: Column, name: str) -> Column:
    names = ("date", "clock", "second", "fraction", "zone")
    return F.regexp_extract(text, ISO_PATTERN, names.index(name) + 1)


def iso_wall(text: Column) -> Column:
    """The local time as an ISO text writes it, as if it were UTC; null if it is no real time."""

    def or_else(name: str, default: str) -> Column:
        part = _iso_part(text, name)
        return F.when(part == "", default).otherwise(part)

    fraction = F.rpad(F.substring(_iso_part(text, "fraction"), 1, 6), 6, "0")
    return F.concat(
        _iso_part(text, "date"), F.lit("T"), or_else("clock", "00:00"), F.lit(":"),
        or_else("second", "00"), F.lit("."), fraction, F.lit("Z"),
    ).try_cast("timestamp")


def iso_offset(text: Column) -> Column:
    """Minutes east of UTC of an ISO text; 0 without a zone."""
    digits = F.regexp_replace(_iso_part(text, "zone"), "[^0-9]", "")
    hours, rest = (F.substring(digits, at, 2).try_cast("bigint") for at in (1, 3))
    sign = F.when(_iso_part(text, "zone").startswith("-"), -1).otherwise(1)
    return F.coalesce((hours * 60 + rest) * sign, F.lit(0).cast("bigint"))


def to_instant(kind: Column, text: Column) -> Column:
    """ISO-8601 date or date-time, or epoch seconds / milliseconds; no offset means UTC.

    The plain cast reads the usual spellings; the pieces are taken apart only for the rest.
    """
    number = text.try_cast("double")
    seconds = F.when(F.abs(number) > EPOCH_SECONDS_LIMIT, number / 1000).otherwise(number)
    in_calendar = F.when(F.abs(seconds) <= LAST_EPOCH_SECOND, seconds)
    epoch = F.timestamp_micros(F.round(in_calendar * 1_000_000).cast("bigint"))
    unusual = F.timestamp_micros(F.unix_micros(iso_wall(text)) - iso_offset(text) * 60_000_000)
    is_iso = (kind == "STRING") & text.rlike(ISO_PATTERN)
    return F.when(is_iso, F.coalesce(text.try_cast("timestamp"), unusual)).when(
        _is_epoch(kind, text), epoch
    )


def shown_instant(text: Column, value: Column) -> Column:
    """The instant as ISO text in the offset it was sent with."""
    zoned = iso_utc(iso_wall(text), shown_offset(iso_offset(text)))
    return F.when(text.rlike(ISO_PATTERN), zoned).otherwise(iso_utc(value))


def instant_reason(kind: Column, text: Column, value: Column) -> Column:
    day, month = F.substring(text, 1, 10), F.substring(text, 6, 2).try_cast("int")
    looks_dated = day.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    after = _is_epoch(kind, text) & (text.try_cast("double") > 0)
    detail = (
        F.when(after, "dates after 9999 are not supported as unix timestamps")
        .when(_is_epoch(kind, text), "dates before 0000 are not supported as unix timestamps")
        .when(F.length(text) < 10, "input is too short")
        .when(~text.rlike("^[0-9]{4}"), "invalid character in year")
        .when(looks_dated & ~month.between(1, 12), "month value is outside expected range of 1-12")
        .when(looks_dated & day.try_cast("date").isNull(), "day value is outside expected range")
        .otherwise("unexpected extra characters at the end of the input")
    )
    dated = F.concat(F.lit(DATETIME_TEXT), detail)
    textual = (kind == "STRING") | _is_number(kind)
    return F.when(value.isNull(), F.when(textual, dated).otherwise(VALID_DATETIME))


def shown_offset(offset: Column) -> Column:
    """``+hh:mm`` of an offset in minutes."""
    minutes = F.abs(offset)
    sign = F.when(offset < 0, "-").otherwise("+")
    two = [F.lpad(x.cast("bigint").cast("string"), 2, "0") for x in (F.floor(minutes / 60), minutes % 60)]
    return F.concat(sign, two[0], F.lit(":"), two[1])
