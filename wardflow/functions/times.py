"""Time helpers; the current instant is always an argument."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(as_of: datetime | str | None = None) -> Column:
    """A fixed UTC instant as a literal column; the run's start when none is given.

    A literal, not ``current_timestamp()``: a recomputed task must see the same value.
    """
    if as_of is None:
        as_of = datetime.now(timezone.utc)
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    delta = as_of - datetime(1970, 1, 1, tzinfo=timezone.utc)
    micros = (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
    return F.timestamp_micros(F.lit(micros))


def hour_floor(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def age_minutes(ts: Column, as_of: Column) -> Column:
    """Minutes from ``ts`` to ``as_of`` as a double, exact to the microsecond."""
    return (F.unix_micros(as_of) - F.unix_micros(ts)) / F.lit(60_000_000.0)


def iso_utc(ts: Column, suffix: Column | str = "+00:00") -> Column:
    """ISO-8601 text; the fraction is printed only where there is one."""
    suffix = F.lit(suffix) if isinstance(suffix, str) else suffix
    has_fraction = F.unix_micros(ts) % 1_000_000 != 0
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.when(has_fraction, micros).otherwise(seconds), suffix)
