"""Totals of a group on each of its rows, where one group may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Parts into which a group's rows are dealt.
SALTS = 64

_MERGE = {"count": F.sum, "min": F.min, "max": F.max}


def attach(rows: DataFrame, keys: list[str], spread: str, **totals: tuple[str, str]) -> DataFrame:
    """``rows`` with a column for each of ``totals``: name = (count, min or max; column).

    Rows are dealt by ``spread`` into ``SALTS`` parts of their group; the parts are summed before
    the shuffle, at most ``SALTS`` rows of a group meet for its total, and rows are joined by
    group and part.  Rows whose keys are null are left out.  ``rows`` is read twice.
    """
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    own = [getattr(F, fn)(column).alias(name) for name, (fn, column) in totals.items()]
    group = Window.partitionBy(*keys)
    parts = dealt.groupBy(*keys, "salt").agg(*own)
    whole = [_MERGE[fn](name).over(group).alias(name) for name, (fn, _) in totals.items()]
    return dealt.join(parts.select(*keys, "salt", *whole), [*keys, "salt"]).drop("salt")
