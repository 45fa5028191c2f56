"""Keyed merge of two DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with ``source`` upserted on ``keys`` (unique on both sides).

    Only the keys of the source reach the join, so a small increment is broadcast by the
    planner from its measured size and the large target is not shuffled.
    """
    untouched = target.join(source.select(*keys), keys, "left_anti")
    return untouched.unionByName(source)


def newest_rows(
    target: DataFrame, source: DataFrame, keys: list[str], newest: str
) -> DataFrame:
    """The row of each key with the greatest ``newest``; of equal ones that of the source.

    ``row_number() = 1`` is planned as a group limit before the shuffle.
    """
    both = target.withColumn("_arriving", F.lit(0)).unionByName(
        source.withColumn("_arriving", F.lit(1))
    )
    window = Window.partitionBy(*keys).orderBy(F.desc(newest), F.desc("_arriving"))
    ranked = both.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1)
    return ranked.drop("_rank", "_arriving")


def merge_metrics(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """One row: source rows, and how many of them update or insert."""
    known = target.select(*keys).withColumn("_known", F.lit(True))
    flagged = source.select(*keys).join(known, keys, "left")
    updated = F.count_if(F.col("_known").isNotNull())
    return flagged.agg(
        F.count(F.lit(1)).alias("source_rows"),
        updated.alias("num_target_rows_updated"),
        F.count_if(F.col("_known").isNull()).alias("num_target_rows_inserted"),
    )
