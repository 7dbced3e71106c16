"""Top-k per group, weight normalisation, numbering and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(rows: DataFrame, group: str, weight: str, tie: str, k: int = 4) -> DataFrame:
    """The k heaviest rows of each group; ties go to the lower tie column."""
    w = Window.partitionBy(group).orderBy(F.col(weight).desc(), tie)
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def normalised(rows: DataFrame, group: str, weight: str, floor: float = 0.15) -> DataFrame:
    """Weights below a share of the group's largest dropped, the others made to sum to 1."""
    w = Window.partitionBy(group)
    kept = rows.withColumn("best", F.max(weight).over(w)).filter(F.col(weight) >= floor * F.col("best")).drop("best")
    return kept.withColumn("share", F.col(weight) / F.nullif(F.sum(weight).over(w), F.lit(0.0)))


def first_occurrence(rows: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.min_by(value, order).alias(value))


def adjacent_equal(rows: DataFrame, partition: str, order: list[str], value: str) -> DataFrame:
    """rows with same: whether the row before, in order, has the same value."""
    w = Window.partitionBy(partition).orderBy(*order)
    return rows.withColumn("same", F.coalesce(F.lag(value).over(w) == F.col(value), F.lit(False)))


def running_offsets(parts: DataFrame, order: str, size: str) -> DataFrame:
    """parts with offset: the sizes of the parts before (one row a part, a small table)."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("offset", F.coalesce(F.sum(size).over(w), F.lit(0)).cast("long"))
