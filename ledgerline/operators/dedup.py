"""One row per key: first, last, by priority; and checks that keys are unique.

``row_number() = 1`` is planned with a group limit below the exchange, so every task keeps
one row per key before anything is shuffled and a key with many copies stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key; nulls count as equal keys."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_position", position).filter(F.col("_position") == 1).drop("_position")


def last_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return first_per_key(rows, keys, [F.desc(c) for c in order])


def by_priority(
    rows: DataFrame, keys: Sequence[str], column: str, priority: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """The row whose ``column`` comes first in ``priority``; rows with other values are dropped."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col(column))
    ranked = rows.filter(F.col(column).isin(*priority)).withColumn("_rank", rank)
    return first_per_key(ranked, keys, ["_rank", *order]).drop("_rank")


def top_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], limit: int) -> DataFrame:
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("position", position).filter(F.col("position") <= limit)


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def require_unique(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` itself; raises when a key occurs twice."""
    example = duplicate_keys(rows, keys).limit(1).collect()
    if example:
        raise ValueError(f"duplicate key {example[0].asDict()}")
    return rows
