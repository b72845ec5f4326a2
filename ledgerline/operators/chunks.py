"""Running windows over logs whose largest key does not fit in one task.

A window that runs along a key needs all rows of the key in one task. That is right for
ordinary keys and wrong for a key that holds a large share of the log. ``split_hot_keys``
sets such keys apart and range-partitions their rows by position, which numbers the pieces
of every key in order. A running value is then computed inside each piece and completed
with what the earlier pieces leave behind, from one small row per piece.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import cut_lineage, write_out

CHUNK = "chunk"
DEFAULT_CHUNK_ROWS = 1_000_000
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Split:
    """Rows of ordinary keys, and rows of hot keys numbered by piece (None if no key is hot)."""

    ordinary: DataFrame
    hot: DataFrame | None = None
    hot_keys: DataFrame | None = None
    hot_count: int = 0

    def few_hot_keys(self, other: DataFrame, key: str) -> DataFrame:
        """The rows of ``other`` for the hot keys; ``other`` has one row per key."""
        kept = other.join(_small(self.hot_keys, self.hot_count), key, "left_semi")
        return _small(kept, self.hot_count)


def _small(rows: DataFrame, count: int) -> DataFrame:
    """Broadcast a table of known row count; a larger one is left to the adaptive planner."""
    return F.broadcast(rows) if count <= BROADCAST_ROWS else rows


def split_hot_keys(
    rows: DataFrame, key: str, order: Sequence[str], chunk_rows: int = DEFAULT_CHUNK_ROWS
) -> Split:
    """Set apart the keys above ``chunk_rows`` and cut their rows into ordered pieces.

    The count reads the key column alone and combines map-side. There are at most
    ``total / chunk_rows`` hot keys. Their rows go to the checkpoint folder, so the piece
    a row was given stays the same when a lost task is run again.
    """
    sizes = rows.groupBy(key).count().filter(F.col("count") > chunk_rows)
    found = sizes.agg(F.count("*").alias("keys"), F.sum("count").alias("rows")).first()
    if not found["keys"]:
        return Split(rows)
    hot_keys = cut_lineage(sizes.select(key))
    small = _small(hot_keys, found["keys"])
    hot = (
        rows.join(small, key, "left_semi")
        .repartitionByRange(math.ceil(found["rows"] / chunk_rows), key, *order)
        .withColumn(CHUNK, F.spark_partition_id())
    )
    return Split(rows.join(small, key, "left_anti"), write_out(hot), hot_keys, found["keys"])


def next_in_key(
    rows: DataFrame, keys: Sequence[str], order: str, value: str, name: str
) -> DataFrame:
    """``lead(value)`` along ``keys``, completed across pieces; rows carry ``chunk``."""
    inside = Window.partitionBy(*keys, CHUNK).orderBy(order)
    later = Window.partitionBy(*keys).orderBy(CHUNK)
    first_of_next = (
        rows.groupBy(*keys, CHUNK)
        .agg(F.min(value).alias("_first"))
        .withColumn("_next", F.lead("_first").over(later))
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(CHUNK).alias("_k_chunk"), "_next")
    )
    same = F.col(CHUNK) == F.col("_k_chunk")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return (
        rows.withColumn("_inside", F.lead(value).over(inside))
        .join(first_of_next, same)
        .withColumn(name, F.coalesce("_inside", "_next"))
        .select(*rows.columns, name)
    )
