"""Gapless numbers within groups, without one task per group."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import write_out

CHUNKS = 256


def number_within(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2 ... within each value of ``group``.

    Rows are dealt into chunks, numbered inside each (group, chunk), and shifted by the rows of
    the earlier chunks, so even a group that holds most rows, or most of them with one key, is
    numbered by many tasks. The chunks are written down first: counting and numbering then see
    the same ones, also when a lost task runs again.
    """
    chunk = f"chunk_{uuid.uuid4().hex[:8]}"
    dealt = df.withColumn(chunk, F.pmod(F.xxhash64(*order, F.monotonically_increasing_id()), F.lit(CHUNKS)))
    dealt = write_out(dealt)
    counts = dealt.groupBy(group, chunk).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(group, chunk, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(group, chunk).orderBy(*order)
    numbered = dealt.withColumn("_row", F.row_number().over(inside))
    return (
        numbered.join(shifts, [group, chunk])
        .withColumn(name, (F.col("_row") - 1 + F.col("_shift")).cast("long"))
        .drop("_row", "_shift", chunk)
    )
