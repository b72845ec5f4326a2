"""Connected components by alternating star contraction (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the smallest node around it."""
    around = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        around.filter(F.col("v") > F.col("u")).join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v"))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; a component is named by its
    smallest node. Neighbours are only ever aggregated, never gathered in one row."""

    def fingerprint(frame: DataFrame) -> tuple:
        # Decimal sums do not overflow and do not depend on the order of the rows.
        return tuple(
            frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        )

    current = cut_lineage(edges.select("u", "v").filter(F.col("u") != F.col("v")).distinct())
    before = fingerprint(current)
    while True:  # every round shortens what is left, so the loop ends
        current = cut_lineage(_small_star(_large_star(current).distinct()).distinct())
        after = fingerprint(current)
        if after == before:
            break
        before = after
    centres = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        centres.select("node", F.col("node").alias("component"))
    )
