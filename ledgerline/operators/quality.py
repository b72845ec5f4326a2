"""Counts that describe a run and checks that should find nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.session import write_out


def entity_summary(name: str, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows, how many distinct keys, how many duplicates were removed."""
    per_key = rows.groupBy(*keys).agg(F.count("*").alias("copies"))
    return per_key.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"), F.count("*").alias("kept")).select(
        F.lit(name).alias("entity"), "rows", "kept", (F.col("rows") - F.col("kept")).alias("duplicates")
    )


def failures(name: str, rows: DataFrame, failed: Column) -> DataFrame:
    """One row: the number of rows for which ``failed`` holds."""
    return rows.agg(F.count_if(failed).alias("failures")).select(F.lit(name).alias("check"), "failures")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


class CheckFailed(ValueError):
    """Rows of a job are not as its later steps need them."""


def write_checked(
    rows: DataFrame, counts: dict[str, Column], zero: dict[str, Column] | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """``rows`` written to the scratch folder, and aggregates over them that ride on that write, so
    there is no further scan. One of ``zero`` that is not zero is an error."""
    seen, zero = Observation(), zero or {}
    written = write_out(rows.observe(seen, *[c.alias(n) for n, c in {**counts, **zero}.items()]))
    found = seen.get
    failed = {n: found[n] for n in zero if found[n]}
    if failed:
        raise CheckFailed(", ".join(f"{n}: {v}" for n, v in failed.items()))
    return written, {n: found[n] or 0 for n in counts}


def write_unique(
    rows: DataFrame, keys: Sequence[str], counts: dict[str, Column] | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """As ``write_checked``, for a table that others are joined to many to one: a key that occurs
    twice is an error, found while the table is written."""
    others = [c for c in rows.columns if c not in keys]
    grouped = rows.groupBy(*keys).agg(F.count("*").alias("_copies"), F.first(F.struct(*others)).alias("_row"))
    once = grouped.select(*keys, "_row.*", "_copies")
    most = F.max(F.struct("_copies", *keys)).alias("_most")
    seen = Observation()
    written = write_out(once.observe(seen, most, *[c.alias(n) for n, c in (counts or {}).items()]))
    found = seen.get
    if found["_most"] and found["_most"]["_copies"] > 1:
        example = {k: found["_most"][k] for k in keys}
        raise CheckFailed(f"key {example} occurs {found['_most']['_copies']} times")
    return written.drop("_copies"), {n: found[n] or 0 for n in counts or {}}
