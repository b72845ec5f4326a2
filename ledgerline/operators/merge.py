"""Keyed merges of two frames, the core of the table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.dedup import last_per_key
from ledgerline.operators.lookups import null_safe


def latest(incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The last row per key. Without an order, equal keys are settled by a hash of the row."""
    if order:
        return last_per_key(incoming, keys, order)
    hashed = incoming.withColumn("_hash", F.xxhash64(*incoming.columns))
    return last_per_key(hashed, keys, ["_hash"]).drop("_hash")


def put(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` with the rows of ``batch`` put in place; both are unique per key.

    The large side only passes an anti join against the keys of the batch, so it is not
    shuffled when the batch is small enough to broadcast.
    """
    renamed = [f"_in_{k}" for k in keys]
    batch_keys = batch.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed, strict=True)])
    untouched = existing.join(batch_keys, null_safe(keys, renamed), "left_anti")
    return untouched.unionByName(batch, allowMissingColumns=True)


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``existing`` (unique per key) with the last row per key of ``incoming`` put in place."""
    return put(existing, latest(incoming, keys, order).drop(*order), keys)


def replace_partition(existing: DataFrame, fresh: DataFrame, column: str, value: str) -> DataFrame:
    """Drop every row of one partition and put the fresh rows in its place."""
    return existing.filter(~F.col(column).eqNullSafe(F.lit(value))).unionByName(fresh)
