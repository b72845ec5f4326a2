"""Weighted rendezvous hashing of record keys over shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.numbering import number_within


def _draw(key: Column, shard: Column, weight: Column) -> Column:
    """A draw per key and shard; the shard with the highest wins. With u uniform in (0, 1),
    weight / -ln(u) is highest for a shard with a chance in proportion to its weight."""
    u = (F.shiftrightunsigned(F.xxhash64(key, shard), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return weight / -F.log(u)


def rendezvous(key: Column, weights: list[float], grown_by: float = 1.0) -> tuple[Column, Column]:
    """The shard of a key, and its shard were there one more of weight ``grown_by``.

    Draws do not depend on the other shards, so a new shard only takes what it wins itself.
    """
    first = F.array(*[
        F.struct(_draw(key, F.lit(i), F.lit(float(w))).alias("draw"), F.lit(-i).alias("shard"))
        for i, w in enumerate(weights)
    ])
    best = F.array_max(first)
    more = _draw(key, F.lit(len(weights)), F.lit(float(grown_by)))
    shard = (-best["shard"]).cast("int")
    return shard, F.when(more > best["draw"], F.lit(len(weights))).otherwise(shard).cast("int")


def record_key(key: Column, text: Column) -> Column:
    """The key as text; rows without one go by their content."""
    return F.coalesce(F.concat(F.lit("k:"), key.cast("string")), F.concat(F.lit("t:"), F.md5(text)), F.lit(""))


def shard_documents(
    docs: DataFrame, shards: int | list[float] = 24, key: str = "doc_id", text: str = "text", overhead: int = 8,
) -> DataFrame:
    """Put every record into a shard by rendezvous hashing of its key.

    Columns: the key, size (UTF-8 bytes of the text plus ``overhead``), text_crc32, law
    ('key': the key and the shards decide alone), shard, slot (gapless from 0 within the
    shard) and grown_shard (the shard if one more of weight 1 were added).
    ``shards`` is a number of equal shards or a list of weights.

    Null texts have no bytes. Rows without a key go by their text. Repeated rows and keys share
    their shard and have slots of their own. Other columns play no part; an empty table gives
    no rows.
    """
    weights = [1.0] * shards if isinstance(shards, int) else [float(w) for w in shards]
    content = F.coalesce(F.col(text), F.lit(""))
    shard, grown = rendezvous(record_key(F.col(key), content), weights)
    placed = docs.select(
        F.col(key),
        (F.octet_length(content) + overhead).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard.alias("shard"),
        grown.alias("grown_shard"),
    )
    numbered = number_within(placed, "shard", [key, "text_crc32"], "slot")
    return numbered.select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int | list[float] = 24, key: str = "doc_id", text: str = "text") -> None:
    """Write whole records as one folder per shard; large shards become several files."""
    weights = [1.0] * shards if isinstance(shards, int) else [float(w) for w in shards]
    shard, _ = rendezvous(record_key(F.col(key), F.coalesce(F.col(text), F.lit(""))), weights)
    placed = docs.withColumn("shard", shard)
    placed.hint("rebalance", "shard").write.mode("error").partitionBy("shard").parquet(path)
