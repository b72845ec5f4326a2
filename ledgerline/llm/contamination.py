"""Benchmark passages in documents, found by winnowing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.words import NON_ALNUM, Slice, slices
from ledgerline.llm.workers import ready
from ledgerline.session import write_out

WINDOW = 13
GRAM = 7  # with windows of WINDOW - GRAM + 1 grams, every shared span of WINDOW words shares one
FILTER_BITS = 23
HIT = "fp long, at long, left string, gram string, right string"
HIT_TYPE = pa.struct([("fp", pa.int64()), ("at", pa.int64()), ("left", pa.string()), ("gram", pa.string()), ("right", pa.string())])


def _words(part: Slice, first: int, last: int) -> str:
    """Words ``first`` to ``last`` (exclusive) in lower case, one space between."""
    spans = zip(part.starts[first:last], part.ends[first:last])
    return b" ".join(part.raw[s:e].tobytes().lower() for s, e in spans).decode()


def _split(words: str) -> list[str]:
    return words.split(" ") if words else []


def _hit(part: Slice, d: int, start: int, k: int, fp: np.uint64, reach: int) -> dict:
    low, high = int(part.word_at[d]), int(part.word_at[d + 1])
    return {
        "fp": int(fp.view(np.int64)), "at": start - low, "left": _words(part, max(low, start - reach), start),
        "gram": _words(part, start, start + k), "right": _words(part, start + k, min(high, start + k + reach)),
    }


def _fingerprints(part: Slice, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed starts and hashes: the least gram of every window."""
    _, chosen, hashed = part.least(gram, window)
    starts = np.unique(chosen)
    return starts, hashed[starts]


def item_fingerprints(items: DataFrame, key: str, text: str, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Fingerprints of benchmark items with the words around them. An item shorter than a window
    is one gram of all its words."""
    schema = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("size", T.LongType())]
                          + list(T._parse_datatype_string(HIT).fields))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part in slices(batch.column(1), NON_ALNUM, lower=True):
                starts, hashed = _fingerprints(part, window, gram)
                owner = np.searchsorted(part.word_at, starts, side="right") - 1
                names = batch.column(0).slice(part.first, part.n).to_pylist()
                for s, h, d in zip(starts.tolist(), hashed, owner.tolist()):
                    rows.append({"item_id": names[d], "size": gram, **_hit(part, d, s, gram, h, window - gram)})
                words = np.diff(part.word_at)
                for d in np.flatnonzero((words > 0) & (words < window)).tolist():
                    n, s = int(words[d]), int(part.word_at[d])
                    fp = part.hashes(np.array([s]), n)[0]
                    rows.append({"item_id": names[d], "size": n, **_hit(part, d, s, n, fp, 0)})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("item_id", pa.string()), ("size", pa.int64()), *list(HIT_TYPE)]))

    return ready(items.select(F.col(key).cast("string"), text)).mapInArrow(mark, schema)


def bit_filter(fingerprints: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A Bloom filter with two probes in 2**bits bits; its size does not depend on the data."""
    low, high = F.col("fp"), F.shiftrightunsigned("fp", 32)
    probe = F.explode(F.array(*[x.bitwiseAND(F.lit((1 << bits) - 1)) for x in (low, high)]))
    slots = fingerprints.select(probe.alias("slot"))
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    out = np.zeros(1 << (bits - 6), np.int64)
    for row in words:  # at most 2**(bits - 6) rows
        out[row["word"]] = row["bits"]
    return out.view(np.uint64)


def _passes(table: np.ndarray, hashed: np.ndarray, bits: int) -> np.ndarray:
    found = np.ones(len(hashed), bool)
    for x in (hashed, hashed >> np.uint64(32)):
        slot = x & np.uint64((1 << bits) - 1)
        found &= ((table[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)
    return found


def document_hits(
    docs: DataFrame, key: str, text: str, table: np.ndarray, shorts: list[int], window: int = WINDOW, gram: int = GRAM, bits: int = FILTER_BITS,
) -> DataFrame:
    """Per row: a row number, the key, n_words, and the fingerprints that pass the filter with
    the words around them. ``shorts`` are the lengths of items shorter than a window."""
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField(key, docs.schema[key].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T._parse_datatype_string(HIT))),
    ])
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        probe = shared.value
        for batch in batches:
            counts, hits = [], []
            for part in slices(batch.column(1), NON_ALNUM, lower=True):
                found: list[list | None] = [None] * part.n
                looks = [(gram, window - gram, *_fingerprints(part, window, gram))]
                looks += [(n, 0, *part.windows(n)) for n in shorts]
                for k, reach, starts, hashed in looks:
                    passing = _passes(probe, hashed, bits)
                    starts, hashed = starts[passing], hashed[passing]
                    owner = np.searchsorted(part.word_at, starts, side="right") - 1
                    for s, h, d in zip(starts.tolist(), hashed, owner.tolist()):
                        found[d] = found[d] or []
                        found[d].append(_hit(part, d, s, k, h, reach))
                counts.append(np.diff(part.word_at))
                hits += found
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + batch.num_rows)), batch.column(0), pa.array(np.concatenate(counts)),
                     pa.array(hits, pa.list_(HIT_TYPE))], names=schema.names,
                )
                row += batch.num_rows

    return ready(docs.select(key, text)).mapInArrow(scan, schema)


def extended(met: DataFrame, window: int = WINDOW) -> DataFrame:
    """Confirm and extend matches: ``(row, first, last, item_id)`` where words ``first`` to
    ``last`` (exclusive) of a document lie in windows of the item."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["gram"] != r["i_gram"]:
                    continue
                left, right = 0, 0
                for x, y in zip(reversed(_split(r["left"])), reversed(_split(r["i_left"]))):
                    if x != y:
                        break
                    left += 1
                for x, y in zip(_split(r["right"]), _split(r["i_right"])):
                    if x != y:
                        break
                    right += 1
                whole = r["i_whole"]
                if whole or left + r["size"] + right >= window:
                    grow = (0, 0) if whole else (left, right)
                    out.append((r["row"], r["at"] - grow[0], r["at"] + r["size"] + grow[1], r["item_id"]))
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
                    names=["row", "first", "last", "item_id"],
                )

    return ready(met).mapInArrow(extend, "row long, first long, last long, item_id string")


def _covered(spans: Column) -> Column:
    """How many positions sorted spans ``(first, last)`` cover."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        spans, start,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["last"] - F.greatest(s["first"], acc["end"]), F.lit(0).cast("long"))).alias("n"),
            F.greatest(s["last"], acc["end"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )


def find_contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", window: int = WINDOW, gram: int = GRAM, share: int = 20, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Per row of ``docs``: the key, n_words, n_hit, n_items, items (sorted), contaminated.

    Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. A word
    is hit if it lies in an occurrence of a window of an item: ``window`` consecutive words, or
    all words of a shorter item. A document is contaminated if a word is hit and
    ``share`` * n_hit >= n_words.

    Winnowing keeps the least hash of every window of grams, on both sides, so each shared
    window shares a fingerprint at the same place in it. Document fingerprints pass a Bloom
    filter of fixed size (a fuller one lets more through, never fewer), carry the words around
    them, meet the items' by an equi-join, and are extended word by word: hashes decide nothing.

    Null texts have no words. Items without words have no window; a null item id is not listed
    but its words are hit. Repeated rows each give a row; null keys are kept; other columns play
    no part; with an empty table of items nothing is hit.
    """
    marks = write_out(item_fingerprints(items, item_key, item_text, window, gram))
    shorts = [r["size"] for r in marks.filter((F.col("size") != gram) | ((F.col("left") == "") & (F.col("right") == "")))
              .select("size").distinct().collect()]  # at most window - 1 lengths
    table = bit_filter(marks, filter_bits)
    scanned = write_out(document_hits(docs, key, text, table, sorted(shorts), window, gram, filter_bits))

    hits = scanned.filter(F.col("hits").isNotNull()).select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    hits = hits.withColumn("size", F.size(F.split("gram", " ")).cast("long"))
    whole = (F.col("left") == "") & (F.col("right") == "")
    known = marks.select(
        "fp", "item_id", "size", F.col("left").alias("i_left"), F.col("gram").alias("i_gram"), F.col("right").alias("i_right"),
        whole.alias("i_whole"),
    ).distinct()
    spans = write_out(extended(hits.join(known, ["fp", "size"]), window).distinct())
    covered = spans.groupBy("row").agg(
        _covered(F.array_sort(F.collect_set(F.struct("first", "last")))).alias("n_hit"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )
    rows = scanned.select("row", key, "n_words").join(covered, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        key, "n_words", n_hit.alias("n_hit"), F.size(items_found).cast("long").alias("n_items"), items_found.alias("items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
