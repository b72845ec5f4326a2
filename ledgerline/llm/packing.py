"""Packing of tokenised documents into sequences: cutting stock by column generation."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.numbering import number_within
from ledgerline.llm.tokens import encoder
from ledgerline.llm.words import spread
from ledgerline.llm.workers import ready, release
from ledgerline.session import write_out

CAPACITY = 2048
FINE = 6  # lengths up to 2 ** FINE are classes of their own, longer ones rounded by under 1 in 2 ** FINE
GAP = 0.001  # stop when the program is within this share of its lower bound,
PIVOTS = 300  # or when so many pivots have brought less than that share


def best_pattern(sizes: np.ndarray, prices: np.ndarray, units: int) -> tuple[float, np.ndarray]:
    """The dearest multiset of sizes (ascending) that fits in ``units``: knapsack by dynamic programming.

    Sizes are taken up one after the other. The best number of copies of one is a running maximum
    along the weights that differ by its multiples; a size that smaller ones match in price is left out.
    """
    value, used = np.zeros(units + 1), []
    for i, (size, price) in enumerate(zip(sizes.tolist(), prices.tolist())):
        if size > units or price <= value[size] + 1e-12:
            continue
        used.append(i)
        rows = -(-(units + 1) // size)
        padded = np.full(rows * size, -np.inf)
        padded[: units + 1] = value
        paid = price * np.arange(rows)[:, None]
        value = (np.maximum.accumulate(padded.reshape(rows, size) - paid, axis=0) + paid).ravel()[: units + 1]
    pattern, weight = np.zeros(len(sizes)), units
    own, cost = sizes[used], prices[used]
    while value[weight] > 1e-12:
        weight = int(np.searchsorted(value[: weight + 1], value[weight] - 1e-12))  # the least weight worth as much
        fits = own <= weight
        short = np.abs(value[weight - own[fits]] + cost[fits] - value[weight])
        best = np.flatnonzero(fits)[short.argmin()]
        copies = np.arange(1, weight // own[best] + 1)
        exact = np.abs(value[weight - copies * own[best]] + copies * cost[best] - value[weight]) <= 1e-9
        n = max(1, int(exact.argmin()) if not exact.all() else len(copies))
        pattern[used[best]] += n
        weight -= n * int(own[best])
    return float(value[units]), pattern


def largest_first(sizes: np.ndarray, left: np.ndarray, units: int) -> np.ndarray:
    """The pattern that takes as many as fit of what is left, from the largest size down."""
    column, space = np.zeros_like(left), units
    for i in range(len(sizes) - 1, -1, -1):
        column[i] = min(np.ceil(left[i]), space // sizes[i])
        space -= column[i] * sizes[i]
    return column


def first_basis(sizes: np.ndarray, demand: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns to start from, largest first, and the inverse of their matrix.

    Each uses up some size and is its column. In the order in which sizes are used up the matrix is
    triangular, so the patterns form a basis, and none is used less than zero times.
    """
    basis, left = np.diag((units // sizes).astype(float)), demand.astype(float)
    order: list[int] = []
    while len(order) < len(sizes):
        column = largest_first(sizes, left, units)
        held = np.flatnonzero(column)
        ratios = left[held] / column[held]
        done = int(held[ratios.argmin()])
        left = np.maximum(left - ratios.min() * column, 0)
        basis[:, done] = column
        gone = [done, *(i for i in held.tolist() if i != done and left[i] < 1e-9 * demand[i])]
        left[gone] = 0
        order += gone
    lower = basis[np.ix_(order, order)]
    solved = np.zeros_like(lower)
    for i in range(len(order)):
        solved[i] = -np.einsum("j,jk->k", lower[i, :i], solved[:i])
        solved[i, i] += 1
        solved[i] /= lower[i, i]
    inverse = np.empty_like(solved)
    inverse[np.ix_(order, order)] = solved
    return basis, inverse


def solve(sizes: np.ndarray, demand: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Patterns (columns), how often each is used in the linear program, and a lower bound.

    Revised simplex: the knapsack prices the next column with the duals of the basis; the
    bound of Farley tells how far the basis can be from the optimum. Ends within ``GAP`` of it, or
    when ``PIVOTS`` pivots gain less than that; the basis covers the demand in any case.
    """
    basis, inverse = first_basis(sizes, demand, units)
    uses = np.maximum(np.einsum("ij,j->i", inverse, demand), 0)
    bound, before, pivots = 0.0, np.inf, 0
    while True:
        if pivots % PIVOTS == 0:
            if not uses.sum() <= before * (1 - GAP):
                break
            before = uses.sum()
        pivots += 1
        prices = np.maximum(inverse.sum(axis=0), 0)
        value, column = best_pattern(sizes, prices, units)
        bound = max(bound, uses.sum() / max(value, 1.0))
        if value <= 1 + 1e-9 or uses.sum() - bound <= max(GAP * uses.sum(), 0.5):
            break
        moved = np.einsum("ij,j->i", inverse, column)
        ratios = np.where(moved > 1e-9, uses / np.where(moved > 1e-9, moved, 1), np.inf)
        out = int(ratios.argmin())
        if not np.isfinite(ratios[out]):
            break
        basis[:, out] = column
        row = inverse[out] / moved[out]
        inverse = inverse - np.outer(moved, row)
        inverse[out] = row
        uses = np.maximum(np.einsum("ij,j->i", inverse, demand), 0)
    return basis, uses, bound


def patterns(counts: dict[int, int], units: int) -> list[tuple[dict[int, int], int]]:
    """Integer patterns ``({class: pieces}, uses)`` that hold every piece exactly once.

    The uses of the linear program are rounded down; what that leaves, less than one use of
    each pattern, is packed largest first.
    """
    sizes = np.array(sorted(counts))
    if not len(sizes):
        return []
    left = np.array([counts[s] for s in sizes], dtype=np.int64)
    basis, uses, _ = solve(sizes, left.astype(float), units)
    found = []
    for column, use in zip(basis.T.round().astype(np.int64), np.floor(uses + 1e-9).astype(np.int64)):
        held = column > 0
        use = min(int(use), int((left[held] // column[held]).min()))
        if use > 0:
            found.append((column, use))
            left -= use * column
    while left.any():
        column = largest_first(sizes, left, units)
        held = column > 0
        use = int((left[held] // column[held]).min())
        found.append((column, use))
        left -= use * column
    return [({int(s): int(n) for s, n in zip(sizes, c) if n}, u) for c, u in found]


def pieces(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", word_wise: bool = True,
    capacity: int = CAPACITY, end_id: int = 1, with_ids: bool = False,
) -> DataFrame:
    """Every document cut into full pieces of ``capacity`` ids and a rest."""
    fields = [docs.select(key).schema[0]]
    fields = [T.StructField(key, fields[0].dataType)] + [
        T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")
    ]
    schema = T.StructType(fields + ([T.StructField("ids", T.BinaryType())] if with_ids else []))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path, word_wise)
        for batch in batches:
            first = 0
            for ids, counts in tokenizer.batches(batch.column(1)):
                with_end = np.insert(ids, np.cumsum(counts), end_id)
                whole = counts + 1
                parts = -(-whole // capacity)
                of = np.repeat(np.arange(len(counts)), parts)
                starts = capacity * spread(np.zeros(len(counts), np.int64), parts)
                lengths = np.minimum(whole[of] - starts, capacity)
                places = (np.cumsum(whole) - whole)[of] + starts
                raw = memoryview(with_end).cast("B")
                spans = [raw[4 * a : 4 * (a + n)] for a, n in zip(places.tolist(), lengths.tolist())]
                columns = [batch.column(0).take(pa.array(first + of)), pa.array(starts), pa.array(lengths)]
                columns += [pa.array([zlib.crc32(s) for s in spans], pa.int64()), pa.array(whole[of])]
                if with_ids:
                    columns.append(pa.array([s.tobytes() for s in spans], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                first += len(counts)
        tokenizer.forget()
        release()

    return ready(docs.select(key, text)).mapInArrow(cut, schema)


def pack(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", word_wise: bool = True,
    capacity: int = CAPACITY, end_id: int = 1, with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` ids, with little padding.

    A document is the ids of its text and then ``end_id``. One row per piece: the key, start,
    length, ids_crc32, doc_tokens, sequence_id and offset (and the ids, if asked for). Documents
    longer than a sequence are cut into full ones and a rest; nothing else is cut.

    The histogram of piece lengths (224 classes for 2048: exact up to 64, then rounded up by less
    than one in 64) is all that the driver sees. A linear program over patterns of classes, its columns priced by a knapsack, says
    which patterns to use how often; pieces are ranked within their class, and a rank belongs
    to one use of one pattern.

    Null and empty texts are a document of one id, the end. Repeated rows and keys are packed
    as often as they come; null keys are kept; other columns play no part. An empty table gives
    no rows.
    """
    cut = pieces(docs, path, key, text, word_wise, capacity, end_id, with_ids)
    step = F.expr(f"shiftleft(1, greatest(length(bin(length - 1)) - {FINE}, 0))")
    cut = cut.withColumn("_class", F.least(F.ceil(F.col("length") / step) * step, F.lit(capacity)).cast("int"))
    ranked = number_within(cut, "_class", ["doc_tokens", "start", "ids_crc32"], "_rank")
    ranked = write_out(ranked)
    counts = {r["_class"]: r["n"] for r in ranked.groupBy("_class").agg(F.count("*").alias("n")).collect()}
    slots, first_sequence = [], 0
    taken: dict[int, int] = {}
    for pattern, uses in patterns(counts, capacity):
        for kind, each in pattern.items():
            rank = taken.get(kind, 0)
            slots.append((kind, each, rank, rank + each * uses, first_sequence))
            taken[kind] = rank + each * uses
        first_sequence += uses
    spark = docs.sparkSession
    kinds = pa.schema([("_class", pa.int32()), *((c, pa.int64()) for c in ("_each", "_from", "_to", "_first"))])
    # From Arrow: a list of rows would start another kind of Python workers on the executors.
    table = spark.createDataFrame(pa.Table.from_pylist([dict(zip(kinds.names, s)) for s in slots], kinds))
    # At most two patterns for each class, each with at most all classes: a bounded table.
    placed = ranked.join(
        F.broadcast(table),
        (ranked["_class"] == table["_class"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")),
    ).withColumn("sequence_id", (F.col("_first") + F.floor((F.col("_rank") - F.col("_from")) / F.col("_each"))).cast("long"))
    before = (
        Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "_rank")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    columns = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id"]
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
    return placed.select(*columns, "offset", *(["ids"] if with_ids else []))
