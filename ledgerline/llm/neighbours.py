"""Nearest neighbours by randomly rotated one-bit codes with error bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.workers import ready

from ledgerline.session import write_out

K = 20
SEED = 20
BASE_ROWS, QUERY_ROWS = 8192, 1024
SIGMAS = 3.0  # half width of an estimate's interval, in its standard deviations
FIRST = 64  # vectors reranked at once to get a first threshold


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix; the same for a seed on every machine."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``(vec_id, vector)`` without nulls, zeros, null or non-finite components."""
    values = F.col("vector")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    some = F.exists(values, lambda x: x != 0)
    plain = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    return plain.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad & some)


LONGEST = 4096  # components; longer vectors are not rotated, and all of them are reranked


def _turned(rows: np.ndarray, seed: int) -> np.ndarray:
    return rows @ rotation(rows.shape[1], seed).T if rows.shape[1] <= LONGEST else rows


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def build_index(vectors: DataFrame, seed: int = SEED) -> DataFrame:
    """``(vec_id, vector, dims, code, norm, along)``: the signs of the rotated unit vector packed
    into bits, its length, and its inner product with the unit vector of the signs."""

    def encode(batches):
        for batch in batches:
            sizes = batch["vector"].value_lengths().to_numpy()
            for dims in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == dims))
                rows = _matrix(part["vector"], dims)
                norm = np.sqrt(np.einsum("ij,ij->i", rows, rows))
                turned = _turned(rows / norm[:, None], seed)
                code = np.packbits(turned >= 0, axis=1)
                along = np.abs(turned).sum(axis=1) / np.sqrt(dims)
                yield pa.RecordBatch.from_arrays(
                    [part["vec_id"], part["vector"], pa.array([dims] * len(rows), pa.int32()), pa.array([c.tobytes() for c in code], pa.binary()),
                     pa.array(norm), pa.array(along)],
                    names=["vec_id", "vector", "dims", "code", "norm", "along"],
                )

    return ready(vectors).mapInArrow(encode, "vec_id long, vector array<double>, dims int, code binary, norm double, along double")


def search_block(queries: pa.Table, base: pa.Table, dims: int, k: int, seed: int = SEED) -> pa.Table:
    """The ``k`` nearest rows of one block of the index for one block of queries.

    Inner products are estimated from the bits and the two scalars of a code. The nearest by
    estimate are reranked first; every vector whose upper bound reaches the k-th of them is
    reranked then.
    """
    names = ["query_id", "vec_id", "score"]
    ids, query_ids = base["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    rows, asked = _matrix(base["vector"], dims), _matrix(queries["vector"], dims)
    norm, along = base["norm"].to_numpy(), np.clip(base["along"].to_numpy(), 1e-9, 1)
    packed = np.frombuffer(b"".join(base["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
    signs = np.unpackbits(packed, axis=1, count=dims).astype(np.float32) * 2 - 1
    lengths = np.sqrt(np.einsum("ij,ij->i", asked, asked))
    turned = _turned(asked / lengths[:, None], seed).astype(np.float32)
    scale = norm / (along * np.sqrt(dims))
    width = norm * np.sqrt(np.maximum(1 - along**2, 0)) / along * SIGMAS / np.sqrt(max(dims - 1, 1))
    if dims > LONGEST:
        width = np.full(len(ids), np.inf)
    out = []
    for at in range(0, len(query_ids), 128):
        q = slice(at, at + 128)
        guess = (signs @ turned[q].T) * scale[:, None].astype(np.float32)
        guess = np.where(ids[:, None] == query_ids[None, q], -np.inf, guess)
        n = guess.shape[1]
        floor = np.full(n, -np.inf)
        if len(ids) > FIRST:
            top = np.argpartition(-guess, FIRST - 1, axis=0)[:FIRST]
            exact = np.einsum("fqd,qd->fq", rows[top], asked[q])
            exact[np.take_along_axis(guess, top, axis=0) == -np.inf] = -np.inf
            floor = np.sort(exact, axis=0)[-k] if FIRST >= k else floor
        chosen = (guess + width[:, None]) * lengths[None, q] >= floor[None, :] - 1e-9
        chosen &= guess != -np.inf
        who, which = np.nonzero(chosen.T)
        score = np.empty(len(who))
        for s in range(0, len(who), 1 << 17):
            part = slice(s, s + (1 << 17))
            score[part] = np.einsum("ij,ij->i", rows[which[part]], asked[q][who[part]])
        order = np.lexsort((ids[which], -score, who))
        who, which, score = who[order], which[order], score[order]
        first = np.searchsorted(who, np.arange(n))
        kept = np.arange(len(who)) - first[who] < k
        out.append((query_ids[q][who[kept]], ids[which[kept]], score[kept]))
    return pa.table([np.concatenate(c) for c in zip(*out)] if out else [[], [], []], names=names)


def nearest(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = K,
    base_rows: int = BASE_ROWS, query_rows: int = QUERY_ROWS, seed: int = SEED,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row whose key is divisible by ``every``,
    the ``k`` rows of the largest inner product among all others, ties to the smaller key.

    Every row is indexed; nothing is fitted. Queries and index are cut into blocks by a hash,
    each pair of blocks is one task, and only ``k`` rows a query and block leave it. Scores are
    inner products of the original vectors in double precision; equal vectors score alike.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do
    those without a key. Inner products are of vectors with as many components, so those of
    another length than the query are no candidates for it. A key that comes twice is a
    candidate twice, and a query once. Fewer candidates than ``k``: all. Other columns play no
    part; an empty table gives no rows.
    """
    schema = "query_id long, vec_id long, score double"
    plain = usable(vectors, key, vector)
    n = plain.count()
    blocks, query_blocks = max(1, -(-n // base_rows)), max(1, -(-n // (every * query_rows)))
    spread = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    index = write_out(build_index(plain, seed).withColumn("block", spread))
    base = index.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = index.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = asked.withColumn("dims", F.size("vector"))
    asked = asked.withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return search_block(queries, rows, queries["dims"][0].as_py(), k, seed)

    pair = ["dims", "query_block", "block"]
    found = ready(asked).groupBy(*pair).cogroup(base.groupBy(*pair)).applyInArrow(search, schema)
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
