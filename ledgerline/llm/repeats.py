"""Removal of word windows that occur more than once, by level-wise doubling."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.words import SPACES, Slice, spread
from ledgerline.llm.workers import ready
from ledgerline.session import write_out

LENGTH = 35
BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20


def level_lengths(length: int, shortest: int = 16) -> list[int]:
    """Lengths that double up to ``length``: 35 gives 18 and 35, two of 18 overlapping by one."""
    lengths = [length]
    while lengths[0] >= 2 * shortest:
        lengths.insert(0, (lengths[0] + 1) // 2)
    return lengths


def blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Documents packed into blocks: an id, the keys, the byte lengths, the compressed text."""
    kind = docs.schema[key].dataType
    schema = T.StructType([
        T.StructField("block", T.StringType()), T.StructField("keys", T.ArrayType(kind)),
        T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType()),
        T.StructField("bytes", T.LongType()),
    ])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        keys, texts, size = [], [], 0

        def block() -> pa.RecordBatch:
            columns = [
                pa.array([uuid.uuid4().hex]), pa.array([keys], pa.list_(key_type)),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                pa.array([packer.compress(b"".join(texts))], pa.binary()), pa.array([size], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            key_type = batch.column(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = (t.as_py() or "").encode()
                if keys and size + len(raw) > BLOCK_BYTES:
                    yield block()
                    keys, texts, size = [], [], 0
                keys.append(k)
                texts.append(raw)
                size += len(raw)
        if keys:
            yield block()

    return ready(docs.select(key, text)).mapInArrow(build, schema)


def _open(payload: bytes, sizes: list[int]) -> Slice:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8) if sum(sizes) else np.zeros(0, np.uint8)
    return Slice(0, raw, np.concatenate(([0], np.cumsum(np.array(sizes, np.int64)))), SPACES, lower=False)


class Walk:
    """One block on its way through the levels."""

    def __init__(self, part: Slice, lengths: list[int], buckets: int):
        self.part, self.lengths, self.buckets = part, lengths, buckets

    def candidates(self, level: int, repeated: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows to count on a level, given those that were repeated
        on the level before. On the first level, with a second to come, only the winnowed
        windows: each window of the second level holds one of them, always the same one."""
        part, k = self.part, self.lengths[level]
        if level == 0:
            if len(self.lengths) == 1:
                return part.windows(k)
            self.second, self.chosen, by_word = part.least(k, self.lengths[1])
            starts = np.unique(self.chosen)
            return starts, by_word[starts]
        flags = np.zeros(len(part.words) + 1, bool)
        flags[repeated] = True
        if level == 1:
            starts = self.second[flags[self.chosen]]
        else:
            # A window is a candidate if the two of the level before that cover it are repeated.
            starts = spread(part.word_at[:-1], part.counts(k))
            starts = starts[flags[starts] & flags[starts + k - self.lengths[level - 1]]]
        return starts, part.hashes(starts, k)

    def step(self, answers: list[dict[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """The starts repeated on the last answered level, and the distinct hashes to ask for
        on the next one (none after the last)."""
        repeated = None
        for level in range(len(self.lengths)):
            starts, hashed = self.candidates(level, repeated)
            distinct, inverse, counts = np.unique(hashed, return_inverse=True, return_counts=True)
            if level == len(answers):
                return starts, distinct
            flags = counts > 1
            home = distinct % np.uint64(self.buckets)
            for bucket, bits in answers[level].items():
                mine = np.flatnonzero(home == np.uint64(bucket))
                flags[mine] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=len(mine)).astype(bool)
            repeated = starts[flags[inverse]]
        return repeated, np.zeros(0, np.uint64)


def _answers(batch: pa.RecordBatch, at: int, levels: int) -> list[dict[int, bytes]]:
    out = []
    for level in range(levels):
        replies = batch[f"answers{level}"][at].as_py() or []
        out.append({r["bucket"]: r["bits"] for r in replies})
    return out


def _ask(stored: DataFrame, lengths: list[int], levels: int, buckets: int) -> DataFrame:
    """``(block, bucket, hashes)``: the distinct hashes of the next level's candidates."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                part = _open(batch["payload"][at].as_py(), batch["sizes"][at].as_py())
                _, distinct = Walk(part, lengths, buckets).step(_answers(batch, at, levels))
                home = distinct % np.uint64(buckets)
                order = np.argsort(home, kind="stable")
                used, first = np.unique(home[order], return_index=True)
                parts = np.split(distinct[order], first[1:]) if len(used) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch["block"][at].as_py()] * len(used), pa.string()), pa.array(used.astype(np.int64)),
                     pa.array([p.tobytes() for p in parts], pa.binary())],
                    names=["block", "bucket", "hashes"],
                )

    columns = ["block", "sizes", "payload", *[f"answers{i}" for i in range(levels)]]
    return ready(stored.select(*columns)).mapInArrow(ask, "block string, bucket long, hashes binary")


def _count(asked: DataFrame) -> DataFrame:
    """Which hashes of a bucket come from more than one block, as bits for each block."""

    def count(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(h, np.uint64) for h in table["hashes"].to_pylist()]
        every = np.sort(np.concatenate(parts))
        many = np.unique(every[1:][every[1:] == every[:-1]])
        bits = []
        for p in parts:
            at = np.searchsorted(many, p)
            found = many[np.minimum(at, len(many) - 1)] == p if len(many) else np.zeros(len(p), bool)
            bits.append(np.packbits(found).tobytes() if found.any() else None)
        out = pa.table({"block": table["block"], "bucket": table["bucket"], "bits": pa.array(bits, pa.binary())})
        return out.filter(out["bits"].is_valid())

    return ready(asked).groupBy("bucket").applyInArrow(count, "block string, bucket long, bits binary")


def _attach(stored: DataFrame, replies: DataFrame, level: int) -> DataFrame:
    gathered = replies.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias(f"answers{level}"))
    return stored.join(gathered, "block", "left")


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, with_text: bool = False,
) -> DataFrame:
    """Remove every word that lies in a window of ``length`` words that starts anywhere else too.

    One row per document: the key, n_words, n_removed, kept_sha256 (of the kept words joined by
    one space) and, if asked for, kept_text. Words are split at ASCII white space and compared
    unchanged; windows are judged on the input.

    Levels double in length. The first counts winnowed windows of about half the length (every
    longer window holds one, the same wherever it stands); the windows of the next level are
    only those around repeated ones, and so on up to ``length``; longer repeats are unions of
    such windows and need no level of their own. Hashes have 64 bits. Documents travel in
    compressed blocks; a block sends each distinct hash once, to the bucket that counts it,
    and gets bits back. So a passage in a third of all documents is counted by one entry per
    block of a megabyte, and a bucket is sized by the number of windows.

    Null and empty texts have no words. A document shorter than ``length`` loses nothing.
    Repeated rows are copies of each other. Null keys are kept; other columns play no part; an
    empty table gives no rows.
    """
    lengths = level_lengths(length)
    stored = write_out(blocks(docs, key, text))
    total = stored.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(24, -(-2 * total // BUCKET_BYTES))
    state = stored
    for level in range(len(lengths)):
        replies = _count(_ask(state, lengths, level, buckets))
        state = _attach(state, write_out(replies), level)

    kind = docs.schema[key].dataType
    fields = [T.StructField(key, kind), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    schema = T.StructType(fields + ([T.StructField("kept_text", T.StringType())] if with_text else []))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                part = _open(batch["payload"][at].as_py(), batch["sizes"][at].as_py())
                repeated, _ = Walk(part, lengths, buckets).step(_answers(batch, at, len(lengths)))
                change = np.zeros(len(part.words) + 1, np.int64)
                np.add.at(change, repeated, 1)
                np.subtract.at(change, repeated + length, 1)
                kept = np.cumsum(change)[:-1] == 0
                removed = np.concatenate(([0], np.cumsum(~kept)))[part.word_at]
                digests, rest = [], []
                for d in range(part.n):
                    words = part.text(d).split()
                    if removed[d + 1] > removed[d]:
                        words = compress(words, kept[part.word_at[d] : part.word_at[d + 1]].tolist())
                    joined = b" ".join(words)
                    digests.append(hashlib.sha256(joined).hexdigest())
                    if with_text:
                        rest.append(joined.decode())
                columns = [
                    batch["keys"].slice(at, 1).flatten(), pa.array(np.diff(part.word_at)), pa.array(np.diff(removed)),
                    pa.array(digests, pa.string()), *([pa.array(rest, pa.string())] if with_text else []),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    columns = ["block", "keys", "sizes", "payload", *[f"answers{i}" for i in range(len(lengths))]]
    return ready(state.select(*columns)).mapInArrow(finish, schema)
