"""Periodic runs of words: stretches that repeat with a short period, found on the diagonals of lags."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.workers import ready

LEAST, EXPONENT = 6, 4
SLICE_BYTES = 1 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def tiers(longest: int) -> Iterator[tuple[int, int, int]]:
    """``(least lag, greatest lag, context)`` covering the lags up to ``longest``.

    A run with a lag of a tier is at least four lags long, so each of its words but the first
    lag has the whole context of three least lags before it at some point. Two lags of a tier, or
    one of it and a smaller one, are together at most two more than the context. A context that
    recurs at both has their greatest common divisor as a period, and then the greater lag is not
    the least period of the run: only the nearest earlier occurrence of a context can be on the
    diagonal of a run.
    """
    least = 1
    while least <= longest:
        greatest = 3 * least // 2 + 1
        yield least, greatest, 3 * least
        least = greatest + 1


class Contexts:
    """Exact names for the stretches of words that occur more than once, by doubling."""

    def __init__(self, words: np.ndarray):
        self.names, self.size = words, 1

    def grow(self, size: int) -> None:
        """Name the stretches of the greatest power of two up to ``size``; -1 for those met once."""
        while self.size * 2 <= size:
            at, keys, order = self._pairs(self.size)
            equal = keys[order][1:] == keys[order][:-1]
            many = np.concatenate(([False], equal)) | np.concatenate((equal, [False])) if len(at) else np.zeros(0, bool)
            name = np.cumsum(np.concatenate(([True], ~equal))) if len(at) else np.zeros(0, np.int64)
            names = np.full(max(len(self.names) - self.size, 0), -1, np.int64)
            names[at[order[many]]] = name[many]
            self.names, self.size = names, self.size * 2

    def _pairs(self, apart: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts whose two named parts ``apart`` words from each other both recur, a number for
        the two, and the stable order of these numbers."""
        names, rest = self.names[: max(len(self.names) - apart, 0)], self.names[apart:]
        at = np.flatnonzero((names >= 0) & (rest >= 0))
        keys = (names[at] << 32) | rest[at]
        return at, keys, np.argsort(keys, kind="stable")

    def nearest(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of stretches of ``size`` words that occurred before, and how far before."""
        self.grow(size)
        at, keys, order = self._pairs(size - self.size)
        at = at[order]
        again = np.flatnonzero(keys[order][1:] == keys[order][:-1]) + 1
        starts, lags = at[again], at[again] - at[again - 1]
        by_start = np.argsort(starts)
        return starts[by_start], lags[by_start]

    @property
    def exhausted(self) -> bool:
        return not (self.names >= 0).any()


def diagonals(starts: np.ndarray, lags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The dynamic program along the diagonals: the match length of a lag at a word is one more
    than at the word before, where that had the same lag, and one elsewhere. A diagonal that the
    next word does not continue ends; ``(first, lag, match length)`` of each."""
    if not len(starts):
        return starts, lags, starts
    goes_on = (starts[1:] == starts[:-1] + 1) & (lags[1:] == lags[:-1])
    opens = np.concatenate(([0], np.flatnonzero(~goes_on) + 1))
    return starts[opens], lags[opens], np.diff(np.append(opens, len(starts)))


def runs(words: np.ndarray, longest: int, least: int = LEAST, exponent: int = EXPONENT) -> tuple[np.ndarray, ...]:
    """``(start, length, period)`` of all runs among ``words``, non-negative numbers that are equal
    exactly where two words of the same text are. A run has at least ``least`` words and
    ``exponent`` periods. In the order of start and period."""
    contexts, found = Contexts(words), [np.zeros((0, 3), np.int64)]
    for low, high, context in tiers(longest // exponent):
        starts, lags = contexts.nearest(context)
        inside = (lags >= low) & (lags <= high)
        first, lag, matched = diagonals(starts[inside], lags[inside])
        length = matched - 1 + context + lag
        kept = length >= np.maximum(least, exponent * lag)
        found.append(np.stack([first[kept] - lag[kept], length[kept], lag[kept]], axis=1))
        if contexts.exhausted:
            break
    every = np.concatenate(found)
    return tuple(every[np.lexsort((every[:, 2], every[:, 0]))].T)


def _numbered(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of the texts, a number for each (the place of its first occurrence in the text)
    and the bounds of the texts among them."""
    words, numbers, bounds = [], [], [0]
    for text in texts:
        own = text.split()
        first: dict[bytes, int] = {}
        numbers.extend(map(first.setdefault, own, count(len(numbers))))
        words.append(own)
        bounds.append(len(numbers))
    return words, np.array(numbers, np.int64), np.array(bounds, np.int64)


def _of_texts(texts: list[bytes], least: int, exponent: int) -> tuple[list[int], np.ndarray, list[int], pa.Array, list[bytes]]:
    """Number of words, runs and text without repetitions of every text."""
    words, numbers, bounds = _numbered(texts)
    sizes = np.diff(bounds)
    start, length, period = runs(numbers, int(sizes.max(initial=0)), least, exponent)
    doc = np.searchsorted(bounds, start, side="right") - 1
    change = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.subtract.at(change, start + length, 1)
    kept = np.cumsum(change)[:-1] == 0
    offsets = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
    struct = pa.StructArray.from_arrays([pa.array(start - bounds[doc]), pa.array(length), pa.array(period)], fields=list(RUN))
    held = np.add.reduceat(np.append(~kept, False), bounds[:-1]) if len(texts) else np.zeros(0, np.int64)
    held[sizes == 0] = 0
    rest = [
        b" ".join(compress(own, kept[at : at + len(own)].tolist()) if gone else own)
        for own, at, gone in zip(words, bounds[:-1].tolist(), held.tolist())
    ]
    return sizes, held, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct), rest


def find_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, exponent: int = EXPONENT,
) -> DataFrame:
    """The runs of every text: one row per document with the key, n_words, n_dropped, ``runs``
    (an array of start, length and period, by start and then period) and ``collapsed``, the words
    left when each run keeps its first period only, joined by one space.

    A run is a stretch of words with least period q (words q apart are equal) of at least
    ``least`` words and ``exponent`` periods that no neighbouring word continues; ``exponent`` is 4
    or more. Words are split at ASCII white space and compared unchanged.

    For each word, the lags to its earlier occurrences increment the match length of their
    diagonals, and a diagonal that ends long enough is a run. What makes that sparse: a lag needs
    three times as many matching words, so words are looked up with the words after them, the more
    the greater the lag (``tiers``), and of these occurrences only the nearest can lie on the
    diagonal of a least period. So a text of n words takes O(n log n) steps, also where one word
    makes up most of it. Names of contexts are exact; nothing is hashed.

    Documents are independent: no shuffle. They are worked off in slices of about a megabyte, a
    longer text on its own. Null and empty texts have no words and no runs; repeated rows and keys
    each give a row; null keys are kept; other columns play no part; an empty table gives no rows.
    """
    if exponent < 4:
        raise ValueError("the contexts are long enough for an exponent of at least 4")
    fields = [
        T.StructField(key, docs.schema[key].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_dropped", T.LongType()),
        T.StructField("runs", T._parse_datatype_string("array<struct<start:bigint,length:bigint,period:bigint>>")),
        T.StructField("collapsed", T.StringType()),
    ]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, size, first = [], 0, 0
            for at in range(batch.num_rows + 1):
                raw = (batch.column(1)[at].as_py() or "").encode() if at < batch.num_rows else b""
                if texts and (at == batch.num_rows or size + len(raw) > SLICE_BYTES):
                    sizes, dropped, found, rest = _of_texts(texts, least, exponent)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first, len(texts)), pa.array(sizes, pa.int64()), pa.array(dropped, pa.int64()), found,
                         pa.array(rest, pa.binary()).cast(pa.string())],
                        names=["key", "n_words", "n_dropped", "runs", "collapsed"],
                    )
                    texts, size, first = [], 0, at
                texts.append(raw)
                size += len(raw)

    schema = T.StructType([T.StructField("key", fields[0].dataType), *fields[1:]])
    return ready(docs.select(F.col(key), F.col(text))).mapInArrow(search, schema).withColumnRenamed("key", key)
