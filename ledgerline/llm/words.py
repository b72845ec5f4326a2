"""Words and their hashes, for whole Arrow batches at a time.

All functions work on the UTF-8 bytes of the texts as they lie in an Arrow array. A batch is
walked in slices of bounded size; a text longer than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 19

# Odd multipliers and increments of the published splitmix64 generator; fixed values.
GAMMA, MIX1, MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
BYTE_BASE, WORD_BASE = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
MASK = (1 << 64) - 1
PLACE = MOST_PLACED = (1 << 26) - 1  # word numbers that fit beside a hash


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * U64(MIX1)
    x = (x ^ (x >> U64(27))) * U64(MIX2)
    return x ^ (x >> U64(31))


def separators(kept: list[tuple[int, int]] | None = None, dropped: list[int] | None = None) -> np.ndarray:
    """256 flags: the bytes between words, from the byte ranges kept or the bytes dropped."""
    flags = np.zeros(256, bool)
    if kept is not None:
        flags[:] = True
        for low, high in kept:
            flags[low : high + 1] = False
    flags[dropped or []] = True
    return flags


SPACES = separators(dropped=[0x20, *range(0x09, 0x0E)])
# Words of digits, letters and everything beyond ASCII, once A-Z are lower-cased.
NON_ALNUM = separators(kept=[(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])


@lru_cache(maxsize=2)
def _byte_values(lower: bool) -> np.ndarray:
    values = mix((np.arange(256, dtype=U64) + U64(1)) * U64(GAMMA))
    if lower:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, at least ``n`` of each."""
    if base not in _tables or len(_tables[base][0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        up, down = np.full(size, base, U64), np.full(size, pow(base, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        pair = np.cumprod(up), np.cumprod(down)
        if size > 1 << 20:
            return pair
        _tables[base] = pair
    return _tables[base]


def _text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


class Slice:
    """Consecutive texts of a batch with the bounds and hashes of their words."""

    def __init__(self, first: int, raw: np.ndarray, at: np.ndarray, between: np.ndarray, lower: bool):
        self.first, self.raw, self.at, self.n = first, raw, at, len(at) - 1
        inside = ~between[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[at] = True
        self.starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
        self.ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
        # word_at[d] .. word_at[d + 1]: the words of text d
        self.word_at = np.searchsorted(self.starts, at)
        up, down = _powers(BYTE_BASE, len(raw) + 1)
        run = np.zeros(len(raw) + 1, U64)
        np.cumsum(_byte_values(lower)[raw] * up[: len(raw)], out=run[1:])
        lengths = (self.ends - self.starts).astype(U64)
        self.words = mix((run[self.ends] - run[self.starts]) * down[self.starts] + lengths * U64(GAMMA))
        self._run: np.ndarray | None = None

    @property
    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.word_at))

    def counts(self, k: int) -> np.ndarray:
        """Windows of ``k`` words in each text."""
        return np.maximum(np.diff(self.word_at) - k + 1, 0)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts (word numbers) and hashes of all windows of ``k`` words inside one text."""
        starts = spread(self.word_at[:-1], self.counts(k))
        return starts, self.hashes(starts, k)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows of ``k`` words, or of all words where a text has fewer, and
        how many each text has."""
        words = np.diff(self.word_at)
        counts = np.where(words >= k, words - k + 1, words > 0)
        starts = spread(self.word_at[:-1], counts)
        return self.hashes(starts, np.repeat(np.minimum(words, k), counts)), counts

    def least(self, k: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Winnowing: ``(starts, chosen, hashes)`` with, for each window of ``span`` words, the
        start of the window of ``k`` words with the least hash in it (the first of equals).
        ``hashes`` has the hash of every start of ``k`` words, by word number."""
        n = len(self.words)
        at, hashed = self.windows(k)
        by_word = np.zeros(n, U64)
        by_word[at] = hashed
        starts = spread(self.word_at[:-1], self.counts(span))
        if n > MOST_PLACED:
            return starts, self._least_apart(at, hashed, span - k + 1)[starts], by_word
        keyed = np.full(n, MASK, U64)
        keyed[at] = (hashed & U64(MASK ^ PLACE)) | at.astype(U64)
        reach, width = 1, span - k + 1
        while reach < width:
            step = min(reach, width - reach)
            keyed[: n - step] = np.minimum(keyed[: n - step], keyed[step:]) if n > step else keyed[: n - step]
            reach += step
        return starts, (keyed[starts] & U64(PLACE)).astype(np.int64), by_word

    def _least_apart(self, at: np.ndarray, hashed: np.ndarray, width: int) -> np.ndarray:
        """The same choice for a text of more words than have a place beside the hash."""
        n = len(self.words)
        least, where = np.full(n, MASK, U64), np.arange(n)
        least[at] = hashed & U64(MASK ^ PLACE)
        reach = 1
        while reach < width:
            step = min(reach, width - reach)
            later = np.flatnonzero(least[step:] < least[: n - step])
            moved = least[later + step], where[later + step]
            least[later], where[later] = moved
            reach += step
        return where

    def hashes(self, starts: np.ndarray, k: int | np.ndarray) -> np.ndarray:
        """Hashes of the windows of ``k`` words at these word numbers."""
        up, down = _powers(WORD_BASE, len(self.words) + 1)
        if self._run is None:
            self._run = np.zeros(len(self.words) + 1, U64)
            np.cumsum(self.words * up[: len(self.words)], out=self._run[1:])
        size = np.asarray(k, dtype=U64) * U64(MIX2)
        return mix((self._run[starts + k] - self._run[starts]) * down[starts] + size)

    def text(self, d: int) -> bytes:
        return self.raw[self.at[d] : self.at[d + 1]].tobytes()

    def between(self, first: int, last: int) -> bytes:
        """The bytes from word ``first`` to the end of word ``last``."""
        return self.raw[self.starts[first] : self.ends[last]].tobytes()


def slices(column: pa.Array, between: np.ndarray, lower: bool, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a text column into slices of about ``limit`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw, at = _text_buffers(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Slice(first, raw[at[first] : at[last]], at[first : last + 1] - at[first], between, lower)
        first = last


def spread(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``first, first + 1, ...`` for each pair, ``count`` numbers each."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(firsts - (ends - counts), counts)
