"""Token ids of whole texts by a public tokenizer file, word by word where that is exact."""

from __future__ import annotations

import hashlib
import os
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerline.llm.words import spread

SLICE_BYTES = 2 << 20
MEMO_BYTES = 64 << 20
LONGEST_MEMO = 64
_MARKS = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'")


def file_digest(path: str) -> str:
    """The version of a tokenizer: a digest of its file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it is
    visible, else the next one free from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(others)) for b in range(256)]


def _slices(column: pa.Array) -> Iterator[pa.Array]:
    """Consecutive texts of about ``SLICE_BYTES`` together; a longer one is alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(column):
        before = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, before + SLICE_BYTES, side="right")), first + 1)
        yield column.slice(first, last - first)
        first = last


class WholeTexts:
    """Ids straight from the library, one whole text after another."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            self._encode = sentencepiece.SentencePieceProcessor(model_file=path).encode
        else:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
            self._encode = lambda text: library.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        return array("I", self._encode(text)).tobytes()

    def batches(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For slices of the column, the ids of its texts in a row and how many each has."""
        for part in _slices(column):
            found = [self.ids(t.as_py() or "") for t in part]
            yield np.frombuffer(b"".join(found), np.uint32), np.array([len(f) // 4 for f in found], np.int64)

    def forget(self) -> None:
        """Nothing is kept."""


class WordMemo:
    """Ids of tokenizers that drop white space, lower-case and never look across it.

    There the ids of a text are those of its chunks between ASCII white space in a row, so each
    distinct chunk of a slice is looked up once, and its ids are put in place for all its
    occurrences. A chunk is lower-cased and its closing marks are cut off where that is exact;
    what is left is kept in a memo, which is emptied as soon as it takes ``MEMO_BYTES``. Long
    chunks are never kept.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        self._model = self._library.model
        # Latin letters that are their own lower case and composed: words of them are one piece.
        letters = [chr(c) for c in (*range(0x61, 0x7B), *range(0xDF, 0x250)) if chr(c).isalpha() and chr(c).lower() == chr(c)]
        capitals = [chr(c) for c in range(0x41, 0x250) if len(chr(c).lower()) == 1 and chr(c).lower() in letters]
        self._latin = re.compile(f"[{''.join(letters)}]+")
        self._cased = re.compile(f"[{''.join(dict.fromkeys(letters + capitals))}]+")
        self._plain = frozenset([*letters, *capitals, *"0123456789"])
        self._letters = _byte_letters()
        self._memo: dict[str, bytes] = {}
        self.size = 0

    def forget(self) -> None:
        """Empty the memo; at the end of a task, since workers live on."""
        self._memo.clear()
        self.size = 0

    def _encode(self, stem: str) -> bytes:
        if self._latin.fullmatch(stem):  # neither normalised nor split
            letters = stem if stem.isascii() else "".join([self._letters[b] for b in stem.encode()])
            return array("I", [t.id for t in self._model.tokenize(letters)]).tobytes()
        return array("I", self._library.encode(stem, add_special_tokens=False).ids).tobytes()

    def _stem(self, stem: str) -> bytes:
        ids = self._memo.get(stem)
        if ids is None:
            ids = self._encode(stem)
            if len(stem) <= LONGEST_MEMO:
                if self.size > MEMO_BYTES:
                    self.forget()
                self._memo[stem] = ids
                self.size += sys.getsizeof(stem) + sys.getsizeof(ids) + 100  # and its share of the table
        return ids

    def _chunk(self, chunk: str) -> bytes:
        if "<|" in chunk:  # may spell a special token, whose case counts
            return self._encode(chunk)
        # A closing run of ASCII marks after a letter or digit is a piece of its own. An apostrophe
        # is not cut off, because it may begin a contraction.
        stem, tail = chunk.rstrip(_MARKS), b""
        if len(stem) == len(chunk) or not stem or stem[-1] not in self._plain:
            stem = chunk
        else:
            tail = self._stem(chunk[len(stem) :])
        if stem.isascii() or self._cased.fullmatch(stem):
            stem = stem.lower()
        return self._stem(stem) + tail

    def batches(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For slices of the column, the ids of its texts in a row and how many each has."""
        for part in _slices(column):
            chunks = pc.ascii_split_whitespace(pc.fill_null(part, ""))
            bounds = chunks.offsets.to_numpy().astype(np.int64)
            coded = chunks.flatten().dictionary_encode()
            known = self._memo.get
            # No chunk holds a space, so the distinct ones are taken out in one string.
            listed = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), " ")[0].as_py().split(" ") if len(coded.dictionary) else []
            found = [known(c) or (self._chunk(c) if c else b"") for c in listed]
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            ids, firsts = np.frombuffer(b"".join(found), np.uint32), np.cumsum(sizes) - sizes
            codes = coded.indices.to_numpy()
            each = sizes[codes]
            sums = np.concatenate(([0], np.cumsum(each)))
            yield ids[spread(firsts[codes], each)], np.diff(sums[bounds - bounds[0]])

    def ids(self, text: str) -> bytes:
        return b"".join(found.tobytes() for found, _ in self.batches(pa.array([text], pa.string())))


@lru_cache(maxsize=2)
def encoder(path: str, word_wise: bool) -> WordMemo | WholeTexts:
    """One encoder per Python worker. ``word_wise`` only for tokenizers as WordMemo wants them."""
    return WordMemo(path) if word_wise else WholeTexts(path)
