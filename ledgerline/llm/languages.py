"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

import pickle
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.workers import parts, ready, release

UNKNOWN = "und"
HIDDEN = 8
LONGEST = 24  # bytes of a sequence; longer words are cut
SAMPLE_TEXTS = 400  # training texts of a language, at most
EXCERPT = 600  # characters of each, from a place chosen by a hash
STEPS, BATCH, RATE, SEED = 1500, 256, 0.01, 4
# Of the held-out labelled texts named as one language, this share scores below what a text needs.
# Scores of about so many texts of each label are looked at; fewer than the least say nothing.
QUANTILE, SCORED_TEXTS, LEAST_TEXTS = 0.01, 1000, 100
MEMO_BYTES = 48 << 20
CHUNK_WORDS = 1 << 16
# Marks that close a word say nothing about its language.
_CLOSING = re.compile(rb"[.,;:!?]+(?=[ \n]|\Z)")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def initial(classes: int, hidden: int = HIDDEN, seed: int = SEED) -> dict[str, np.ndarray]:
    """``E``: what a byte adds to the three gates; ``U``: what the state adds; one of each per
    direction. ``W`` and ``b`` read both states."""
    rng = np.random.default_rng(seed)
    p = {}
    for side in "fb":
        p[f"E{side}"] = rng.normal(0, 0.3, (256, 3 * hidden))
        p[f"U{side}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
    p["W"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, classes))
    p["b"] = np.zeros(classes)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _states(x: np.ndarray, E: np.ndarray, U: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States after each byte of equally long sequences ``x`` (rows), along axis 1."""
    hidden = U.shape[0]
    h = np.zeros((len(x), hidden), np.float32)
    out = np.empty((len(x), x.shape[1], hidden), np.float32)
    for t in range(x.shape[1]):
        e = E[x[:, t]]
        gates = _sigmoid(e[:, : 2 * hidden] + h @ U[:, : 2 * hidden])
        z, r = gates[:, :hidden], gates[:, hidden:]
        n = np.tanh(e[:, 2 * hidden :] + (r * h) @ U[:, 2 * hidden :])
        if keep is not None:
            keep.append((h, z, r, n))
        h = n + z * (h - n)
        out[:, t] = h
    return out


def probabilities(x: np.ndarray, p: dict[str, np.ndarray]) -> np.ndarray:
    """The distribution over languages at every position of every sequence."""
    forward = _states(x, p["Ef"], p["Uf"])
    backward = _states(x[:, ::-1], p["Eb"], p["Ub"])[:, ::-1]
    scores = np.concatenate((forward, backward), axis=2) @ p["W"] + p["b"]
    scores = np.exp(scores - scores.max(axis=2, keepdims=True))
    return scores / scores.sum(axis=2, keepdims=True)


def _through_time(x: np.ndarray, above: np.ndarray, keep: list, U: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of ``E`` and ``U`` from those of the states: backpropagation through time."""
    hidden = U.shape[0]
    dE, dU, dh = np.zeros((256, 3 * hidden), np.float32), np.zeros_like(U), np.zeros((len(x), hidden), np.float32)
    for t in range(x.shape[1] - 1, -1, -1):
        h, z, r, n = keep[t]
        dh = dh + above[:, t]
        da_n = dh * (1 - z) * (1 - n * n)
        da_z = dh * (h - n) * z * (1 - z)
        drh = da_n @ U[:, 2 * hidden :].T
        da_r = drh * h * r * (1 - r)
        gates = np.concatenate((da_z, da_r), axis=1)
        dU[:, : 2 * hidden] += h.T @ gates
        dU[:, 2 * hidden :] += (r * h).T @ da_n
        np.add.at(dE, x[:, t], np.concatenate((gates, da_n), axis=1))
        dh = dh * z + drh * r + gates @ U[:, : 2 * hidden].T
    return dE, dU


def gradients(x: np.ndarray, y: np.ndarray, p: dict[str, np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over all positions, and its gradients."""
    keep_f: list = []
    keep_b: list = []
    forward = _states(x, p["Ef"], p["Uf"], keep_f)
    backward = _states(x[:, ::-1], p["Eb"], p["Ub"], keep_b)
    both = np.concatenate((forward, backward[:, ::-1]), axis=2)
    scores = both @ p["W"] + p["b"]
    scores = np.exp(scores - scores.max(axis=2, keepdims=True))
    probs = scores / scores.sum(axis=2, keepdims=True)
    rows = np.arange(len(x))
    loss = float(-np.log(probs[rows, :, y] + 1e-12).mean())
    delta = probs.copy()
    delta[rows, :, y] -= 1
    delta /= x.size
    flat = delta.reshape(-1, delta.shape[2])
    above = delta @ p["W"].T
    hidden = p["Uf"].shape[0]
    g = {"W": both.reshape(-1, both.shape[2]).T @ flat, "b": flat.sum(axis=0)}
    g["Ef"], g["Uf"] = _through_time(x, above[:, :, :hidden], keep_f, p["Uf"])
    g["Eb"], g["Ub"] = _through_time(x[:, ::-1], above[:, ::-1, hidden:], keep_b, p["Ub"])
    return loss, g


def sequences(word: bytes) -> list[bytes]:
    """A word between two spaces, in pieces of at most ``LONGEST`` bytes."""
    word = b" " + word + b" "
    return [word[i : i + LONGEST] for i in range(0, len(word), LONGEST)]


def train(texts: list[str], labels: list[int], classes: int, steps: int = STEPS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Fit the network with Adam on sequences of one length at a time, languages evenly."""
    by_length: dict[int, dict[int, list[bytes]]] = {}
    for text, label in zip(texts, labels):
        for word in _CLOSING.sub(b" ", text.encode().lower()).split():
            for piece in sequences(word):
                by_length.setdefault(len(piece), {}).setdefault(label, []).append(piece)
    p = initial(classes, seed=seed)
    if not by_length:
        return p
    rng = np.random.default_rng(seed)
    lengths = sorted(by_length)
    weight = np.array([sum(len(v) for v in by_length[n].values()) * n for n in lengths], float)
    arrays = {n: {c: np.frombuffer(b"".join(v), np.uint8).reshape(-1, n) for c, v in by_length[n].items()} for n in lengths}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        pools = arrays[lengths[rng.choice(len(lengths), p=weight / weight.sum())]]
        kinds = sorted(pools)
        each = max(1, BATCH // len(kinds))
        x = np.concatenate([pools[c][rng.integers(0, len(pools[c]), each)] for c in kinds])
        y = np.repeat(kinds, each)
        _, g = gradients(x, y, p)
        rate = RATE * (1 - 0.9 * step / steps)
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return p


@dataclass
class Model:
    languages: list[str]
    weights: dict[str, np.ndarray]


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE_TEXTS) -> Model:
    """Learn from labelled rows that are not held out: about ``sample`` excerpts of each
    language, chosen by a hash of the key, however many rows there are."""
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(key)))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model([], {})
    draw = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30))
    chosen = F.lit(False)
    for name, n in counts.items():
        chosen = chosen | ((F.col(lang) == name) & (draw < int(min(1.0, sample / n) * (1 << 30))))
    room = F.greatest(F.char_length(text) - EXCERPT, F.lit(0)) + 1
    place = (F.pmod(F.xxhash64(F.col(key), F.lit(1)), room) + 1).cast("int")
    rows = labelled.filter(chosen).select(
        F.col(lang).alias("lang"), draw.alias("draw"), F.substring(F.col(text), place, F.lit(EXCERPT)).alias("text")
    )
    names = sorted(counts)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((r["lang"], r["draw"], r["text"]) for batch in batches for r in batch.to_pylist())
        weights = train([t for _, _, t in found], [names.index(n) for n, _, _ in found], len(names))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(weights)])], names=["weights"])

    # The sample is bounded, so one task may learn from it; a lost one learns the same again.
    learned = ready(rows.repartition(1)).mapInArrow(learn, "weights binary").first()
    return Model(names, pickle.loads(learned["weights"]))


def held_out(key) -> F.Column:
    """A fifth of the keys is never learned from; rows without a key neither."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(5)) == 0


class Pooler:
    """Sums of position probabilities of words, kept in a memo of at most about ``MEMO_BYTES``.

    The state starts anew at every word, so the positions of a word have the same distributions
    wherever it stands; a text's are those of its words.
    """

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.sums = np.zeros((1024, len(self.model.languages) + 1))
        self.size = 0

    def _learn(self, words: list[bytes]) -> None:
        by_length: dict[int, list[tuple[int, bytes]]] = {}
        while len(self.memo) + len(words) > len(self.sums):
            self.sums = np.concatenate((self.sums, np.zeros_like(self.sums)))
        for word in words:
            at = self.memo[word] = len(self.memo)
            self.sums[at] = 0
            self.size += sys.getsizeof(word) + 100 + 8 * self.sums.shape[1]
            for piece in sequences(word):
                by_length.setdefault(len(piece), []).append((at, piece))
        for n, found in by_length.items():
            for first in range(0, len(found), 1024):
                part = found[first : first + 1024]
                x = np.frombuffer(b"".join(piece for _, piece in part), np.uint8).reshape(-1, n)
                pooled = probabilities(x, self.model.weights).sum(axis=1)
                np.add.at(self.sums, [at for at, _ in part], np.column_stack((pooled, np.full(len(part), n))))

    def pool(self, texts: list[bytes]) -> list[np.ndarray]:
        """The mean distribution over all positions of each text, some thousand words at a time."""
        totals = np.zeros((len(texts), self.sums.shape[1]))
        parts, of, n = [], [], 0
        for at, text in enumerate(texts):
            own = _CLOSING.sub(b" ", text.lower()).split()
            for first in range(0, len(own), CHUNK_WORDS):
                parts.append(own[first : first + CHUNK_WORDS])
                of.append(at)
                n += len(parts[-1])
                if n >= CHUNK_WORDS:
                    self._add(parts, of, totals)
                    parts, of, n = [], [], 0
        if parts:
            self._add(parts, of, totals)
        return list(totals[:, :-1] / np.maximum(totals[:, -1:], 1))

    def _add(self, parts: list[list[bytes]], of: list[int], totals: np.ndarray) -> None:
        if self.size > MEMO_BYTES:
            self.forget()
        new = {w: None for w in chain.from_iterable(parts) if w not in self.memo}
        if new:
            self._learn(list(new))
        sizes = np.array([len(p) for p in parts])
        places = np.fromiter(map(self.memo.__getitem__, chain.from_iterable(parts)), np.int64, sizes.sum())
        np.add.at(totals, of, np.add.reduceat(self.sums[places], np.cumsum(sizes) - sizes, axis=0))


_poolers: dict[int, Pooler] = {}


def _pooler(model: Model) -> Pooler:
    """The pooler of this worker; a new model takes the place of the one before."""
    if id(model) not in _poolers:
        _poolers.clear()
        _poolers[id(model)] = Pooler(model)
    return _poolers[id(model)]


def _pooled(model: Model, column: pa.Array) -> Iterator[np.ndarray | None]:
    """The distribution over languages of every text; None where there is none to be had."""
    pooler = _pooler(model)
    for first in range(0, len(column), 64):
        part = [t.as_py() for t in column.slice(first, 64)]
        fine = [bool(t) and bool(model.languages) and _has_letter(t) for t in part]
        found = iter(pooler.pool([t.encode() for t, ok in zip(part, fine) if ok]))
        yield from (next(found) if ok else None for ok in fine)


def _has_letter(text: str) -> bool:
    raw = text.encode()
    return len(raw.translate(None, _LETTERS)) < len(raw) or (not text.isascii() and any(c.isalpha() for c in text))


_LETTERS = bytes([*range(65, 91), *range(97, 123)])


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, lang_pred and score, from the text alone.

    The network labels every byte of every word; the document's probabilities are the mean over
    all positions, the largest is the prediction and the score. Texts that are null or without
    a letter, and all texts if nothing was learned, are ``und`` with score 0. Repeated rows each
    give a row; null keys are kept; other columns play no part; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand weights
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    ])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            names, scores = [], []
            for probs in _pooled(model, batch.column(1)):
                best = None if probs is None else int(probs.argmax())
                names.append(UNKNOWN if best is None else model.languages[best])
                scores.append(0.0 if best is None else round(float(min(probs[best], 1.0)), 6))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names)
        _poolers.clear()  # workers live on
        release()

    return ready(docs.select(key, text)).mapInArrow(label, schema)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE_TEXTS) -> DataFrame:
    """Fit on the labelled rows of ``docs`` that are not held out, and predict all rows:
    the key, held_out, lang_pred and score. Cases are those of ``predict``."""
    model = fit(docs, key, text, lang, sample)
    return predict(docs, model, key, text).select(key, held_out(F.col(key)).alias("held_out"), "lang_pred", "score")


def least_scores(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SCORED_TEXTS) -> dict[str, float]:
    """Per predicted language the score that all but ``QUANTILE`` of the held-out labelled texts
    named so reach, so the number of languages and how close they are is taken into account. About
    ``sample`` texts of each label are looked at, chosen by a hash of the key. A language with
    fewer than ``LEAST_TEXTS`` of them takes the quantile of all, and with too few in all there
    are no least scores."""
    labelled = docs.filter(F.col(lang).isin(model.languages) & F.col(text).isNotNull() & F.col(key).isNotNull() & held_out(F.col(key)))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if sum(counts.values()) < LEAST_TEXTS:
        return {}
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(2)), F.lit(1 << 30))
    chosen = F.lit(False)
    for name, n in counts.items():
        chosen = chosen | ((F.col(lang) == name) & (draw < int(min(1.0, sample / n) * (1 << 30))))
    scored = predict(labelled.filter(chosen), model, key, text).filter(F.col("lang_pred") != UNKNOWN)
    found = scored.rollup("lang_pred").agg(F.count("*").alias("n"), F.percentile_approx("score", QUANTILE).alias("least")).collect()
    enough = {r["lang_pred"]: r["least"] for r in found if r["n"] >= LEAST_TEXTS}
    return {name: enough.get(name, enough[None]) for name in model.languages} if None in enough else {}


def keep_identified(docs: DataFrame, model: Model, text: str = "text", least: dict[str, float] | None = None) -> DataFrame:
    """``docs`` without the rows that have no language or score below ``least`` of theirs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bounds = np.array([(least or {}).get(name, 0.0) for name in model.languages])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                # Rounded as scores are, so that a text at the bound stays.
                mask = [
                    probs is not None and round(float(min(probs.max(), 1.0)), 6) >= bounds[probs.argmax()] for probs in _pooled(shared.value, part[text])
                ]
                yield part.filter(pa.array(mask, pa.bool_()))
        _poolers.clear()
        release()

    return ready(docs).mapInArrow(keep, docs.schema)
