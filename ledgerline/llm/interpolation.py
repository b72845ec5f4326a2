"""Language-model scores by deleted interpolation of n-gram estimates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.words import MIX1, MIX2, SPACES, U64, mix, slices
from ledgerline.llm.workers import ready
from ledgerline.session import write_out

ORDER = 3
FOLDS = 10
BLOCK_BYTES, BUCKET_BYTES = 4 << 20, 4 << 20
ROUNDS, CLOSE = 20, 0.001  # passes of expectation-maximisation at most, and the change that ends it
CLASSES = 64  # a context seen c times is in class bit_length(c)
# What a document does: only scored, counted and used for the weights, or only counted.
HELD_OUT, DELETED, RETAINED = 0, 1, 2
END, BEGIN = U64(0x454E44), U64(0x424547)
# Hashes of words have 62 bits, those of longer n-grams 54.
WIDE, NARROW = ~U64(0), ~U64(0xFF)


def blocks(docs: DataFrame, key: str, text: str, folds: int = FOLDS) -> DataFrame:
    """Documents packed into blocks of one role: role, keys, byte lengths, compressed texts."""
    fold = F.crc32(F.col(key).cast("string"))
    role = F.when(fold % folds == 0, HELD_OUT).when(F.floor(fold / folds) % folds == 0, DELETED).otherwise(RETAINED)
    schema = T.StructType([
        T.StructField("role", T.IntegerType()), T.StructField("keys", T.ArrayType(docs.schema[key].dataType)),
        T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType()), T.StructField("bytes", T.LongType()),
    ])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        held: dict[int, tuple[list, list, list]] = {}

        def block(part: int) -> pa.RecordBatch:
            keys, texts, size = held.pop(part)
            columns = [
                pa.array([part], pa.int32()), pa.array([keys], pa.list_(kind)), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                pa.array([packer.compress(b"".join(texts))], pa.binary()), pa.array(size, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            kind = batch.column(0).type
            for k, t, part in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                raw = (t.as_py() or "").encode()
                if part in held and held[part][2][0] + len(raw) > BLOCK_BYTES:
                    yield block(part)
                keys, texts, size = held.setdefault(part, ([], [], [0]))
                keys.append(k)
                texts.append(raw)
                size[0] += len(raw)
        for part in list(held):
            yield block(part)

    numbered = ready(docs.select(F.col(key), F.col(text), role)).mapInArrow(build, schema)
    return numbered.withColumn("block", F.monotonically_increasing_id())


class Tokens:
    """The tokens of a block: the words of every text in lower case and one end."""

    def __init__(self, payload: bytes, sizes: list[int]):
        raw = zstandard.ZstdDecompressor().decompress(payload) if sum(sizes) else b""
        offsets = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64)))).astype(np.int32)
        column = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        words, counts = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        for part in slices(column, SPACES, lower=True):
            words.append(part.words)
            counts.append(np.diff(part.word_at))
        self.bounds = np.concatenate(([0], np.cumsum(np.concatenate(counts) + 1)))
        last = np.zeros(self.bounds[-1], bool)
        last[self.bounds[1:] - 1] = True
        self.own = np.empty(len(last), U64)
        self.own[last] = END
        self.own[~last] = np.concatenate(words)

    def before(self, values: np.ndarray, first) -> np.ndarray:
        """The value of the token before, ``first`` at the first token of a text."""
        shifted = np.empty_like(values)
        shifted[1:] = values[:-1]
        shifted[self.bounds[:-1]] = first
        return shifted

    def grams(self) -> np.ndarray:
        """Hashes of the n-grams that end at each token, those of one order after the other. The
        order is in the first two bits. Before the first token stand begins."""
        summed, previous, parts = np.zeros(len(self.own), U64), self.own, []
        for n, factor in zip(range(1, ORDER + 1), (1, MIX1, MIX2)):
            summed = summed + previous * U64(factor)
            parts.append((((mix(summed + U64(n)) >> U64(2)) | (U64(n) << U64(62))) & (WIDE if n == 1 else NARROW)))
            previous = self.before(previous, BEGIN)
        return np.concatenate(parts)


def grouped(values: np.ndarray, kind: str | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values in ascending order, where each value stands among them, and the order
    that sorts the values."""
    order = np.argsort(values, kind=kind)
    ranked = values[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))[: len(values)]
    places = np.empty(len(values), np.int64)
    places[order] = np.cumsum(new) - 1
    return ranked[new], places, order


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending numbers as the bytes of their differences, most significant planes apart."""
    steps = np.diff(values, prepend=U64(0))
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack_sorted(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).view(U64).ravel(), dtype=U64)


def pack_counts(values: np.ndarray) -> bytes:
    """Counts as their bytes, plane by plane, as many as the greatest needs."""
    planes = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    kept = values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :planes]
    return bytes([planes]) + zstandard.ZstdCompressor(level=1).compress(kept.T.tobytes())


def unpack_counts(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), np.uint8).reshape(packed[0], -1)
    whole = np.zeros((planes.shape[1], 8), np.uint8)
    whole[:, : packed[0]] = planes.T
    return whole.view("<i8").ravel()


def _ask(stored: DataFrame, buckets: int) -> DataFrame:
    """The distinct n-grams of every block with their counts, dealt by ranges of the hash."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                grams = Tokens(batch["payload"][at].as_py(), batch["sizes"][at].as_py()).grams()
                distinct, counts = np.unique(grams, return_counts=True)
                home = ((distinct >> U64(32)) * U64(buckets)) >> U64(32)
                used, first = np.unique(home, return_index=True)
                ends = np.append(first[1:], len(distinct))
                for bucket, low, high in zip(used.tolist(), first, ends):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], t) for x, t in (
                            (bucket, pa.int64()), (batch["block"][at].as_py(), pa.int64()), (batch["role"][at].as_py(), pa.int32()),
                            (pack_sorted(distinct[low:high]), pa.binary()), (pack_counts(counts[low:high]), pa.binary()),
                        )],
                        names=["bucket", "block", "role", "grams", "counts"],
                    )

    columns = stored.select("block", "role", "sizes", "payload")
    return ready(columns).mapInArrow(ask, "bucket long, block long, role int, grams binary, counts binary")


def _count(asked: DataFrame) -> DataFrame:
    """The counts of all training documents for the n-grams each block asked about and, for blocks
    of deleted documents, the counts of those alone. ``tokens``, ``deleted_tokens`` and ``words`` are sums over the bucket,
    in one row of it."""
    schema = "bucket long, block long, role int, counted binary, deleted binary, tokens long, deleted_tokens long, words long"

    def count(table: pa.Table) -> pa.Table:
        parts = [unpack_sorted(g) for g in table["grams"].to_pylist()]
        roles = table["role"].to_pylist()
        every, places, _ = grouped(np.concatenate(parts), "stable")  # which makes use of sorted parts
        places = np.split(places, np.cumsum([len(p) for p in parts])[:-1])
        counted, deleted = np.zeros(len(every), np.int64), np.zeros(len(every), np.int64)
        for place, role, packed in zip(places, roles, table["counts"].to_pylist()):
            if role != HELD_OUT:
                own = unpack_counts(packed)
                counted[place] += own
                if role == DELETED:
                    deleted[place] += own
        single = every >> U64(62) == U64(1)
        sums = [int(counted[single].sum()), int(deleted[single].sum()), int((counted[single] > 0).sum())]
        once = [[s, *[0] * (len(parts) - 1)] for s in sums]
        return pa.table([
            table["bucket"], table["block"], table["role"], pa.array([pack_counts(counted[p]) for p in places], pa.binary()),
            pa.array([pack_counts(deleted[p]) if r == DELETED else None for p, r in zip(places, roles)], pa.binary()), *[pa.array(s, pa.int64()) for s in once],
        ], names=["bucket", "block", "role", "counted", "deleted", "tokens", "deleted_tokens", "words"])

    return ready(asked).groupBy("bucket").applyInArrow(count, schema)


def _answered(stored: DataFrame, replies: DataFrame) -> DataFrame:
    gathered = replies.groupBy("block").agg(F.collect_list(F.struct("bucket", "counted", "deleted")).alias("replies"))
    return stored.join(gathered, "block")


def _counts_of(batch: pa.RecordBatch, at: int, name: str) -> tuple[Tokens, list[np.ndarray]]:
    """The tokens of a block and the counts of the n-grams that end at each, by order."""
    tokens = Tokens(batch["payload"][at].as_py(), batch["sizes"][at].as_py())
    _, inverse, _ = grouped(tokens.grams())
    replies = sorted(batch["replies"][at].as_py(), key=lambda r: r["bucket"])
    counted = np.concatenate([unpack_counts(r["counted"]) for r in replies])
    if name == "retained":
        counted = counted - np.concatenate([unpack_counts(r["deleted"]) for r in replies])
    return tokens, np.split(counted[inverse], ORDER)


def estimates(tokens: Tokens, counts: list[np.ndarray], texts: int, total: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Maximum-likelihood estimates of the orders from 1 on (0 where the context was never seen) and
    the frequency classes of their contexts. The context of an n-gram is counted as the shorter
    one that ends a token before, since every word has a successor; at the start of a text it
    consists of begins, met once in each of the ``texts`` counted."""
    ratios, classes = [], []
    context = np.full(len(tokens.own), total, np.int64)
    for n in range(ORDER):
        if n:
            context = tokens.before(counts[n - 1], texts)
        ratios.append(counts[n] / np.maximum(context, 1))
        classes.append(np.frexp(context.astype(float))[1])
    return ratios, classes


def mixture(ratios: list[np.ndarray], classes: list[np.ndarray], weights: np.ndarray, floor: float) -> list[np.ndarray]:
    """The interpolated probabilities from order 0 (every word alike) up to the highest."""
    mixed = [np.full(len(ratios[0]), floor)]
    for n, (ratio, kind) in enumerate(zip(ratios, classes)):
        weight = weights[n][kind]
        mixed.append(weight * ratio + (1 - weight) * mixed[-1])
    return mixed


def _events(answered: DataFrame, texts: int, total: int) -> DataFrame:
    """What the weights are learned from: estimates of the retained part at the tokens of the
    deleted part, a row per block."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ratios, classes = estimates(*_counts_of(batch, at, "retained"), texts, total)
                columns = [r.astype(np.float32).tobytes() for r in ratios] + [c.astype(np.uint8).tobytes() for c in classes]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=names)

    names = [f"ratio{n}" for n in range(ORDER)] + [f"class{n}" for n in range(ORDER)]
    columns = answered.select("sizes", "payload", "replies")
    return ready(columns).mapInArrow(collect, ", ".join(f"{n} binary" for n in names))


def expectation(ratios: list[np.ndarray], classes: list[np.ndarray], weights: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Expected uses of each order's own estimate by class, and of that and all lower orders."""
    mixed = mixture(ratios, classes, weights, floor)
    own, reached = np.zeros((ORDER, CLASSES)), np.zeros((ORDER, CLASSES))
    share = np.ones(len(mixed[0]))  # the chance that the mixture came down to this order
    for n in range(ORDER - 1, -1, -1):
        here = share * weights[n][classes[n]] * ratios[n] / mixed[n + 1]
        own[n] = np.bincount(classes[n], here, CLASSES)
        reached[n] = np.bincount(classes[n], share, CLASSES)
        share = share - here
    return own, reached


def fit_weights(events: DataFrame, floor: float, rounds: int = ROUNDS) -> np.ndarray:
    """Weights by order and class, by expectation-maximisation over a written table of events.

    Each round is one pass over the table; a sum per order and class comes to the driver. A class
    without an event takes the weight of the next lower one that has some; a context that was
    never seen has weight 0.
    """
    weights = np.full((ORDER, CLASSES), 0.5)
    weights[:, 0] = 0
    for _ in range(rounds):
        now = weights.copy()

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((2, ORDER, CLASSES))
            for batch in batches:
                for at in range(batch.num_rows):
                    ratios = [np.frombuffer(batch[f"ratio{n}"][at].as_py(), np.float32).astype(float) for n in range(ORDER)]
                    classes = [np.frombuffer(batch[f"class{n}"][at].as_py(), np.uint8) for n in range(ORDER)]
                    sums += expectation(ratios, classes, now, floor)
            order, kind = np.nonzero(sums[1])
            columns = [order, kind, sums[0][order, kind], sums[1][order, kind]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["order", "class", "own", "reached"])

        sums = ready(events).mapInArrow(expect, "order long, class long, own double, reached double")
        seen = sums.groupBy("order", "class").agg(F.sum("own").alias("own"), F.sum("reached").alias("reached")).collect()
        for r in seen:
            weights[r["order"], r["class"]] = round(r["own"] / r["reached"], 6) if r["class"] else 0
        met = {(r["order"], r["class"]) for r in seen}
        for n in range(ORDER):
            for c in range(2, CLASSES):
                if (n, c) not in met and any((n, d) in met for d in range(1, c)):
                    weights[n, c] = weights[n, c - 1]
        if np.abs(weights - now).max() < CLOSE:
            break
    return weights


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = FOLDS) -> DataFrame:
    """Log10 probabilities of all texts under a trigram model learned from most of them.

    One row per document: the key, held_out (its key's checksum is divisible by ``folds``; all
    others are learned from), n_tokens, n_known (tokens met in training), train_tokens,
    base_score (unigrams, a tenth added to each count) and score. Tokens are the words between
    ASCII white space, A-Z in lower case, and one end of text.

    The probability of a token is w3 f3 + (1 - w3) (w2 f2 + (1 - w2) (w1 f1 + (1 - w1) / (V + 1))), f
    being maximum-likelihood estimates of three orders (0 after a context never seen). A weight
    depends on how often its context was seen, in powers of two. Weights are learned by
    expectation-maximisation: a tenth of the training documents (by another digit of the checksum)
    is deleted from the counts and is what the estimates of the rest are weighed on. Scores then
    use the counts of all training documents. Probabilities sum to one over the V known words and
    one for all others.

    Everything is counted over the whole corpus, with no cut-off: a block of texts sends the hash of
    each of its distinct n-grams once with its count, to the bucket of its hash range, and gets the
    totals back. A very frequent n-gram is one entry per block. Hashes of words have 62 bits, those
    of pairs and triples 54: of 10^13 different ones less than one in a thousand shares its count
    with another.

    Null and empty texts are one token, the end. A null key is learned from. Repeated rows and keys
    each count and give a row; other columns play no part. An empty table gives no rows. With nothing
    to learn from every token has probability 1, and with no deleted document all weights are one half.
    """
    stored = write_out(blocks(docs, key, text, folds))
    sizes = {r["role"]: r for r in stored.groupBy("role").agg(F.sum("bytes").alias("bytes"), F.sum(F.size("keys")).alias("n")).collect()}
    buckets = max(8, -(-sum(r["bytes"] for r in sizes.values()) // BUCKET_BYTES))
    texts = {role: sizes[role]["n"] if role in sizes else 0 for role in (DELETED, RETAINED)}
    replies = write_out(_count(_ask(stored, buckets)))
    sums = replies.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "deleted_tokens", "words")]).first()
    total, words = sums["tokens"], sums["words"]
    deleted = F.col("role") == DELETED
    events = _events(_answered(stored.filter(deleted), replies.filter(deleted)), texts[RETAINED], total - sums["deleted_tokens"])
    floor = 1 / (words + 1)
    weights = fit_weights(write_out(events), floor)
    everything = texts[DELETED] + texts[RETAINED]

    schema = T.StructType([
        T.StructField("key", docs.schema[key].dataType), T.StructField("held_out", T.BooleanType()),
        *[T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")],
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                tokens, counts = _counts_of(batch, at, "all")
                of = lambda values: np.add.reduceat(values, tokens.bounds[:-1])
                base = np.log10((counts[0] + 0.1) / (total + 0.1 * (words + 1)))
                mixed = mixture(*estimates(tokens, counts, everything, total), weights, floor)[-1]
                n = len(tokens.bounds) - 1
                columns = [
                    batch["keys"].slice(at, 1).flatten(), pa.array([batch["role"][at].as_py() == HELD_OUT] * n), pa.array(np.diff(tokens.bounds)),
                    pa.array(of((counts[0] > 0).astype(np.int64))), pa.array([total] * n, pa.int64()), pa.array(of(base)), pa.array(of(np.log10(mixed))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    answered = _answered(stored, replies).select("role", "keys", "sizes", "payload", "replies")
    return ready(answered).mapInArrow(score, schema).withColumnRenamed("key", key)
