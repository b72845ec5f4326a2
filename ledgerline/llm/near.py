"""Near-duplicate documents: HyperMinHash registers, banding, estimation, verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.words import SPACES, mix, slices
from ledgerline.llm.workers import ready
from ledgerline.operators.components import components
from ledgerline.session import write_out

WORDS = 5
PERCENT = 75
# Registers: 128 buckets of 16 bits, six for the leading zeros and ten for the mantissa.
BUCKET_BITS, MANTISSA_BITS = 7, 10
BUCKETS, VALUE_BITS = 1 << BUCKET_BITS, 64 - BUCKET_BITS
EMPTY = 0xFFFF
BAND_REGISTERS = 4
BANDS = BUCKETS // BAND_REGISTERS
# An estimate this many standard errors below the threshold is not verified.
ERRORS = 4.5
COLLISION = 0.169919487159739093975315012348  # fixed value of the published estimator
# Pairs of sets of which one has so few shingles meet by the shingles themselves, without loss.
FEW = 10
# A group of documents with one hub is compared in blocks of so many documents or hashes.
BLOCK, BLOCK_HASHES = 1024, 1 << 20


def registers(distinct: np.ndarray) -> np.ndarray:
    """The registers of one set of sorted distinct hashes. The top bits of a hash choose the
    bucket; each keeps its least value as leading zeros and the bits after the leading one."""
    starts = np.searchsorted(distinct, np.arange(BUCKETS, dtype=np.uint64) << np.uint64(VALUE_BITS))
    ends = np.append(starts[1:], len(distinct))
    out = np.full(BUCKETS, EMPTY, np.uint16)
    held = ends > starts
    value = distinct[starts[held]] & np.uint64((1 << VALUE_BITS) - 1)
    zeros = VALUE_BITS - np.frexp(value.astype(np.float64))[1].astype(np.int64)
    shifted = (value << zeros.astype(np.uint64)) & np.uint64((1 << (VALUE_BITS - 1)) - 1)
    mantissa = shifted >> np.uint64(VALUE_BITS - 1 - MANTISSA_BITS)
    out[held] = (zeros << MANTISSA_BITS) | mantissa.astype(np.int64)
    return out


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard similarity of rows of registers, less the matches expected by chance, and how
    many buckets it rests on. ``n`` and ``m`` are the sizes of the sets."""
    used = ((a != EMPTY) | (b != EMPTY)).sum(axis=-1)
    same = ((a == b) & (a != EMPTY)).sum(axis=-1)
    ratio = np.maximum(n, m) / np.maximum(np.minimum(n, m), 1)
    chance = COLLISION * 2.0 ** (BUCKET_BITS - MANTISSA_BITS) * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(same - chance, 0) / np.maximum(used, 1), used


def worth_verifying(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    similarity, used = estimate(a, b, n, m)
    least = percent / 100
    fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)  # sizes alone rule the others out
    return fits & (similarity >= least - ERRORS * np.sqrt(least * (1 - least) / np.maximum(used, 1)))


def _sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    for part in slices(column, SPACES, lower=True):
        hashes, counts = part.shingles(words)
        ends = np.cumsum(counts)
        for first, last in zip(ends - counts, ends):
            ordered = np.sort(hashes[first:last])
            if len(ordered) > 1:
                ordered = ordered[np.concatenate(([True], ordered[1:] != ordered[:-1]))]
            yield ordered


def prefix(ordered: np.ndarray, percent: int, few: int) -> np.ndarray:
    """The least hashes of a small set, one of which every set holds that has at least ``percent``
    per cent in common with it and does the same; none for sets too large to matter."""
    n = len(ordered)
    return ordered[: n - -(-percent * n // 100) + 1] if 0 < percent * n <= 100 * few else ordered[:0]


def _register_rows(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = 2 * BUCKETS
    data = column.buffers()[2]
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    rows = np.frombuffer(data, np.uint8, count=len(column) * width, offset=int(first))
    return rows.reshape(-1, width).view(np.uint16)


def signatures(docs: DataFrame, key: str, text: str, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: the key, n_shingles, a 128-bit digest of the set, its registers, and the hashes by
    which a small set is found."""
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("n_shingles", T.LongType()),
        T.StructField("sum1", T.LongType()), T.StructField("sum2", T.LongType()), T.StructField("registers", T.BinaryType()),
        T.StructField("least", T.ArrayType(T.LongType())),
    ])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, one, two, kept, least = [], [], [], [], []
            for s in _sets(batch.column(1), words):
                size.append(len(s))
                one.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                two.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)))
                kept.append(registers(s).tobytes() if len(s) else None)
                least.append(prefix(s, percent, FEW).view(np.int64).tolist())
            columns = [pa.array(c, pa.int64()) for c in (size, one, two)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(kept, pa.binary()), pa.array(least, pa.list_(pa.int64()))], names=schema.names)

    return ready(docs.select(key, text)).mapInArrow(sign, schema)


def _bands(nodes: DataFrame) -> DataFrame:
    """``(bucket, band, node)`` for every band with a register that is not empty, and for every hash
    by which a small set is found."""
    width = 2 * BAND_REGISTERS
    parts = [F.substring("registers", width * b + 1, width) for b in range(BANDS)]
    keys = [F.when(p != F.lit(b"\xff" * width), F.xxhash64(F.lit(b), p)) for b, p in enumerate(parts)]
    shared = F.transform("least", lambda h: F.xxhash64(F.lit(BANDS), h))
    return nodes.select("node", F.posexplode(F.concat(F.array(*keys), shared)).alias("band", "bucket")).filter(F.col("bucket").isNotNull())


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that are worth verifying."""
    plain = nodes.select("node", "n", "registers")
    for side in "ab":
        pairs = pairs.join(plain.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("registers").alias(f"r_{side}")), side)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = batch["n_a"].to_numpy(), batch["n_b"].to_numpy()
            mask = worth_verifying(_register_rows(batch["r_a"]), _register_rows(batch["r_b"]), n, m, percent)
            yield batch.select(["a", "b"]).filter(pa.array(mask))

    # A bound on sizes first: it needs no registers and runs in the JVM.
    sized = pairs.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    kind = pairs.schema["a"].dataType
    return ready(sized.select("a", "b", "n_a", "n_b", "r_a", "r_b")).mapInArrow(
        keep, T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    )


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    for side in "ab":
        pairs = pairs.join(texts.select(F.col("node").alias(side), F.col("text").alias(f"t_{side}")), side)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = []
            for x, y in zip(_sets(batch["t_a"], words), _sets(batch["t_b"], words)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                mask.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(mask, pa.bool_()))

    kind = pairs.schema["a"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return ready(pairs.select("a", "b", "t_a", "t_b")).mapInArrow(check, schema).distinct()


def _by_group(compare):
    """A function for mapInArrow that hands over the rows of one (hub, i, j) after another."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch[c].to_numpy() for c in ("hub", "i", "j")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            if held and any(held[-1][c][0] != batch[c][0] for c in ("hub", "i", "j")):
                yield from compare(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held = []
            for first, last in zip(cuts[:-1], cuts[1:]):
                held.append(batch.slice(first, last - first))
                if last < batch.num_rows:
                    yield from compare(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held = []
        if held:
            yield from compare(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return walk


def _others(group: pa.RecordBatch, u: int, component: np.ndarray) -> np.ndarray:
    """The later rows of a pair of blocks that row ``u`` has to be compared with."""
    node, block = group["node"].to_numpy(), group["x"].to_numpy()
    fits = (component[u + 1 :] != component[u]) & (node[u + 1 :] != node[u])
    if group["i"][0] != group["j"][0]:
        fits &= block[u + 1 :] != block[u]
    return np.flatnonzero(fits) + u + 1


def _dealt(sized: DataFrame) -> DataFrame:
    """The rows (hub, node, component, n) once for each pair of blocks ``i``, ``j`` that they are
    compared in; ``x`` is a row's own block. Hubs with one component are left out."""
    counted = sized.groupBy("hub", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("hashes"))
    largest = F.max_by(F.struct("component", "rows", "hashes"), F.struct("rows", "component")).alias("large")
    groups = counted.groupBy("hub").agg(F.sum("rows").alias("rows"), F.sum("hashes").alias("hashes"), largest)
    blocks = lambda rows, hashes: F.greatest(F.ceil(F.greatest(rows / BLOCK, hashes / BLOCK_HASHES)), F.lit(1)).cast("int")
    groups = groups.filter(F.col("rows") > F.col("large.rows")).select(
        "hub", F.col("large.component").alias("large"), blocks(F.col("large.rows"), F.col("large.hashes")).alias("of_large"),
        blocks(F.col("rows") - F.col("large.rows"), F.col("hashes") - F.col("large.hashes")).alias("of_others"),
    )
    dealt = sized.join(groups, "hub")
    # Blocks of the largest component are -1, -2 ..., those of the others 0, 1 ...
    place = F.xxhash64("node")
    in_large = F.col("component") == F.col("large")
    home = F.when(in_large, -1 - F.pmod(place, F.col("of_large"))).otherwise(F.pmod(place, F.col("of_others"))).cast("int")
    met_by_all = F.sequence(F.lit(0), F.col("of_others") - 1)
    met_by_others = F.concat(met_by_all, F.transform(F.sequence(F.lit(1), F.col("of_large")), lambda block: -block))
    dealt = dealt.withColumn("x", home).withColumn("y", F.explode(F.when(in_large, met_by_all).otherwise(met_by_others)))
    return dealt.withColumns({"i": F.least("x", "y"), "j": F.greatest("x", "y")})


def _across(met: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` between components among documents that share a hub.

    ``met`` has hub, node and component. A group is split into blocks, and a pair of blocks is one
    unit of work, so no task holds a whole group. Documents of its largest component only meet the
    others, so each is copied once per block of others, which for one large group of copies is once.
    First registers alone tell which
    documents have a partner worth verifying; then the texts of those are compared where they
    lie. Only links leave a task, and only such as join two components there.
    """
    dealt = _dealt(met.join(nodes, "node"))
    unit = ["hub", "i", "j"]
    ordered = dealt.select(*unit, "x", "node", "component", "n", "registers").repartition(*unit).sortWithinPartitions(*unit)
    carried = [*unit, "x", "node", "component"]

    def promising(group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        component, size, rows = group["component"].to_numpy(), group["n"].to_numpy(), _register_rows(group["registers"])
        wanted = np.zeros(len(size), bool)
        for u in range(len(size) - 1):
            others = _others(group, u, component)
            others = others[worth_verifying(rows[others], rows[u][None, :], size[others], size[u], percent)]
            wanted[others] = True
            wanted[u] |= len(others) > 0
        yield group.select(carried).filter(pa.array(wanted))

    picked = ready(ordered).mapInArrow(_by_group(promising), dealt.select(*carried).schema)
    full = picked.join(texts, "node").select(*carried, "text").repartition(*unit).sortWithinPartitions(*unit)

    def linked(group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        node, component = group["node"].to_numpy(), group["component"].to_numpy().copy()
        sets = list(_sets(group["text"], words))
        size = np.array([len(s) for s in sets])
        _, number = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(size)
        flag = np.zeros(number.max() + 1, np.int64)
        a, b = [], []
        for u in range(len(node) - 1):
            others = _others(group, u, component)
            others = others[100 * np.minimum(size[others], size[u]) >= percent * np.maximum(size[others], size[u])]
            if not len(others):
                continue
            mine = number[ends[u] - size[u] : ends[u]]
            flag[mine] = 1
            both = np.add.reduceat(flag[number], ends - size)[others]
            flag[mine] = 0
            for v in others[100 * both >= percent * (size[others] + size[u] - both)]:
                if component[v] != component[u]:
                    a.append(min(node[u], node[v]))
                    b.append(max(node[u], node[v]))
                    component[component == component[v]] = component[u]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b)], names=["a", "b"])

    return ready(full).mapInArrow(_by_group(linked), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """Per row the key, n_shingles, component_id and kept (the key is its component's least).

    A text is the set of its distinct shingles of ``words`` words (A-Z lower-cased, split at
    ASCII white space), or all its words as one if it has fewer. Texts whose sets have at least
    ``percent`` per cent of their union in common are linked, and components follow links.

    Texts of one set form a class and are compared once. Classes meet in the buckets of 32
    bands of four HyperMinHash registers; a pair at the threshold shares none of them with a
    chance of about five in a million. First every member of a bucket is compared with one hub,
    the member that shares most buckets with others, so a large group of near copies costs one
    comparison a member. Then only pairs in different components that share a hub are left;
    they are estimated and verified in blocks, and nothing but links leaves a task. No bucket is
    capped. Sets of up to 13 shingles also meet by their least hashes, so no pair with a set of up to
    10 is lost. Two losses have no exact path (by calculation, not measured): the bands, and that
    an estimate 4.5 standard errors below the threshold is not verified, which drops another few
    in a million of the pairs at the threshold.

    Keys are integers. Texts without words have no set, are linked with nothing, and are their
    own component. Rows without a key have a null component, are kept, and link nothing. A key
    that comes with several texts is one document in several versions, linked if one of them
    is. Repeated rows each give a row; other columns play no part; an empty table gives no rows.
    """
    plain = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("text"))
    signed = write_out(signatures(plain, "_key", "text", words, percent))
    identity = ["n_shingles", "sum1", "sum2"]
    classes = signed.filter((F.col("n_shingles") > 0) & F.col("_key").isNotNull()).groupBy(*identity).agg(
        F.min("_key").alias("node"), F.first("registers").alias("registers"), F.first("least").alias("least")
    )
    classes = write_out(classes)
    nodes = classes.select("node", F.col("n_shingles").alias("n"), "registers")

    bands = _bands(classes)
    sizes = bands.groupBy("bucket").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    members = write_out(bands.join(sizes, "bucket"))
    degrees = members.groupBy("node").agg(F.sum("size").alias("degree"))
    hubs = members.join(degrees, "node").groupBy("bucket").agg(
        F.max(F.struct(F.col("degree"), (-F.col("node")).alias("least"))).alias("top")
    ).select("bucket", (-F.col("top.least")).alias("hub"))
    # Whoever shares a bucket shares its hub.
    met = write_out(members.join(hubs, "bucket").select("hub", "node").distinct())
    starred = met.filter(F.col("node") != F.col("hub")).select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    likely = write_out(_estimated(starred, nodes, percent))
    wanted = members.select("node").distinct()
    texts = write_out(plain.join(wanted, F.col("_key") == F.col("node"), "left_semi").select(F.col("_key").alias("node"), "text"))
    links = write_out(_verified(likely, texts, words, percent))
    first = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))

    placed = met.join(first, "node", "left").select("hub", "node", F.coalesce("component", "node").alias("component"))
    more = _across(placed, nodes, texts, words, percent)
    edges = links.unionByName(more).select(F.col("a").alias("u"), F.col("b").alias("v"))
    final = components(edges)

    # From a row to its class, and from the class to its component.
    named = classes.select(*identity, "node").join(final, "node", "left")
    named = named.select(*identity, F.coalesce("component", "node").alias("class_id"))
    component = F.when(F.col("_key").isNotNull(), F.coalesce("class_id", "_key"))
    return signed.select("_key", *identity).join(named, identity, "left").select(
        F.col("_key").alias(key), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("_key") == component, F.lit(True)).alias("kept"),
    )
