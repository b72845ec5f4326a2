"""Hard negatives by inner product, with length buckets and pruning by coordinates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.workers import ready
from ledgerline.session import write_out

EVERY, POSITIVES, NEGATIVES = 100, 5, 10
LOW, HIGH = 30, 90  # a negative's score in hundredths of the positive's
BUCKET_ROWS, LEAST_ROWS = 4096, 256
ANCHOR_ROWS = 512
SLOT_BUCKETS = 16
FOCUS = 5  # coordinates whose lists are intersected
SEEDS = 256  # rows verified first, for a threshold
EXACT = 2.0**53  # below it, sums of products of whole doubles are exact


def whole_vectors(vectors: DataFrame, key: str, vector: str, label: str, scale: float) -> DataFrame:
    """``(vec_id, label, dims, norm, coords)``: components times ``scale`` rounded down, as 32-bit
    numbers, of the rows that take part."""
    values = F.col("vector")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    plain = vectors.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"),
    ).dropna().filter((F.size(values) > 0) & ~bad)

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["vector"]
            sizes = lists.value_lengths().to_numpy()
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * scale)
            ends = np.cumsum(sizes)
            squares = np.add.reduceat(flat * flat, ends - sizes) if len(sizes) else flat
            kept = np.flatnonzero(squares < 2.0**62)
            coords = [flat[ends[i] - sizes[i] : ends[i]].astype(np.int32).tobytes() for i in kept]
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"].take(pa.array(kept)), batch["label"].take(pa.array(kept)), pa.array(sizes[kept].astype(np.int32)),
                 pa.array(np.sqrt(squares[kept])), pa.array(coords, pa.binary())],
                names=["vec_id", "label", "dims", "norm", "coords"],
            )

    return ready(plain).mapInArrow(scaled, "vec_id long, label long, dims int, norm double, coords binary")


def length_buckets(rows: DataFrame, partitions: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Vectors of like size, label and length together: one row per bucket with all its vectors and,
    for each coordinate, the order of the unit vectors by it."""
    spread = F.xxhash64("vec_id", F.monotonically_increasing_id())
    order = ["dims", "label", "norm"]
    dealt = rows.withColumn("spread", spread).repartitionByRange(partitions, *order, "spread").sortWithinPartitions(*order).drop("spread")
    names = ["dims", "labels", "ids", "of", "norms", "coords", "lists"]

    def row(parts: list[tuple]) -> pa.RecordBatch:
        dims = parts[0][2]
        ids, of, norms = (np.array([p[i] for p in parts], t) for i, t in ((0, np.int64), (1, np.int64), (3, np.float64)))
        coords = b"".join(p[4] for p in parts)
        lists = np.argsort(_units(np.frombuffer(coords, np.int32).reshape(-1, dims), norms).T, axis=1).astype(np.uint16)
        columns = [
            pa.array([dims], pa.int32()), pa.array([sorted(set(of.tolist()))], pa.list_(pa.int64())),
            *[pa.array([x.tobytes()], pa.binary()) for x in (ids, of, norms)], pa.array([coords], pa.binary()), pa.array([lists.tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for item in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (len(held) == bucket_rows or item[2] != held[-1][2] or (item[1] != held[-1][1] and len(held) >= LEAST_ROWS)):
                    yield row(held)
                    held = []
                held.append(item)
        if held:
            yield row(held)

    schema = "dims int, labels array<long>, ids binary, of binary, norms binary, coords binary, lists binary"
    return ready(dealt).mapInArrow(build, schema).withColumn("bucket", F.monotonically_increasing_id())


def _units(coords: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return coords / np.where(norms > 0, norms, 1)[:, None]


class Bucket:
    """One bucket, opened."""

    def __init__(self, row: dict):
        dims = row["dims"]
        self.ids, self.of = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["of"], np.int64)
        norms = np.frombuffer(row["norms"], np.float64)
        self.longest = float(norms.max())
        whole = np.frombuffer(row["coords"], np.int32).reshape(-1, dims)
        self.rows, self.units = whole.astype(np.float64), _units(whole, norms)
        self.lists = np.frombuffer(row["lists"], np.uint16).reshape(dims, -1)

    def scores(self, query: np.ndarray, norm: float, chosen: np.ndarray) -> np.ndarray:
        """Exact inner products with the chosen rows."""
        if norm * self.longest >= EXACT:
            return self.rows[chosen].astype(np.int64) @ query.astype(np.int64)
        if 4 * len(chosen) > len(self.ids):
            return (self.rows @ query)[chosen].astype(np.int64)
        return (self.rows[chosen] @ query).astype(np.int64)

    def seeds(self, query: np.ndarray) -> np.ndarray:
        """Rows that are likely to score high: those far along the strongest coordinate."""
        strongest = int(np.abs(query).argmax())
        ranked = self.lists[strongest]
        return (ranked[-SEEDS:] if query[strongest] > 0 else ranked[:SEEDS]).astype(np.int64)

    def candidates(self, query: np.ndarray, norm: float, least: float) -> np.ndarray:
        """All rows that can reach the score ``least``.

        They must be within an angle of the query; so the angles that a row and the query make with
        a coordinate axis differ by no more, which bounds that coordinate of the row. The feasible
        ranges of the coordinates in which the query is strongest are cut from the sorted lists
        and intersected.
        """
        everything = np.arange(len(self.ids))
        if least <= 0 or norm == 0:
            return everything
        cosine = least / (norm * max(self.longest, 1e-300))
        if cosine > 1 + 1e-9:
            return everything[:0]
        reach = np.arccos(min(cosine, 1.0)) + 1e-6
        unit = query / norm
        seen, lists = np.zeros(len(self.ids), np.int8), 0
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            angle = np.arccos(np.clip(unit[f], -1, 1))
            low, high = np.cos(min(np.pi, angle + reach)) - 1e-9, np.cos(max(0.0, angle - reach)) + 1e-9
            ranked = self.units[self.lists[f], f]
            first, last = np.searchsorted(ranked, low, "left"), np.searchsorted(ranked, high, "right")
            if last - first < len(ranked):
                seen[self.lists[f][first:last]] += 1
                lists += 1
        return np.flatnonzero(seen == lists)


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties by smaller id."""
    if len(scores) > 4 * n:
        least = np.partition(scores, -n)[-n]
        places = np.flatnonzero(scores >= least)
        return places[np.lexsort((ids[places], -scores[places]))][:n]
    return np.lexsort((ids, -scores))[:n]


def top_of_label(bucket: Bucket, query: np.ndarray, norm: float, own: int, label: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``n`` best other rows with this label."""

    def wanted(places: np.ndarray) -> np.ndarray:
        return places[(bucket.of[places] == label) & (bucket.ids[places] != own)]

    first = bucket.scores(query, norm, wanted(bucket.seeds(query)))
    least = float(np.partition(first, -n)[-n]) if len(first) >= n else -np.inf
    places = wanted(bucket.candidates(query, norm, least))
    scores = bucket.scores(query, norm, places)
    kept = best(scores, bucket.ids[places], n)
    return bucket.ids[places[kept]], scores[kept]


def in_range(
    bucket: Bucket, query: np.ndarray, norm: float, label: int, positives: list[int], n: int, low: int, high: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each positive score, ids and scores of the ``n`` best rows of other labels between
    ``low`` and ``high`` hundredths of it."""
    bounds = [(-((-low * p) // 100), high * p // 100) for p in positives]

    def wanted(places: np.ndarray) -> np.ndarray:
        return places[bucket.of[places] != label]

    first = bucket.scores(query, norm, wanted(bucket.seeds(query)))
    least = np.inf
    for floor, ceiling in bounds:
        if floor <= ceiling:
            inside = first[(first >= floor) & (first <= ceiling)]
            least = min(least, float(np.partition(inside, -n)[-n]) if len(inside) >= n else floor)
    places = wanted(bucket.candidates(query, norm, least)) if least < np.inf else np.zeros(0, np.int64)
    scores, ids = bucket.scores(query, norm, places), bucket.ids[places]
    out = []
    for floor, ceiling in bounds:
        inside = np.flatnonzero((scores >= floor) & (scores <= ceiling))
        kept = inside[best(scores[inside], ids[inside], n)]
        out.append((ids[kept], scores[kept]))
    return out


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[Bucket, list[dict]]]:
    """The opened bucket of each joined row and its anchors; rows of one bucket follow each other."""
    last, opened = None, None
    for at in range(batch.num_rows):
        if batch["bucket"][at].as_py() != last:
            last = batch["bucket"][at].as_py()
            opened = Bucket({n: batch[n][at].as_py() for n in ("dims", "ids", "of", "norms", "coords", "lists")})
        yield opened, batch["anchors"][at].as_py()


def hard_negatives(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = EVERY,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: float = 256,
    bucket_rows: int = BUCKET_ROWS, anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for every
    anchor (a row whose key is divisible by ``every``) and each of its ``positives`` best other
    rows of the same label, the ``negatives`` best rows of other labels that score between ``low``
    and ``high`` hundredths of the positive. Scores are exact inner products of the components
    times ``scale``, rounded down; ties go to the smaller key.

    All rows are indexed in buckets of one dimension, few labels and like length. A block of
    anchors meets a bucket as one joined row. In it a few rows along the anchor's strongest
    coordinate give a threshold; the length of the bucket then says how close a row must be, its
    feasible ranges of the focus coordinates are cut from the sorted lists, and the rows in all of
    them are verified. Nothing that can reach the threshold is skipped. Positives are looked for in
    the buckets with the anchor's label only. The index travels once; what is copied is the anchors.

    Rows without a key, label or vector, with a null or non-finite component, without components,
    or so long that products exceed 62 bits take no part. Vectors only meet those with as many
    components. A key that comes twice is a candidate twice and an anchor once (of the least
    label, then the fewest components, then the shortest). Fewer rows than asked for: all. Without a row of its label an anchor gives nothing;
    negative scores of the positive allow no negative, and zero only zero. Other columns play no
    part; an empty table gives no rows.
    """
    usable = write_out(whole_vectors(vectors, key, vector, label, scale))
    n = usable.count()
    index = write_out(length_buckets(usable, max(1, -(-n // (4 * bucket_rows))), bucket_rows))
    once = usable.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "dims", "norm", "coords")).alias("row"))
    anchors = write_out(once.select("vec_id", "row.*"))
    chunks = max(1, -(-anchors.count() // anchor_rows))
    chunk = F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).alias("chunk")

    # Positives: blocks of anchors with one label, against the buckets that hold it.
    blocks = anchors.groupBy("dims", "label", chunk).agg(F.collect_list(F.struct("vec_id", "label", "norm", "coords")).alias("anchors"))
    holders = index.select("bucket", F.col("dims"), F.explode("labels").alias("label"))
    asked = blocks.join(holders, ["dims", "label"]).select("bucket", "anchors")

    def find_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, block in _rows(batch):
                out = []
                for a in block:
                    query = np.frombuffer(a["coords"], np.int32).astype(np.float64)
                    found = top_of_label(bucket, query, a["norm"], a["vec_id"], a["label"], positives)
                    out += [(a["vec_id"], int(i), int(s)) for i, s in zip(*found)]
                columns = list(zip(*out)) if out else [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["vec_id", "positive_id", "score"])

    payload = ["dims", "ids", "of", "norms", "coords", "lists"]
    met = asked.join(index.select("bucket", *payload), "bucket")
    found = ready(met).mapInArrow(find_positives, "vec_id long, positive_id long, score long")
    nearest = Window.partitionBy("vec_id").orderBy(F.col("score").desc(), "positive_id")
    ranked = found.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= positives)
    listed = ranked.groupBy("vec_id").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "score"))).alias("positives"))

    # Negatives: blocks of anchors of any label, against all buckets of their dimension.
    slots = max(1, -(-index.count() // SLOT_BUCKETS))
    whole = anchors.join(listed, "vec_id").groupBy("dims", chunk).agg(
        F.collect_list(F.struct("vec_id", "label", "norm", "coords", "positives")).alias("anchors")
    )
    copies = write_out(whole).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    dealt = index.withColumn("slot", F.pmod(F.xxhash64("bucket"), F.lit(slots)).cast("int"))

    def find_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"]
        for batch in batches:
            for bucket, block in _rows(batch):
                out = []
                for a in block:
                    query = np.frombuffer(a["coords"], np.int32).astype(np.float64)
                    own = a["positives"]
                    found = in_range(bucket, query, a["norm"], a["label"], [p["score"] for p in own], negatives, low, high)
                    for p, (ids, scores) in zip(own, found):
                        out += [(a["vec_id"], p["place"], p["positive_id"], p["score"], int(i), int(s)) for i, s in zip(ids, scores)]
                columns = list(zip(*out)) if out else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    pairs = copies.select("dims", "slot", "anchors").join(dealt.select("slot", "bucket", *payload), ["dims", "slot"])
    schema = "anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"
    mined = ready(pairs).mapInArrow(find_negatives, schema)
    hardest = Window.partitionBy("anchor_id", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    return mined.withColumn("rank", F.row_number().over(hardest)).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
