import random

import numpy as np
import pytest

from ledgerline.llm import negatives
from tests.llm import brute

SCHEMA = "vec_id long, embedding array<double>, label int, bucket string, ids string, anchors string, place int, slot int, norm string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", 1, 2, "y") for r in rows], SCHEMA)


def rows_of(out):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in out.collect())


def clusters(rng, n, dims=12, labels=5):
    """Vectors around centres, of lengths that differ, most of one label; with copies."""
    centres = rng.standard_normal((8, dims))
    out = []
    for i in range(n):
        if out and rng.random() < 0.1:
            out.append((i, out[rng.integers(len(out))][1], int(rng.integers(labels))))
            continue
        v = centres[rng.integers(8)] + rng.standard_normal(dims) * 0.4
        out.append((i, (v * rng.gamma(2, 0.2)).tolist(), 0 if rng.random() < 0.4 else int(rng.integers(labels))))
    return out


@pytest.mark.parametrize("seed,bucket_rows", [(1, 4096), (2, 64), (3, 300)])
def test_equal_to_brute_force(spark, seed, bucket_rows, monkeypatch):
    monkeypatch.setattr(negatives, "SLOT_BUCKETS", 2)
    monkeypatch.setattr(negatives, "LEAST_ROWS", 16)
    rows = clusters(np.random.default_rng(seed), 900)
    out = negatives.hard_negatives(frame(spark, rows), every=20, bucket_rows=bucket_rows, anchor_rows=7)
    got = rows_of(out)
    assert got and got == brute.hard_negatives(rows, every=20)


def test_edges(spark):
    rng = random.Random(4)
    unit = lambda n: [rng.uniform(-1, 1) for _ in range(n)]
    rows = [(i, unit(6), i % 3) for i in range(200)]
    rows += [(None, unit(6), 1), (300, None, 1), (301, unit(6), None), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (400, [float("nan")] * 6, 1)]
    rows += [(500, [float("inf")] * 6, 1), (600, [], 1), (700, [1e12] * 6, 1), (800, [0.0] * 6, 2), (801, [0.0] * 6, 2), (803, [0.0] * 6, 1)]
    # Repeated rows, a key with two vectors and labels, ties.
    rows += rows[:40] + [(100, unit(6), 0), (20, rows[21][1], 1), (900, rows[5][1], 2), (901, rows[5][1], 1), (902, rows[5][1], 1)]
    # Other lengths, one longer and alone, and vectors that score far more than 2 ** 53.
    four = unit(4)
    rows += [(1000, unit(7), 1), (1100, four, 1), (1101, four, 1), *[(1102 + i, [x / (2 + i) for x in four], 2 * i) for i in range(2)]]
    rows += [(1200 + i, [x * 3e6 for x in unit(3)], i % 2) for i in range(101)]
    got = rows_of(negatives.hard_negatives(frame(spark, rows), every=20, bucket_rows=50))
    assert got == brute.hard_negatives(rows, every=20)
    assert {800, 1100, 1200} <= {r[0] for r in got} and not {300, 400, 500, 600, 700, 1000} & {r[0] for r in got}
    assert max(r[4] for r in got) > 2**53
    assert rows_of(negatives.hard_negatives(frame(spark, []))) == []
    assert rows_of(negatives.hard_negatives(frame(spark, rows[:1]), every=1)) == []


def test_candidates_hold_all_that_reach_the_threshold():
    rng, cut, held = np.random.default_rng(7), 0, 0
    for _ in range(60):
        n, dims = int(rng.integers(2, 400)), int(rng.integers(1, 9))
        whole = np.floor(rng.standard_normal((n, dims)) * rng.gamma(1, 60, (n, 1))).astype(np.int32)
        whole[rng.integers(n)] = 0
        norms = np.sqrt((whole.astype(float) ** 2).sum(axis=1))
        lists = np.argsort(negatives._units(whole, norms).T, axis=1).astype(np.uint16)
        bucket = negatives.Bucket({
            "dims": dims, "ids": np.arange(n).tobytes(), "of": np.zeros(n, np.int64).tobytes(), "norms": norms.tobytes(),
            "coords": whole.tobytes(), "lists": lists.tobytes(),
        })
        query = np.floor(rng.standard_normal(dims) * 100)
        norm = float(np.sqrt((query**2).sum()))
        scores = whole.astype(np.int64) @ query.astype(np.int64)
        assert (bucket.scores(query, norm, np.arange(n)) == scores).all()
        for least in np.quantile(scores, [0, 0.5, 0.9, 1]).tolist() + [float(scores.max()) + 1, norm * norms.max() * 1.1 + 1]:
            places = bucket.candidates(query, norm, least)
            assert set(np.flatnonzero(scores >= least)) <= set(places.tolist())
            cut += n - len(places)
            held += len(places)
    assert cut > held / 4


def test_best_breaks_ties_by_id():
    scores, ids = np.array([5, 7, 7, 1, 7, 5, 9, 7]), np.array([8, 6, 2, 1, 4, 3, 9, 5])
    assert ids[negatives.best(scores, ids, 1)].tolist() == [9]
    assert ids[negatives.best(scores, ids, 3)].tolist() == [9, 2, 4]
    assert ids[negatives.best(scores, ids, 20)].tolist() == [9, 2, 4, 5, 6, 3, 8, 1]
