import random

import numpy as np
import pytest

from ledgerline.llm import interpolation
from tests.llm import brute
from tests.llm.test_operators import EDGES, FOLDER, table


def compare(got, rows):
    """The scores of all rows against plain loops."""
    expected, probability, known = brute.interpolated(rows)
    ours = sorted((str(r.doc_id), r.n_tokens, r.held_out, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    theirs = sorted((str(i), e[1], e[0], *e[2:]) for (i, _), e in zip(rows, expected))
    assert [x[:5] for x in ours] == [x[:5] for x in theirs]
    for mine, other in zip(ours, theirs):
        assert mine[5] == pytest.approx(other[5], abs=1e-9, rel=1e-9)
        assert mine[6] == pytest.approx(other[6], abs=1e-3, rel=2e-4)
    return probability, known


def sentences(rng, n):
    words = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(n * 12)]
    return [" ".join(words[12 * i : 12 * i + rng.randrange(13)]) for i in range(n)]


def test_scores_equal_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(interpolation, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(interpolation, "BUCKET_BYTES", 3000)
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate(sentences(rng, 700))] + [(None, "w1 W2 w3"), (5, "w1 w2 w3"), (5, "w1 w2 w3"), (701, None)]
    got = interpolation.score_texts(table(spark, rows).repartition(3)).collect()
    probability, known = compare(got, rows)
    # All known words and one unknown share the probability after any two words.
    for pair in (["<b>", "<b>"], ["<b>", "w1"], ["w1", "w2"], ["w1", "nowhere"], ["no", "where"]):
        assert sum(probability([*pair, w], 2) for w in [*known, "never seen"]) == pytest.approx(1)


def test_real_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = interpolation.score_texts(docs).collect()
    compare(got, rows)
    unseen = [r for r in got if r.held_out]
    assert unseen and sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_edges(spark):
    compare(interpolation.score_texts(table(spark, EDGES)).collect(), EDGES)
    assert interpolation.score_texts(table(spark, [])).collect() == []


def test_nothing_to_learn_from(spark):
    import zlib

    held = [(i, "a b c") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    for r in interpolation.score_texts(table(spark, held)).collect():
        assert r.held_out and (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (4, 0, 0, 0, 0)


def test_packed_arrays_return():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5000):
        hashes = np.unique(rng.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2))
        assert (interpolation.unpack_sorted(interpolation.pack_sorted(hashes)) == hashes).all()
        for top in (2, 300, 70_000, 1 << 40):
            counts = rng.integers(0, top, n)
            assert (interpolation.unpack_counts(interpolation.pack_counts(counts)) == counts).all()


def test_a_round_never_lowers_the_likelihood():
    rng = np.random.default_rng(2)
    ratios = [rng.random(5000) * (rng.random(5000) < p) for p in (1, 0.6, 0.3)]
    classes = [rng.integers(1, 6, 5000) for _ in range(3)]
    weights, last = np.full((3, interpolation.CLASSES), 0.5), -np.inf
    for _ in range(30):
        likelihood = np.log(interpolation.mixture(ratios, classes, weights, 1e-4)[-1]).sum()
        assert likelihood >= last - 1e-9
        last = likelihood
        own, reached = interpolation.expectation(ratios, classes, weights, 1e-4)
        weights = np.divide(own, reached, out=weights.copy(), where=reached > 0)
    assert np.abs(np.divide(*interpolation.expectation(ratios, classes, weights, 1e-4), out=weights.copy(), where=reached > 0) - weights).max() < 0.01
