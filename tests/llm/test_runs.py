import random
import time

import numpy as np
import pytest

from ledgerline.llm import queries, runs
from tests.llm import brute
from tests.llm.test_operators import EDGES, FOLDER, table


def found(words):
    first = {}
    numbers = np.array([first.setdefault(w, i) for i, w in enumerate(words)], np.int64)
    return [tuple(map(int, r)) for r in zip(*runs.runs(numbers, len(words)))]


def repetitive(rng, longest):
    n, letters = rng.randrange(longest), rng.choice([1, 2, 2, 3, 5, 40])
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        if n > 8:
            a, q = rng.randrange(n), rng.randrange(1, n // 4 + 1)
            for i in range(max(a, q), min(n, a + 6 * q)):
                words[i] = words[i - q]
    if n and rng.random() < 0.5:
        words[rng.randrange(n)] = rng.randrange(letters)
    return words


@pytest.mark.parametrize("longest,times", [(40, 4000), (200, 300), (600, 40)])
def test_runs_equal_brute_force(longest, times):
    rng, hits = random.Random(longest), 0
    for _ in range(times):
        words = repetitive(rng, longest)
        expected = brute.runs(words)
        assert found(words) == expected, words
        hits += bool(expected)
    assert hits > times // 4


def test_tiers_cover_every_lag_once():
    covered = [lag for low, high, _ in runs.tiers(500) for lag in range(low, high + 1)]
    assert covered[:500] == list(range(1, 501))
    assert all(2 * high - 2 <= context == 3 * low for low, high, context in runs.tiers(500))


def test_fibonacci_words_have_no_runs_of_four():
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    assert found(b) == []


def test_one_word_a_hundred_thousand_times():
    start = time.perf_counter()
    assert found(["x"] * 100_000 + ["y"] + ["x", "y"] * 50_000) == [(0, 100_000, 1), (99_999, 100_002, 2)]
    assert time.perf_counter() - start < 10


def test_rows_equal_brute_force(spark):
    rng = random.Random(5)
    rows = EDGES + [(100 + i, " ".join(f"w{x}" for x in repetitive(rng, 80))) for i in range(60)]
    rows += [(500, "a b  a b\ta b a b c c c c c c"), (500, "a b  a b\ta b a b c c c c c c"), (501, "a b a b a b a"), (502, "é é é é é é   é")]
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.n_dropped, r.collapsed) for r in runs.find_runs(table(spark, rows)).collect())
    expected = []
    for i, text in rows:
        words = brute.SPACE_WORDS.findall(text or "")
        if len(set(words)) < len(words) and len(words) > 1000:
            all_runs = [(0, len(words), 1)]
        else:
            all_runs = brute.runs(words)
        kept = brute.without_runs(words, all_runs)
        expected.append((str(i), len(words), all_runs, len(words) - len(kept), " ".join(kept)))
    assert got == sorted(expected)
    assert runs.find_runs(table(spark, [])).collect() == []


def test_overlapping_runs_drop_a_word_once(spark):
    # The last word of the first run begins the second.
    (row,) = runs.find_runs(table(spark, [(1, "x x x x x x y x y x y x y")])).collect()
    assert [tuple(r) for r in row.runs] == [(0, 6, 1), (5, 8, 2)]
    assert row.collapsed == "x y" and row.n_dropped == 11


def test_plain_exponents_only():
    with pytest.raises(ValueError):
        runs.find_runs(None, exponent=3)


def test_planted_periods(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(None, "a b c"), (30, ""), (31, None)], "doc_id long, text string"))
    got = {}
    for r in queries.with_planted_periods(docs).collect():
        got.setdefault(r.doc_id, []).append(brute.SPACE_WORDS.findall(r.text or ""))
    expected = {}
    for r in docs.collect():
        expected.setdefault(r.doc_id, []).append(brute.plant_period(r.doc_id, brute.SPACE_WORDS.findall(r.text or "")))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    assert any(brute.runs(w[0]) for w in expected.values() if len(w[0]) < 1000)
