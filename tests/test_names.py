import random

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.similarity import token_set, with_similarity
from ledgerline.operators.components import components
from ledgerline.operators.resolve import canonical_names, extend_clusters, name_clusters, resolve_players
from ledgerline.operators.similar import similar_names, similar_sets
from tests.name_model import clusters, pairs, score

TOKENS = ["ANA", "JUAN", "JUANA", "LUIS", "LUISA", "GOMEZ", "GOMES", "BACODIFU", "X", "Y", "PEREZ"]


def test_score_equals_the_model(spark):
    rng = random.Random(1)
    rows = [tuple(" ".join(rng.choices(TOKENS, k=rng.randint(0, 4))) for _ in "ab") for _ in range(1000)]
    frame = spark.createDataFrame(rows, "a string, b string")
    for threshold in (95.0, 60.0, 0.0):
        result = with_similarity(frame.select("a", "b", token_set(F.col("a")).alias("x"), token_set(F.col("b")).alias("y")), "x", "y", threshold, "s")
        for r in result.collect():
            want = score(r.a, r.b)
            assert r.s == pytest.approx(want if want >= threshold else 0.0)


def spelled(rng, count, letters="ABCDEFGHIJ", tokens=(1, 4), length=(1, 9)):
    """Names and edited copies of them: letters dropped, doubled, moved, blanks added."""
    base = [
        " ".join("".join(rng.choices(letters, k=rng.randint(*length))) for _ in range(rng.randint(*tokens)))
        for _ in range(count)
    ]
    names = list(base)
    for name in base:
        for _ in range(3):
            text = list(name)
            for _ in range(rng.randint(1, 2)):
                i = rng.randrange(len(text))
                text[i:i + 1] = rng.choice([[], [text[i], text[i]], [rng.choice(letters + " ")], [text[i], " "]])
                if not text:
                    text = ["Q"]
            parts = "".join(text).split()
            rng.shuffle(parts)
            names.append(" ".join(parts))
    return sorted({n for n in names if n.strip()})


@pytest.mark.parametrize("seed,block_rows,shape", [
    (1, 2000, {}),
    (2, 1, {}),                                          # every block is crowded
    (3, 3, {"letters": "AB", "length": (1, 4), "tokens": (2, 8)}),
    (4, 5, {"letters": "AB", "length": (8, 16), "tokens": (1, 5)}),   # long names, few letters
    (5, 2000, {"letters": "ABCDEFGHIJKLMNOP", "length": (6, 12), "tokens": (3, 6)}),
    (6, 2000, {"letters": "ABC", "length": (3, 7), "tokens": (3, 6)}),    # two edits, many common letters
])
def test_similar_names_are_complete(spark, seed, block_rows, shape):
    names = spelled(random.Random(seed), 60, **shape)
    want = pairs(names, 95.0)
    rows = similar_names(spark.createDataFrame([(n,) for n in names], "name string"), 95.0, block_rows).collect()
    got = {(r.name_a, r.name_b): r.score for r in rows}
    assert len(rows) == len(got)
    assert got.keys() == want.keys()
    assert all(got[p] == pytest.approx(want[p]) for p in want)
    assert len(want) > 20


def test_shared_first_and_last_names(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("ABCDEFGHIJKLMNOP", k=rng.randint(5, 9)))
    first, last = [word() for _ in range(9)], [word() for _ in range(9)]
    names = [f"{a} {b}" for a in first for b in last]
    names += [f"{rng.choice(last)} {rng.choice(first)} {word()}" for _ in range(30)] + first[:3] + [f"{b} {a}" for a, b in zip(first, last)]
    names = sorted(set(names))
    want = pairs(names, 95.0)
    got = {(r.name_a, r.name_b): r.score for r in similar_names(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert got.keys() == want.keys() and len(want) > 40


def test_low_threshold_is_refused(spark):
    with pytest.raises(ValueError):
        similar_sets(spark.createDataFrame([("A",)], "key string"), 80.0)


def test_clusters_and_canonical_names(spark):
    names = spelled(random.Random(7), 60)
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    found = name_clusters(frame, 95.0, 4)
    got = {r.name: r.component for r in found.collect()}
    want = clusters(names, 95.0)
    assert got == want
    groups = {}
    for n, c in want.items():
        groups.setdefault(c, []).append(n)
    best = {c: min(g, key=lambda n: (-len(n), n)) for c, g in groups.items()}
    assert {r.component: r.canonical for r in canonical_names(found).collect()} == best


def test_components_of_chains_and_stars(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    star = [("hub", f"s{i:03d}") for i in range(200)]
    edges = spark.createDataFrame(chain + star + [("a", "a"), ("x", "y"), ("y", "x")], "u string, v string")
    got = {r.node: r.component for r in components(edges).collect()}
    assert {got[n] for n in got if n.startswith("c")} == {"c000"}
    assert {got[n] for n in got if n.startswith("s") or n == "hub"} == {"hub"}
    assert got["x"] == got["y"] == "x" and "a" not in got


def test_resolve_players(spark):
    rows = [
        ("1", "Gómez, Juan Carlos", 0), ("2", "GOMEZ JUAN", 1), ("3", "NOMBRE", 2), ("4", "NOMBRE", 3),
        ("5", None, 4), ("2", "NOMBRE", 5), ("6", "Pérez, Ana", 6), ("7", "PEREZ ANA", 7), ("6", "OTRA PERSONA", 8),
    ]
    players = spark.createDataFrame(rows, "raw_id string, player_name string, position int")
    overrides = spark.createDataFrame([("4", "SOSA, EVA")], "raw_id string, name string")
    entities, by_raw = resolve_players(players, ["position"], overrides)
    names = {r.player_id: r.player_name for r in entities.collect()}
    ids = {r.raw_id: r.player_id for r in by_raw.collect()}
    assert names[ids["1"]] == "GOMEZ JUAN CARLOS" and ids["2"] == ids["1"]
    assert ids["3"] == "UNKNOWN_3" and names["UNKNOWN_3"] == "NOMBRE" and ids["5"] == "UNKNOWN_5"
    assert names[ids["4"]] == "SOSA EVA" and ids["6"] == ids["7"] and "OTRA PERSONA" in names.values()


@pytest.mark.parametrize("seed,block_rows,shape", [(1, 2000, {}), (4, 5, {"letters": "AB", "length": (8, 16), "tokens": (1, 5)})])
def test_clusters_grow_batch_by_batch(spark, seed, block_rows, shape):
    names = spelled(random.Random(seed), 40, **shape)
    random.Random(seed).shuffle(names)
    frame = lambda part: spark.createDataFrame([(n,) for n in part], "name string")
    stored = name_clusters(frame(names[:60]), 95.0, block_rows)
    for first, last in ((40, 100), (100, len(names))):  # some names come again
        stored = extend_clusters(stored, frame(names[first:last]), 95.0, block_rows)
        want = clusters(names[:last], 95.0)
        assert {r.name: r.component for r in stored.collect()} == want
    assert len(set(want.values())) < len(want)


def test_pairs_with_a_fresh_name(spark):
    names = spelled(random.Random(8), 50)
    keys = sorted({" ".join(sorted(set(n.split()))) for n in names})
    some = set(keys[::7])
    frame = lambda part: spark.createDataFrame([(k,) for k in part], "key string")
    got = {(r.key_a, r.key_b) for r in similar_sets(frame(keys), 95.0, 3, frame(some)).collect()}
    assert got == {p for p in pairs(keys, 95.0) if some & set(p)} and len(got) > 10


def test_large_sides_are_not_broadcast(spark):
    """Plans take exploded rows for few ones; the driver must not gather them."""
    frame = spark.range(300).selectExpr("concat('ANA PEREZ', id) AS name")
    pairs = similar_names(frame)
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert pairs.count() > 300
