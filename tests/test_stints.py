import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.stints import box_score, stint_tables
from ledgerline.rules import SCORING, STATS, event_kind
from tests.stint_model import play_match

LOG = "match_id string, seq bigint, tie string, kind string, code string, clk string, team_id string, player_id string"
CODES = {
    "START": ["INICIO-PERIODO"], "END": ["FINAL-PERIODO", "FINAL-PARTIDO"], "IN": ["CAMBIO-JUGADOR-ENTRA"],
    "OUT": ["CAMBIO-JUGADOR-SALE"], "IGNORE": ["FALTA-RECIBIDA", "1-TIRO-LIBRE"],
    "PLAY": ["CANASTA-2P", "CANASTA-3P", "TECNICA", "TIRO1-FALLADO", "SALTO", "ASISTENCIA"],
}


def random_log(seed, matches, events, weights=(6, 5, 22, 14, 4, 49)):
    rng = random.Random(seed)
    rows = []
    for m in range(matches):
        for i in range(events):
            kind = rng.choices(["START", "END", "IN", "OUT", "IGNORE", "PLAY"], weights)[0]
            rows.append((
                f"m{m}", i // 2, f"{i:06d}", kind, rng.choice(CODES[kind]), f"00:{rng.randint(0, 9):02d}:{rng.randint(0, 59):02d}.0",
                rng.choice(["H", "A", None]), rng.choice([None, "a", "b", "c", "d", "e", "f"]),
            ))
    return rows


def expected(rows):
    stints, facts, teams = set(), {}, {}
    by_match = {}
    for r in rows:
        by_match.setdefault(r[0], []).append(r)
    for m, group in by_match.items():
        group.sort(key=lambda r: (r[1], r[2]))
        dicts = [dict(kind=r[3], code=r[4], clk=r[5], home=r[6] == "H", player_id=r[7]) for r in group]
        s, f, t = play_match(dicts, SCORING)
        stints |= {(m, *x) for x in s}
        for sid, home, player, stats in f:
            facts[(m, sid, "H" if home else "A", player)] = tuple(stats.get(k, 0) for k in STATS)
        for sid, stats in t:
            teams[(m, sid)] = tuple(stats.get(p + k, 0) for p in ("h_", "a_") for k in STATS)
    return stints, facts, teams


def run(spark, rows, matches, chunk_rows):
    log = spark.createDataFrame(rows, LOG)
    sides = spark.createDataFrame([(f"m{m}", "H", "A") for m in range(matches)], "match_id string, home_id string, away_id string")
    tables = stint_tables(log.repartition(3), sides, chunk_rows=chunk_rows).keep()
    stints = {(r.match_id, r.stint_id, r.nperiod, r.start_clk, r.end_clk) for r in tables.stints().collect()}
    fact_rows = tables.player_stints().collect()
    facts = {(r.match_id, r.stint_id, r.team_id, r.player_id): tuple(r[s] for s in STATS) for r in fact_rows}
    team_rows = tables.team_stints().collect()
    teams = {(r.match_id, r.stint_id): tuple(r[p + s] for p in ("h_", "a_") for s in STATS) for r in team_rows}
    tables.release()
    assert len(fact_rows) == len(facts) and len(team_rows) == len(teams)
    return stints, facts, teams


@pytest.mark.parametrize("seed,matches,events,chunk_rows", [
    (1, 40, 120, 1_000_000),
    (2, 12, 80, 10),        # every match is cut into pieces
    (3, 1, 1500, 37),       # one match holds the whole log
    (4, 2, 60, 1),
])
def test_random_logs_follow_the_rules(spark, seed, matches, events, chunk_rows):
    rows = random_log(seed, matches, events)
    assert run(spark, rows, matches, chunk_rows) == expected(rows)


def test_one_hot_match_among_ordinary_ones(spark):
    rows = random_log(5, 10, 60)
    rows += [("m3", r[1] + 100, r[2] + "x", *r[3:]) for r in random_log(6, 1, 700)]
    assert run(spark, rows, 10, 200) == expected(rows)


@pytest.mark.parametrize("weights", [(1, 0, 40, 40, 1, 18), (0, 3, 40, 20, 1, 36), (10, 30, 30, 10, 1, 19)])
def test_lopsided_logs_in_pieces(spark, weights):
    rows = random_log(sum(weights) + weights[0], 3, 400, weights)
    assert run(spark, rows, 3, 25) == expected(rows)


GOLDEN = [
    ("CAMBIO-JUGADOR-ENTRA", "H", "p1", "00:10:00.0"), ("CAMBIO-JUGADOR-ENTRA", "A", "q1", "00:10:00.0"),
    ("INICIO-PERIODO", None, None, "00:10:00.0"), ("CANASTA-2P", "H", "p1", "00:09:30.0"),
    ("CAMBIO-JUGADOR-SALE", "H", "p1", "00:08:00.0"), ("CAMBIO-JUGADOR-ENTRA", "H", "p2", "00:08:00.0"),
    ("FALTA-RECIBIDA", "H", "p2", "00:08:00.0"), ("TIRO3-FALLADO", "A", "q1", "00:07:50.0"),
    ("CANASTA-1P", "H", "p1", "00:07:00.0"), ("FINAL-PERIODO", None, None, "00:00:00.0"),
    ("TIRO1-FALLADO", "H", "p2", "00:00:00.0"), ("CAMBIO-JUGADOR-ENTRA", "H", "p1", "00:10:00.0"),
    ("CAMBIO-JUGADOR-ENTRA", "A", "q1", "00:10:00.0"), ("TECNICA", "A", "q1", "00:00:00.0"),
    ("INICIO-PERIODO", None, None, "00:10:00.0"), ("CANASTA-3P", "A", "q1", "00:05:00.0"),
    ("CAMBIO-JUGADOR-SALE", "A", "q1", "00:01:00.0"), ("FINAL-PERIODO", None, None, "00:00:00.0"),
    ("FINAL-PARTIDO", None, None, "00:00:00.0"),
]


@pytest.mark.parametrize("chunk_rows", [1_000_000, 4])
def test_hand_worked_match(spark, chunk_rows):
    rows = [("g", i + 1, str(i), c, clk, t, p) for i, (c, t, p, clk) in enumerate(GOLDEN)]
    log = spark.createDataFrame(rows, "match_id string, seq bigint, tie string, code string, clk string, team_id string, player_id string")
    log = log.withColumn("kind", event_kind(F.col("code")))
    sides = spark.createDataFrame([("g", "H", "A")], "match_id string, home_id string, away_id string")
    tables = stint_tables(log, sides, chunk_rows=chunk_rows)
    stints = sorted(map(tuple, tables.stints().drop("match_id").collect()))
    assert stints == [
        (0, 1, "00:10:00.0", "00:07:50.0", 130.0),
        (1, 1, "00:07:50.0", "00:00:00.0", 470.0),
        (3, 2, "00:10:00.0", "00:00:00.0", 600.0),
    ]
    facts = {
        (r.stint_id, r.team_id, r.player_id): {s: r[s] for s in STATS if r[s]} for r in tables.player_stints().collect()
    }
    assert facts == {
        (0, "H", "p1"): {"pts": 2, "fg2m": 1, "fg2a": 1}, (0, "A", "q1"): {},
        (1, "H", "p2"): {"fg1m": 1, "fta": 1}, (1, "A", "q1"): {"fg3a": 1, "tech": 1, "pf": 1},
        (3, "H", "p1"): {}, (3, "A", "q1"): {"pts": 3, "fg3m": 1, "fg3a": 1},
    }
    box = {r.player_id: r.pts for r in box_score(log).collect()}
    assert box == {"p1": 3, "p2": 0, "q1": 3}
    lineups = {r.stint_id: (r.home_lineup, r.away_lineup) for r in tables.team_stints(with_lineups=True).collect()}
    assert lineups == {0: (["p1"], ["q1"]), 1: (["p2"], ["q1"]), 3: (["p1"], ["q1"])}
