import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline.plans.bronze import run_bronze, store_documents
from ledgerline.plans.gold import career_totals, run_gold
from ledgerline.plans.silver import run_silver, unmapped_report
from ledgerline.sources.tables import Paths, read_table
from ledgerline.streaming.incremental import run_available
from tests.test_stints import GOLDEN

SEASON = "liganacional20232024_basketball"
NAMESPACE = uuid.UUID("dbb2ab43-b733-59f3-a2e8-17defebfcdaf")


def uid(text):
    return str(uuid.uuid5(NAMESPACE, text))


def document(home, away, home_id="11", away_id="22", status="FINALIZADO", points=(70, 60), events=None, players=None, error=""):
    events = events or []
    return {
        "resultado": "correcto", "error": error,
        "partido": {
            "estado_partido": status, "local": home, "visitante": away, "idlocal": home_id, "idvisitante": away_id,
            "tanteo_local": points[0], "tanteo_visitante": points[1], "numperiodos_total": 4,
        },
        "envivo": {"historialacciones": events},
        "EnVivoJugadoresOTT": {
            "JugadoresEnVivoLocal": [{"IdJugador": i, "Nombre": n, "IdJugadorFoto": "f"} for i, n in (players or {}).items()],
            "JugadoresEnVivoVisitante": None,
        },
    }


IDS = {"H": "11", "A": "22", None: "-1", "p1": "101", "p2": "102", "q1": "103"}
PLAYERS = {101: "Gómez, Juan", 102: "GOMEZ ANIBAL", 103: "NOMBRE"}


def golden_events():
    return [
        {
            "autoincremental_id": i + 1, "equipo_id": IDS[t], "componente_id": IDS[p], "numero_periodo": 1,
            "tiempo_partido": clk, "accion_tipo": c, "posicion_x": 1.5, "posicion_y": None, "dorsal": "-1",
        }
        for i, (c, t, p, clk) in enumerate(GOLDEN)
    ]


def put(base, folder, raw_id, content):
    path = f"{base}/raw/{folder}/{raw_id}.json"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(content if isinstance(content, str) else json.dumps(content, ensure_ascii=False, indent=4))


def as_rows(df):
    return sorted(json.dumps(r.asDict(recursive=True), default=str, sort_keys=True) for r in df.collect())


def rows(spark, path):
    return as_rows(read_table(spark, path))


@pytest.fixture(scope="module")
def zone(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("zone"))
    put(base, f"pbp_{SEASON}", "m1_202401052100", document("Club Átenas", "Boca", events=golden_events(), players=PLAYERS))
    put(base, f"agg_by_team_{SEASON}", "m1_202401052100", {"any": 1})
    put(base, f"pbp_{SEASON}", "m2_202401061900", document("Boca", "Club Atenas", "0", "", points=(50, 50)))
    put(base, f"pbp_{SEASON}", "m3_202401071900", document("Nuevo Club", "Boca", None, "22.0", points=("x", 3)))
    put(base, f"pbp_{SEASON}", "m4_202401081900", document("Error FC", "Boca", error="sin datos"))
    put(base, f"pbp_{SEASON}", "m5_202401091900", document("Boca", "Otro", "22", "33", status="SUSPENDIDO", events=golden_events()[:3]))
    put(base, f"agg_by_player_{SEASON}", "m6_202401101900", {"any": 2})
    put(base, f"pbp_{SEASON}", "m7_202401111900", "{broken")
    put(base, "profiles", "p", {"token": 1})
    put(base, "upcoming", "m1_202401052000", document("Club Atenas", "BOCA", status="NO_COMENZADO", points=(0, 0)))
    put(base, "upcoming", "u1_202402012100", document("Boca", "Club Atenas", "22", "11", status="NO_COMENZADO", points=(0, 0)))
    return Paths(base)


def test_silver_then_gold(spark, zone):
    counts = run_silver(spark, zone)
    assert counts["matches"] == 3 and counts["upcoming_matches"] == 1 and counts["unmapped_events"] == 3
    assert counts["unreadable_files"] == 1 and counts["events"] == len(GOLDEN) and counts["duplicate_events"] == 0
    assert counts["bad_clocks"] == 0 and counts["unknown_teams"] == 0 and counts["unknown_players"] == 0
    report = unmapped_report(spark, zone).first()
    assert (report["events"], report["keys"], report["sample"]) == (3, 1, "m5_202401091900")
    match = uid("MATCH_20240105_CLUB ATENAS_BOCA")
    matches = {r.match_id: r for r in read_table(spark, zone.curated("matches")).collect()}
    assert matches[match].status == "FINALIZADO" and matches[match].total_duration_mm == 10
    assert matches[match].home_id == uid("TEAM_CLUB ATENAS") and str(matches[match].date) == "2024-01-05 21:00:00"
    swapped = matches[uid("MATCH_20240106_BOCA_CLUB ATENAS")]
    # A missing id is found by name; "Club Atenas" is not written like the known "Club Átenas".
    assert swapped.home_id == uid("TEAM_BOCA") and swapped.away_id == uid("TEAM_CLUB ATENAS")
    new_club = matches[uid("MATCH_20240107_NUEVO CLUB_BOCA")]
    assert new_club.home_id == uid("TEAM_NUEVO CLUB") and new_club.away_id == uid("TEAM_BOCA")
    teams = {r.team_name for r in read_table(spark, zone.curated("teams")).collect()}
    assert teams == {"CLUB ATENAS", "BOCA", "NUEVO CLUB", "OTRO"}
    players = {r.player_id: r.player_name for r in read_table(spark, zone.curated("players")).collect()}
    assert players == {uid("PLAYER_GOMEZ JUAN"): "GOMEZ JUAN", uid("PLAYER_GOMEZ ANIBAL"): "GOMEZ ANIBAL", "UNKNOWN_103": "NOMBRE"}
    comps = {r.comp_name for r in read_table(spark, zone.curated("competitions")).collect()}
    assert comps == {"liganacional20232024", "upcoming"}
    events = read_table(spark, zone.curated("pbps"))
    assert events.count() == len(GOLDEN) and events.filter("jersey is not null").count() == 0
    first = events.filter("seq = 4").first()
    assert first.pbp_id == uid(f"{match}_1_00:09:30_4_CANASTA-2P") and first.x == 1.5

    gold = run_gold(spark, zone)
    assert gold["dim_stint"] == 3 and gold["fact_player_stints"] == 6 and gold["dim_match"] == 3
    results = {r.match_id: r.result for r in read_table(spark, zone.analytics("dim_match")).collect()}
    assert results[match] == "HOME_WIN" and set(results.values()) == {"HOME_WIN", "UNKNOWN"}
    fact = read_table(spark, zone.analytics("fact_player_stints"))
    total = fact.groupBy("player_id").agg(F.sum("pts").alias("pts")).collect()
    assert rows(spark, zone.analytics("agg_player")) == as_rows(career_totals(fact))
    assert {r.player_id: r.pts for r in total} == {uid("PLAYER_GOMEZ JUAN"): 2, uid("PLAYER_GOMEZ ANIBAL"): 0, "UNKNOWN_103": 3}


TABLES = ("teams", "players", "competitions", "matches", "upcoming_matches", "pbps")


def test_runs_are_repeatable_and_incremental(spark, zone):
    before = {t: rows(spark, zone.curated(t)) for t in TABLES}
    gold_before = rows(spark, zone.analytics("fact_player_stints"))
    # Only the upcoming folder is read again, and on request the file that could not be read.
    counts = run_silver(spark, zone)
    assert counts["files"] == 2 and counts["unreadable_files"] == 0
    counts = run_silver(spark, zone, retry_unreadable=True)
    assert counts["files"] == 3 and counts["unreadable_files"] == 1
    run_gold(spark, zone)
    assert {t: rows(spark, zone.curated(t)) for t in TABLES} == before
    assert rows(spark, zone.analytics("fact_player_stints")) == gold_before
    run_gold(spark, zone, since="2024-01-01")
    assert rows(spark, zone.analytics("fact_player_stints")) == gold_before


def test_upcoming_match_becomes_played(spark, zone):
    base = zone.base
    put(base, f"pbp_{SEASON}", "u1_202402012100", document("Boca", "Club Atenas", "22", "11", points=(80, 90)))
    counts = run_silver(spark, zone)
    assert counts["upcoming_matches"] == 0 and counts["matches"] == 4
    put(base, f"pbp_{SEASON}", "u1_202402012100", document("Boca", "Club Atenas", "22", "11", points=(81, 90)))
    os.utime(f"{base}/raw/pbp_{SEASON}/u1_202402012100.json", (2_000_000_000, 2_000_000_000))
    run_silver(spark, zone)
    scores = [r.home_pts for r in read_table(spark, zone.curated("matches")).filter("date >= '2024-02-01'").collect()]
    assert scores == [81]


def test_stream_gives_the_same_tables(spark, zone, tmp_path):
    import shutil

    base = str(tmp_path / "copy")
    shutil.copytree(f"{zone.base}/raw", f"{base}/raw", ignore=shutil.ignore_patterns("_state", "upcoming"))
    streamed, batch = Paths(base), Paths(str(tmp_path / "batch"))
    shutil.copytree(f"{base}/raw", f"{batch.base}/raw")
    run_available(spark, streamed, str(tmp_path / "checkpoint"))
    run_silver(spark, batch)
    for table in ("teams", "players", "matches", "pbps"):
        assert rows(spark, streamed.curated(table)) == rows(spark, batch.curated(table))


def kept_aside(spark, paths, table="unmapped_events"):
    return sorted(r.file_id for r in read_table(spark, paths.curated(table)).collect())


@pytest.mark.parametrize("streamed", [False, True])
def test_nothing_is_lost(spark, tmp_path, streamed):
    paths = Paths(str(tmp_path / "zone"))

    def run():
        if streamed:
            run_available(spark, paths, str(tmp_path / "checkpoint"))
        else:
            run_silver(spark, paths)

    folder = f"pbp_{SEASON}"
    put(paths.base, folder, "m1_202401052100", document("Club A", "Club B", events=golden_events(), players=PLAYERS))
    put(paths.base, folder, "m2_202401062100", document("Club A", "Club B", status="SUSPENDIDO", events=golden_events()[:2]))
    put(paths.base, folder, "m3_notime", document("Club A", "Club C", events=golden_events()[:1], points=(99999999999, 1)))
    run()
    assert kept_aside(spark, paths) == ["m2_202401062100"] * 2 + ["m3_notime"]
    assert kept_aside(spark, paths, "undated_matches") == ["m3_notime"]
    assert {"clk", "player_raw_id", "position"} <= set(read_table(spark, paths.curated("unmapped_events")).columns)

    # Another file to put aside, an old one, and a new version of one that was put aside.
    put(paths.base, folder, "m4_202401072100", document("Club A", "Club B", status="SUSPENDIDO", events=golden_events()[:1]))
    put(paths.base, folder, "m5_202312012100", document("Club B", "Club A", "22", "11", points=(1, 2)))
    os.utime(f"{paths.raw}/{folder}/m5_202312012100.json", (1_500_000_000, 1_500_000_000))
    put(paths.base, folder, "m2_202401062100", document("Club A", "Club B", points=(7, 8), events=golden_events()[:2]))
    os.utime(f"{paths.raw}/{folder}/m2_202401062100.json", (2_000_000_000, 2_000_000_000))
    run()
    assert kept_aside(spark, paths) == ["m3_notime", "m4_202401072100"]
    scores = {(r.home_pts, r.away_pts) for r in read_table(spark, paths.curated("matches")).collect()}
    assert scores == {(70, 60), (7, 8), (1, 2)}
    assert read_table(spark, paths.curated("pbps")).count() == len(GOLDEN) + 2


def test_fixtures_under_their_season(spark, zone):
    from ledgerline.plans.silver import normalise
    from ledgerline.sources.raw import list_files, read_new

    raw = read_new(spark, list_files(spark, zone.raw))
    silver = normalise(raw, derive_competition=True)
    assert [r.comp_name for r in silver.competitions.collect()] == ["liganacional20232024"]
    assert silver.matches.filter("id_comp is null").count() == 0


def test_bronze(spark, tmp_path):
    zone = Paths(str(tmp_path))
    put(zone.base, "upcoming", "old_202301012100", {"x": 1})
    put(zone.base, f"pbp_{SEASON}", "f1_202401012100", document("A", "B"))
    put(zone.base, f"agg_by_team_{SEASON}", "f1_202401012100", {"partido": {"estado_partido": "EN_JUEGO"}})
    fixtures = spark.createDataFrame(
        [
            ("f1_202401012100", "Terminado", 1, "1", "2", "A", "B"), ("u1_202409012100", "No comenzado", 2, "1", None, "A", "Ñandú"),
            ("x_202409012100", "Suspendido", 3, "1", "2", "A", "B"),
        ],
        "raw_id string, Estado string, IdPartido bigint, IdEquipoLocal string, IdEquipoVisitante string, "
        "NombreEquipoLocal string, NombreEquipoVisitante string",
    )
    pending = run_bronze(spark, zone, fixtures, SEASON)
    assert {(r.folder, r.raw_id, r.IdPartido) for r in pending.collect()} == {
        (f"agg_by_player_{SEASON}", "f1_202401012100", 1), (f"agg_by_team_{SEASON}", "f1_202401012100", 1),
    }
    assert os.listdir(f"{zone.raw}/upcoming") in (["u1_202409012100.json"], ["u1_202409012100.json", ".u1_202409012100.json.crc"])
    stored = json.load(open(f"{zone.raw}/upcoming/u1_202409012100.json", encoding="utf-8"))
    assert stored["partido"]["visitante"] == "Ñandú" and stored["partido"]["idvisitante"] == ""
    assert stored["partido"]["estado_partido"] == "NO_COMENZADO" and stored["envivo"]["historialacciones"] == []
    done = json.dumps({"partido": {"estado_partido": "FINALIZADO"}})
    assert store_documents(zone, pending.withColumn("payload", F.lit(done))) == 2
    assert run_bronze(spark, zone, fixtures, SEASON).count() == 0


def opened(monkeypatch):
    """The paths of all scans of raw documents from now on."""
    from ledgerline.sources import raw

    seen = []
    scan = raw.read_files

    def watched(spark, files):
        found = scan(spark, files)
        seen.extend(found.inputFiles())
        return found

    monkeypatch.setattr(raw, "read_files", watched)
    return seen


@pytest.mark.parametrize("streamed", [False, True])
def test_only_new_files_are_opened(spark, tmp_path, monkeypatch, streamed):
    paths, folder = Paths(str(tmp_path / "zone")), f"pbp_{SEASON}"
    odd = "m 1%20[x]{y}_202401052100"  # to be read as it is, not as a pattern or an encoded path
    put(paths.base, folder, odd, document("Club A", "Club B", events=golden_events(), players=PLAYERS))
    put(paths.base, folder, "broken_202401042100", "{no json")
    put(paths.base, f"agg_by_team_{SEASON}", "m1_202401052100", {"any": 1})
    os.utime(f"{paths.raw}/{folder}/broken_202401042100.json", (1_500_000_000, 1_500_000_000))
    seen = opened(monkeypatch)

    def run():
        seen.clear()
        if streamed:
            run_available(spark, paths, str(tmp_path / "checkpoint"), files_per_batch=1)
        else:
            run_silver(spark, paths)
        return len(seen)

    assert run() == 2
    assert [r.home_pts for r in read_table(spark, paths.curated("matches")).collect()] == [70]
    # The old file that cannot be read and the one of another type are not opened again.
    assert run() == 0
    put(paths.base, folder, "m2_202401062100", document("Club A", "Club B"))
    put(paths.base, folder, "m3_202401072100", document("Club B", "Club A", "22", "11"))
    os.utime(f"{paths.raw}/{folder}/m3_202401072100.json", (1_400_000_000, 1_400_000_000))
    assert run() == 2
    put(paths.base, folder, "broken_202401042100", document("Club A", "Club B", points=(5, 6)))
    assert run() == 1
    assert read_table(spark, paths.curated("matches")).count() == 4
    if streamed:
        assert len([n for n in os.listdir(paths.feed) if n.endswith(".parquet")]) <= 2


def test_a_failed_batch_comes_again(spark, tmp_path, monkeypatch):
    from ledgerline.streaming import incremental

    paths, folder = Paths(str(tmp_path / "zone")), f"pbp_{SEASON}"
    put(paths.base, folder, "m1_202401052100", document("Club A", "Club B"))
    with monkeypatch.context() as patch:
        def fail(*args, **kwargs):
            raise RuntimeError("lost")

        patch.setattr(incremental, "load", fail)
        with pytest.raises(Exception):
            run_available(spark, paths, str(tmp_path / "checkpoint"))
    # A new checkpoint stands for a feed file that Spark has forgotten.
    for checkpoint in ("checkpoint", "other"):
        run_available(spark, paths, str(tmp_path / checkpoint))
        assert read_table(spark, paths.curated("matches")).count() == 1
    assert read_table(spark, paths.registry).count() == 1


def test_status_is_read_once_per_version(spark, tmp_path, monkeypatch):
    from ledgerline.sources import raw

    zone = Paths(str(tmp_path))
    for i in range(3):
        put(zone.base, f"pbp_{SEASON}", f"f{i}_202401012100", document("A", "B", status="EN_JUEGO" if i else "FINALIZADO"))
    wanted = spark.createDataFrame([(f"f{i}_202401012100",) for i in range(2)], "raw_id string")
    seen = opened(monkeypatch)

    def status(candidates=None):
        seen.clear()
        found = raw.stored_status(spark, zone.raw, zone.statuses, SEASON, candidates)
        return {r.raw_id[:2]: r.status for r in found.collect()}, len(seen)

    assert status(wanted) == ({"f0": "FINALIZADO", "f1": "EN_JUEGO"}, 2)
    assert status(wanted) == ({"f0": "FINALIZADO", "f1": "EN_JUEGO"}, 0)
    assert status() == ({"f0": "FINALIZADO", "f1": "EN_JUEGO", "f2": "EN_JUEGO"}, 1)
    put(zone.base, f"pbp_{SEASON}", "f1_202401012100", document("A", "B"))
    os.utime(f"{zone.raw}/pbp_{SEASON}/f1_202401012100.json", (2_000_000_000, 2_000_000_000))
    assert status() == ({"f0": "FINALIZADO", "f1": "FINALIZADO", "f2": "EN_JUEGO"}, 1)


def test_registry_is_compacted(spark, tmp_path, monkeypatch):
    from ledgerline.sources import raw, tables

    monkeypatch.setattr(raw, "COMPACT_AFTER", 3)
    path = str(tmp_path / "registry")
    for i in range(1, 8):
        rows = spark.createDataFrame([("a", i), (f"b{i}", 1), ("/upcoming/c", 1)], "path string, at int")
        files = rows.select("path", F.timestamp_seconds("at").alias("modification_time"), F.lit("loaded").alias("status"))
        raw.register(spark, path, files)
        raw.register(spark, path, files)
    stored = tables.read_table(spark, path)
    newest = stored.filter("path = 'a'").agg(F.max("modification_time").cast("long")).first()[0]
    assert newest == 7 and stored.filter("path like 'b%'").count() == 7 and stored.filter("path like '%upcoming%'").count() == 0
    assert len(tables._manifest(spark, path).folders[""]) <= 4


@pytest.mark.parametrize("fault", ["team twice", "player twice", "match twice", "player without an id"])
def test_a_fault_stops_the_run_before_any_table_changes(spark, tmp_path, monkeypatch, fault):
    from ledgerline.operators.quality import CheckFailed
    from ledgerline.plans import silver

    paths = Paths(str(tmp_path / "zone"))
    put(paths.base, f"pbp_{SEASON}", "m1_202401052100", document("Club A", "Club B", events=golden_events(), players=PLAYERS))
    run_silver(spark, paths)
    tables = [*TABLES, "unmapped_events"]
    before = {t: rows(spark, paths.curated(t)) for t in tables}
    put(paths.base, f"pbp_{SEASON}", "m2_202401062100", document("Club A", "Club B", events=golden_events(), players=PLAYERS))
    name, place = {"team": ("team_tables", 1), "player": ("resolve_players", 1), "match": ("match_tables", 1)}[fault.split()[0]]
    own = getattr(silver, name)

    def planted(*args, **kwargs):
        found = list(own(*args, **kwargs))
        found[place] = found[place].unionByName(found[place]) if "twice" in fault else found[place].withColumn("player_id", F.lit(None).cast("string"))
        return tuple(found)

    with monkeypatch.context() as patch:
        patch.setattr(silver, name, planted)
        with pytest.raises(CheckFailed):
            run_silver(spark, paths)
    assert {t: rows(spark, paths.curated(t)) for t in tables} == before
    assert run_silver(spark, paths)["files"] == 1 and read_table(spark, paths.curated("matches")).count() == 2


def test_rollups_of_touched_days_equal_a_full_run(spark, tmp_path):
    paths = Paths(str(tmp_path / "zone"))
    for day in range(1, 5):
        put(paths.base, f"pbp_{SEASON}", f"m{day}_2024010{day}2100", document(f"Club {day}", "Club B", f"{10 + day}", "22", events=golden_events(), players=PLAYERS))
    run_silver(spark, paths)
    run_gold(spark, paths)
    # One day changes, one comes and one loses its events.
    put(paths.base, f"pbp_{SEASON}", "m3_202401032100", document("Club 3", "Club B", "13", "22", events=golden_events()[:-3], players=PLAYERS))
    os.utime(f"{paths.raw}/pbp_{SEASON}/m3_202401032100.json", (2_000_000_000, 2_000_000_000))
    put(paths.base, f"pbp_{SEASON}", "m5_202401052100", document("Club 5", "Club B", "15", "22", events=golden_events(), players=PLAYERS))
    run_silver(spark, paths)
    names = ("fact_player_stints", "dim_stint", "agg_match_team", "agg_player_day", "agg_player", "dim_match")
    run_gold(spark, paths, since="2024-01-03")
    partial = {n: rows(spark, paths.analytics(n)) for n in names}
    run_gold(spark, paths)
    assert partial == {n: rows(spark, paths.analytics(n)) for n in names}
    facts = read_table(spark, paths.analytics("fact_player_stints"))
    assert partial["agg_player"] == as_rows(career_totals(facts)) and facts.select("match_day").distinct().count() == 5


def test_names_are_clustered_across_batches(spark, tmp_path):
    from ledgerline.operators.resolve import name_clusters

    paths, folder = Paths(str(tmp_path / "zone")), f"pbp_{SEASON}"
    spelled = [{1: "Gomez, Juan Carlos", 2: "Perez Ana"}, {3: "JUAN CARLOS GOMEZ", 4: "Lopez, Luis"}, {5: "GOMEZ JUAN", 6: "Lopez, Luis Alberto"}]
    for day, players in enumerate(spelled, 1):
        put(paths.base, folder, f"m{day}_2024010{day}2100", document("Club A", "Club B", players=players))
        run_silver(spark, paths, seed_names=True)
    kept = {r.name: r.component for r in read_table(spark, paths.curated("name_clusters")).collect()}
    names = spark.createDataFrame([(n,) for n in kept], "name string")
    assert kept == {r.name: r.component for r in name_clusters(names).collect()}
    assert len(set(kept.values())) == 3
