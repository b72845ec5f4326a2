"""Raw documents to normalised tables: competitions, teams, players, matches and events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import ids
from ledgerline.functions.calendar import clock_seconds, file_timestamp, season_id
from ledgerline.functions.text import clean_text
from ledgerline.operators.dedup import by_priority, first_per_key
from ledgerline.operators.lookups import fallback_team_ids, lookup, unmapped_summary
from ledgerline.operators.payloads import (
    EVENT_COLUMNS,
    FINISHED,
    MATCH_COLUMNS,
    NOT_STARTED,
    both,
    explode_items,
    renamed,
    split_played,
    whole_number,
    with_defaults,
    without_errors,
)
from ledgerline.operators.quality import write_checked, write_unique
from ledgerline.operators.resolve import extend_clusters, name_clusters, resolve_players
from ledgerline.session import cut_lineage, own_scratch, write_out
from ledgerline.sources import raw as raw_zone
from ledgerline.sources import tables
from ledgerline.sources.tables import Paths

# Storage partition of the large tables: the day of the match. It follows from the match
# id, so a batch of new matches rewrites their days and nothing else.
DAY = "match_day"
# Payload order: competitions by name with upcoming fixtures last, then files by name.
FILE_ORDER = ["is_upcoming", "competition", "file_id"]


@dataclass
class Silver:
    competitions: DataFrame
    teams: DataFrame
    players: DataFrame
    matches: DataFrame
    events: DataFrame
    unmapped_events: DataFrame
    undated_matches: DataFrame
    docs: DataFrame
    checks: dict[str, int]
    # Clusters of all spellings met so far, if they are kept.
    clusters: DataFrame | None = None


def documents(raw: DataFrame, derive_competition: bool = False) -> DataFrame:
    """Parse play-by-play payloads once and write them out, so that every table is derived
    from the same state of the raw zone. Unreadable documents are left out; ``unreadable``
    names them."""
    is_upcoming = F.col("competition") == raw_zone.UPCOMING
    competition = F.col("competition")
    if derive_competition:
        season = F.replace(season_id(file_timestamp(F.col("raw_id"))), F.lit(raw_zone.SEASON_SUFFIX), F.lit(""))
        competition = F.when(is_upcoming, season).otherwise(competition)
    parsed = (
        raw.filter(F.col("data_type") == "pbp")
        .withColumn("doc", F.from_json("payload", schemas.RAW_DOCUMENT))
        .filter(F.col("doc.partido").isNotNull() | F.col("doc.error").isNotNull())
        .select(
            competition.alias("competition"), F.col("raw_id").alias("file_id"), is_upcoming.alias("is_upcoming"),
            F.col("path") if "path" in raw.columns else F.lit(None).cast("string").alias("path"), "doc.*",
            F.greatest(F.size("doc.envivo.historialacciones"), F.lit(0)).alias("n_events"),
        )
    )
    return write_out(parsed)


def unreadable(files: DataFrame, docs: DataFrame) -> DataFrame:
    """Paths of play-by-play files that gave no document: empty or not in the known form."""
    listed = raw_zone.with_path_parts(files).filter(F.col("data_type") == "pbp")
    return listed.join(docs.select("path"), "path", "left_anti").select("path")


def competitions(docs: DataFrame) -> DataFrame:
    named = docs.groupBy(F.col("competition").alias("comp_name")).agg(F.min("is_upcoming").alias("is_upcoming"))
    keyed = named.withColumn("id_comp", ids.competition_id(F.col("comp_name")))
    return first_per_key(keyed, ["id_comp"], ["is_upcoming", "comp_name"]).select("comp_name", "id_comp")


def raw_matches(docs: DataFrame) -> DataFrame:
    info = without_errors(docs, F.col("error")).select(
        *FILE_ORDER, "n_events",
        F.col("partido.local").alias("home_name"),
        F.col("partido.visitante").alias("away_name"),
        ids.clean_id(F.col("partido.idlocal")).alias("home_raw"),
        ids.clean_id(F.col("partido.idvisitante")).alias("away_raw"),
        *[F.col(f"partido.{raw}").alias(name) for raw, name in MATCH_COLUMNS.items()],
    )
    numbers = [name for name in MATCH_COLUMNS.values() if name != "status"]
    return info.withColumns({name: whole_number(F.col(name)).try_cast("int") for name in numbers})


def team_tables(teams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Teams ``(team_id, team_name)`` and the lookup ``(raw_id, team_id)``."""
    order = [*FILE_ORDER, "side_rank"]
    named = teams.withColumn("team_name", clean_text(F.col("team_name")))
    named = named.withColumn("team_id", ids.team_id(F.col("team_name")))
    final = first_per_key(named, ["team_id"], order).select("team_id", "team_name")
    return final, named.select("raw_id", "team_id")


def match_tables(matches: DataFrame, comps: DataFrame, team_lookup: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Matches, one per id, the lookup from a document to ``(match_id, date, n_events)`` of the rows
    kept, and the matches whose file name has no readable time and which so have no id."""
    dated = matches.withColumn("date", file_timestamp(F.col("file_id")))
    dated = lookup(dated, comps, "competition", "comp_name", {"id_comp": "id_comp"})
    dated = lookup(dated, team_lookup, "home_raw", "raw_id", {"team_id": "home_id"})
    dated = lookup(dated, team_lookup, "away_raw", "raw_id", {"team_id": "away_id"})
    keyed = dated.withColumn(
        "match_id", ids.match_id(_text(F.col("home_name")), _text(F.col("away_name")), F.col("date"))
    )
    identified = keyed.filter(F.col("match_id").isNotNull())
    kept = by_priority(identified, ["match_id"], "status", [FINISHED, NOT_STARTED], FILE_ORDER)
    kept = with_defaults(kept)
    undated = keyed.filter(F.col("match_id").isNull()).select(*FILE_ORDER, "home_name", "away_name", "status")
    return kept.select(*schemas.MATCH_TABLE), kept.select(*FILE_ORDER, "match_id", "date", "n_events"), undated


def _text(name):
    return F.coalesce(name, F.lit("None"))


def raw_players(docs: DataFrame) -> DataFrame:
    """Players listed by either side; ``order`` columns give their place in the payload."""
    listed = both(F.col("EnVivoJugadoresOTT.JugadoresEnVivoLocal"), F.col("EnVivoJugadoresOTT.JugadoresEnVivoVisitante"))
    items = explode_items(without_errors(docs, F.col("error")), listed, *FILE_ORDER)
    return items.select(
        F.col("IdJugador").alias("raw_id"), F.col("Nombre").alias("player_name"), *FILE_ORDER, "position"
    )


def raw_events(docs: DataFrame, *keep: str) -> DataFrame:
    """Events of every document in payload order, with the ``keep`` columns of the document."""
    kept = without_errors(docs, F.col("error"))
    items = explode_items(kept, F.col("envivo.historialacciones"), *FILE_ORDER, *keep)
    events = renamed(items, EVENT_COLUMNS, *FILE_ORDER, *keep, "position")
    return events.withColumns({
        "seq": whole_number(F.col("seq")),
        "period": whole_number(F.col("period")).try_cast("int"),
        "x": F.col("x").try_cast("double"),
        "y": F.col("y").try_cast("double"),
        "jersey": ids.sentinel_to_null(F.col("jersey")),
        "team_raw_id": ids.sentinel_to_null(F.col("team_raw_id")),
        "player_raw_id": ids.sentinel_to_null(F.col("player_raw_id")),
    })


def event_tables(
    docs: DataFrame, team_lookup: DataFrame, player_lookup: DataFrame, match_lookup: DataFrame
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Resolved events, one per id, the events whose match is not known, and counts: events, clocks
    that cannot be read, teams and players that no lookup knows.

    All events of a document belong to one match, so the match is looked up per document
    and not per event. A team or player that the lookups do not know becomes null; one that they
    know and give no id, or an event without a match, is an error. The counts and these checks
    ride on the write of the events.
    """
    dated = match_lookup.withColumn(DAY, F.to_date("date")).drop("date", "n_events")
    events = raw_events(docs.join(dated, FILE_ORDER), "match_id", DAY)
    team = {"team_id": "team_id", "raw_id": "_known_team"}
    player = {"player_id": "player_id", "raw_id": "_known_player"}
    resolved = lookup(events, team_lookup, "team_raw_id", "raw_id", team)
    resolved = lookup(resolved, player_lookup, "player_raw_id", "raw_id", player)
    keyed = resolved.withColumn(
        "pbp_id",
        ids.event_id(F.col("match_id"), F.col("period"), F.col("clk"), F.col("seq"), F.col("event_type")),
    )
    unknown = lambda kind: F.count_if(F.col(f"{kind}_raw_id").isNotNull() & F.col(f"_known_{kind}").isNull())
    unresolved = lambda kind: F.count_if(F.col(f"_known_{kind}").isNotNull() & F.col(f"{kind}_id").isNull())
    unique, checks = write_checked(
        first_per_key(keyed, ["pbp_id"], [*FILE_ORDER, "position"]),
        {
            "events": F.count("*"), "bad_clocks": F.count_if(clock_seconds(F.col("clk")).isNull()),
            "unknown_teams": unknown("team"), "unknown_players": unknown("player"),
        },
        {
            "known players without an id": unresolved("player"), "known teams without an id": unresolved("team"),
            "events without a match": F.count_if(F.col("match_id").isNull()),
        },
    )
    missing = raw_events(docs.join(match_lookup.select(*FILE_ORDER), FILE_ORDER, "left_anti"))
    return unique.select(*schemas.EVENT_TABLE, DAY), missing, checks


def normalise(
    raw: DataFrame, overrides: DataFrame | None = None, known_names: DataFrame | None = None, threshold: float = 95.0,
    derive_competition: bool = False, keep_clusters: bool = False, clusters: DataFrame | None = None,
) -> Silver:
    """All tables of one batch. ``raw`` has competition, raw_id, data_type and payload.

    Every lookup that rows are joined to many to one is checked for repeated keys while it is
    written, so a fault stops the run before any table is changed. With ``keep_clusters`` the batch
    extends the stored ``clusters`` of names (name, component), if there are any.
    """
    docs = documents(raw, derive_competition)
    comps, _ = write_unique(competitions(docs), ["comp_name"])
    matches, teams = fallback_team_ids(write_out(raw_matches(docs)), FILE_ORDER)
    team_table, team_lookup = team_tables(teams)
    team_lookup, _ = write_unique(team_lookup, ["raw_id"])
    kept: list[DataFrame] = []

    def cluster(names: DataFrame) -> DataFrame:
        found = name_clusters(names, threshold) if clusters is None else extend_clusters(clusters, names, threshold)
        kept.append(cut_lineage(found))
        return kept[-1]

    player_table, player_lookup = resolve_players(
        raw_players(docs), [*FILE_ORDER, "position"], overrides, known_names, threshold, cluster=cluster if keep_clusters else None
    )
    player_lookup, _ = write_unique(player_lookup, ["raw_id"])
    match_table, match_lookup, undated = match_tables(matches, comps, team_lookup)
    match_lookup, listed = write_unique(match_lookup, FILE_ORDER, {"events": F.sum("n_events")})
    events, missing, checks = event_tables(docs, team_lookup, player_lookup, match_lookup)
    checks["duplicate_events"] = listed["events"] - checks["events"]
    return Silver(comps, team_table, player_table, match_table, events, missing, undated, docs, checks, kept[-1] if kept else None)


def store(spark: SparkSession, paths: Paths, silver: Silver, replace_upcoming: bool = True) -> dict[str, int]:
    """Write one batch; returns the row counts of the tables.

    The upcoming matches are replaced by those of the batch, even by none, unless the batch
    is known not to carry any.
    """
    counts = {
        "teams": tables.upsert(spark, paths.curated("teams"), silver.teams, schemas.TEAM_KEY),
        "players": tables.upsert(spark, paths.curated("players"), silver.players, schemas.PLAYER_KEY),
        "competitions": tables.upsert(
            spark, paths.curated("competitions"), silver.competitions, schemas.COMPETITION_KEY
        ),
    }
    if silver.clusters is not None:
        counts["name_clusters"] = tables.overwrite(spark, paths.curated("name_clusters"), silver.clusters)
    played, upcoming = split_played(cut_lineage(silver.matches))
    counts["matches"] = tables.upsert(spark, paths.curated("matches"), played, schemas.MATCH_KEY)
    if replace_upcoming:
        if tables.table_exists(spark, paths.curated("matches")):
            stored = tables.read_table(spark, paths.curated("matches")).select("match_id")
            upcoming = upcoming.join(stored, "match_id", "left_anti")
        counts["upcoming_matches"] = tables.overwrite(
            spark, paths.curated("upcoming_matches"), upcoming, schemas.MATCH_KEY
        )
    counts["pbps"] = tables.upsert(
        spark, paths.curated("pbps"), silver.events, schemas.EVENT_KEY, partition_by=DAY
    )
    counts["unmapped_events"] = quarantine(spark, paths.curated("unmapped_events"), silver.unmapped_events, silver.docs)
    counts["undated_matches"] = quarantine(spark, paths.curated("undated_matches"), silver.undated_matches, silver.docs)
    return counts


def quarantine(spark: SparkSession, path: str, rows: DataFrame, docs: DataFrame) -> int:
    """Keep rows that found no place, until a later version of their document settles them.

    A batch replaces what is kept of its own documents and leaves the rest; returns how many
    rows of the batch were put aside.
    """
    rows = write_out(rows)
    if tables.table_exists(spark, path):
        stored = tables.read_table(spark, path)
        kept = stored.join(docs.select(*FILE_ORDER).distinct(), FILE_ORDER, "left_anti")
        tables.overwrite(spark, path, kept.unionByName(rows, allowMissingColumns=True))
    else:
        tables.overwrite(spark, path, rows)
    return rows.count()


def load(
    spark: SparkSession, paths: Paths, new: DataFrame, overrides: DataFrame | None = None, seed_names: bool = False,
    derive_competition: bool = False, replace_upcoming: bool = True,
) -> dict[str, int]:
    """Read, normalise and store these files, then register them: the registry is written last, so a
    load that fails is repeated, and repeating is harmless. With ``seed_names`` players are clustered
    with those of earlier loads, whose clusters are kept and extended."""
    with own_scratch(spark):
        known_names = clusters = None
        if seed_names and tables.table_exists(spark, paths.curated("name_clusters")):
            clusters = tables.read_table(spark, paths.curated("name_clusters"))
        elif seed_names and tables.table_exists(spark, paths.curated("players")):
            known_names = tables.read_table(spark, paths.curated("players")).select(F.col("player_name").alias("name"))
        silver = normalise(
            raw_zone.read_new(spark, new, "pbp"), overrides, known_names, derive_competition=derive_competition,
            keep_clusters=seed_names, clusters=clusters,
        )
        counts = store(spark, paths, silver, replace_upcoming)
        failed = unreadable(new, silver.docs).withColumn("status", F.lit(raw_zone.UNREADABLE))
        done = write_out(new.join(failed, "path", "left").fillna(raw_zone.LOADED, "status"))
        raw_zone.register(spark, paths.registry, done)
        found = done.agg(F.count("*").alias("files"), F.count_if(F.col("status") == raw_zone.UNREADABLE).alias("failed")).first()
        return {**silver.checks, **counts, "unreadable_files": found["failed"], "files": found["files"]}


def new_in_zone(spark: SparkSession, paths: Paths, retry: bool = False) -> DataFrame:
    """The versions of files that the registry does not hold, ``retry`` also those not readable."""
    known = raw_zone.read_registry(spark, paths.registry)
    if retry:
        known = known.filter(F.col("status") != raw_zone.UNREADABLE)
    return raw_zone.new_files(raw_zone.list_files(spark, paths.raw), known)


def run_silver(
    spark: SparkSession, paths: Paths, overrides: DataFrame | None = None, seed_names: bool = False,
    derive_competition: bool = False, retry_unreadable: bool = False,
) -> dict[str, int]:
    """Process what is new in the raw zone; an empty result means there was nothing new.

    Files are opened if they are new or rewritten, and no others. Unreadable ones are counted and
    registered as such; they are tried again when they are rewritten, or on request.
    """
    new = cut_lineage(new_in_zone(spark, paths, retry_unreadable))
    if new.isEmpty():
        return {}
    return load(spark, paths, new, overrides, seed_names, derive_competition)


def unmapped_report(spark: SparkSession, paths: Paths) -> DataFrame:
    """How many events found no match, with a few of their file names."""
    return unmapped_summary(tables.read_table(spark, paths.curated("unmapped_events")), "file_id")
