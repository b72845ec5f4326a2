"""Star schema on top of the normalised tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.calendar import match_result
from ledgerline.operators.chunks import DEFAULT_CHUNK_ROWS
from ledgerline.operators.payloads import split_played
from ledgerline.operators.stints import StintTables, stint_tables
from ledgerline.plans.silver import DAY
from ledgerline.rules import SCORING, STATS, event_kind
from ledgerline.sources import tables
from ledgerline.sources.tables import Paths


def match_totals(facts: DataFrame, *keep: str) -> DataFrame:
    """Counters per match and team, and what else is the same for all rows of a match."""
    return facts.groupBy("match_id", "team_id", *keep).agg(
        *[F.sum(s).alias(s) for s in STATS], F.count("*").alias("player_stints")
    )


def career_totals(facts: DataFrame) -> DataFrame:
    """Counters per player over all matches.

    Two steps, so that a player with a third of all rows is first reduced per match.
    """
    per_match = facts.groupBy("player_id", "match_id").agg(
        *[F.sum(s).alias(s) for s in STATS], F.count("*").alias("player_stints")
    )
    return per_match.groupBy("player_id").agg(
        *[F.sum(s).alias(s) for s in STATS],
        F.sum("player_stints").alias("player_stints"),
        F.count("*").alias("matches"),
    )


def player_days(facts: DataFrame) -> DataFrame:
    """Counters per player and day: parts from which ``career_totals`` can be put together."""
    per_match = facts.groupBy(DAY, "player_id", "match_id").agg(
        *[F.sum(s).alias(s) for s in STATS], F.count("*").alias("player_stints")
    )
    return per_match.groupBy(DAY, "player_id").agg(
        *[F.sum(s).alias(s) for s in STATS], F.sum("player_stints").alias("player_stints"), F.count("*").alias("matches")
    )


def career_of_days(days: DataFrame) -> DataFrame:
    """``career_totals`` from the parts of all days; a match belongs to one day."""
    return days.groupBy("player_id").agg(*[F.sum(c).alias(c) for c in (*STATS, "player_stints", "matches")])


def event_log(events: DataFrame) -> DataFrame:
    """Stored events in the form the stint engine reads."""
    return events.select(
        "match_id", "seq", F.col("pbp_id").alias("tie"), event_kind(F.col("event_type")).alias("kind"),
        F.col("event_type").alias("code"), "clk", "team_id", "player_id",
    )


def dim_match(matches: DataFrame) -> DataFrame:
    return matches.withColumn("result", match_result(F.col("home_pts"), F.col("away_pts")))


def build(
    matches: DataFrame, events: DataFrame, scoring: dict[str, dict[str, int]] = SCORING,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> StintTables:
    """Stint tables of all played matches; events of other matches are left out."""
    played, _ = split_played(matches)
    sides = played.withColumn(DAY, F.to_date("date"))
    return stint_tables(event_log(events), sides, scoring, chunk_rows, [DAY])


def run_gold(
    spark: SparkSession, paths: Paths, scoring: dict[str, dict[str, int]] = SCORING, since: str | None = None
) -> dict[str, int]:
    """Rebuild the star schema, or with ``since`` (a date) only the days from then on.

    Facts, stints and the sums per day are rebuilt from all events of a day and replace that day as
    a whole, so nothing that has disappeared from the events lingers. Career totals are put together
    from the sums per player and day, so old facts are not read for them.
    """
    if not tables.table_exists(spark, paths.curated("matches")):
        return {}
    matches = tables.read_table(spark, paths.curated("matches"))
    events = tables.read_table(spark, paths.curated("pbps"))
    recent = matches
    if since is not None:
        recent = matches.filter(F.to_date("date") >= F.lit(since).cast("date"))
        events = events.filter(F.col(DAY) >= F.lit(since).cast("date"))
    gold = build(recent, events, scoring).keep()
    counts = {}

    def write(name: str, rows: DataFrame) -> None:
        path = paths.analytics(name)
        if since is None or not tables.table_exists(spark, path):
            counts[name] = tables.overwrite(spark, path, rows, partition_by=[DAY])
        else:
            days = recent.select(F.to_date("date").alias(DAY)).distinct()
            counts[name] = tables.replace_partitions(spark, path, rows, DAY, days)

    try:
        write("fact_player_stints", gold.player_stints())
        write("dim_stint", gold.stints())
    finally:
        gold.release()
    # A roll-up without a table yet needs the facts of all days.
    rollups = {"agg_match_team": lambda facts: match_totals(facts, DAY), "agg_player_day": player_days}
    facts = tables.read_table(spark, paths.analytics("fact_player_stints"))
    for name, rollup in rollups.items():
        touched = facts
        if since is not None and tables.table_exists(spark, paths.analytics(name)):
            touched = facts.filter(F.col(DAY) >= F.lit(since).cast("date"))
        write(name, rollup(touched))
    careers = career_of_days(tables.read_table(spark, paths.analytics("agg_player_day")))
    counts["agg_player"] = tables.overwrite(spark, paths.analytics("agg_player"), careers)
    counts["dim_match"] = tables.overwrite(spark, paths.analytics("dim_match"), dim_match(matches))
    for name, source in (("dim_player", "players"), ("dim_team", "teams"), ("dim_competition", "competitions")):
        rows = tables.read_table(spark, paths.curated(source))
        counts[name] = tables.overwrite(spark, paths.analytics(name), rows)
    return counts
