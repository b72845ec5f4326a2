"""Landed fixture lists to the raw zone: upcoming fixtures and what is still to be fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.payloads import (
    FINISHED_FIXTURE,
    NOT_STARTED_FIXTURE,
    routed,
    upcoming_payload,
)
from ledgerline.session import cut_lineage
from ledgerline.sources import raw as raw_zone
from ledgerline.sources.tables import Paths


def upcoming_documents(fixtures: DataFrame) -> DataFrame:
    """``(raw_id, payload)`` of the fixtures that have not been played."""
    document = upcoming_payload(
        F.col("NombreEquipoLocal"), F.col("NombreEquipoVisitante"), F.col("IdEquipoLocal"), F.col("IdEquipoVisitante")
    )
    return fixtures.select("raw_id", F.to_json(document).alias("payload"))


def run_bronze(spark: SparkSession, paths: Paths, fixtures: DataFrame, season: str) -> DataFrame:
    """Refresh the upcoming folder and return the files to fetch.

    ``fixtures`` has ``raw_id`` and the feed's fixture fields. The result has ``raw_id``,
    ``folder_type``, ``folder`` and ``IdPartido``; hand the fetched documents to
    ``store_documents``. Without any upcoming fixture the folder stays as it is.
    """
    state = F.col("Estado")
    landed = cut_lineage(routed(fixtures, "route", {"upcoming": state == NOT_STARTED_FIXTURE, "finished": state == FINISHED_FIXTURE}))
    upcoming, finished = landed.filter("route = 'upcoming'"), landed.filter("route = 'finished'")
    if not upcoming.isEmpty():
        raw_zone.replace_folder(spark, upcoming_documents(upcoming), paths.raw, raw_zone.UPCOMING)
    stored = raw_zone.stored_status(spark, paths.raw, paths.statuses, season, finished)
    pending = raw_zone.pending_files(finished.select("raw_id", "IdPartido"), stored)
    return pending.withColumn("folder", F.concat("folder_type", F.lit(f"_{season}")))


def store_documents(paths: Paths, fetched: DataFrame) -> int:
    """Write fetched ``(folder, raw_id, payload)`` documents."""
    return raw_zone.write_payloads(fetched, paths.raw)
