"""The raw zone: ``{root}/{folder}/{raw_id}.json``, one JSON document per file.

A registry table of (path, modification time, status) remembers which versions of which files
have been processed, also those that could not be read; everything else in the zone is new. Files
of the ``upcoming`` folder are never registered. Only files that are wanted are opened.
"""

from __future__ import annotations

import re
from itertools import batched
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.payloads import FINISHED, PAYLOAD_TYPES
from ledgerline.operators.quality import union_all
from ledgerline.session import cut_lineage
from ledgerline.sources import tables
from ledgerline.sources.files import delete_objects, write_objects
from ledgerline.sources.tables import path_exists

UPCOMING = "upcoming"
PROFILES = "profiles"
REGISTRY = "path string, modification_time timestamp, status string"
LOADED, UNREADABLE = "loaded", "unreadable"
# Paths of one scan, and appends after which a registry is written anew.
SCAN_PATHS, COMPACT_AFTER = 20_000, 16
# Folder prefixes and the payload type they stand for.
FOLDER_TYPES = {"agg_by_player_": "agg_player", "agg_by_team_": "agg_team", "pbp_": "pbp"}
SEASON_SUFFIX = "_basketball"


def folder_type(folder: Column) -> Column:
    """Payload type of a folder name; null for folders that hold no payloads."""
    result = F.when(folder == UPCOMING, F.lit("pbp"))
    for prefix, kind in FOLDER_TYPES.items():
        result = result.when(folder.startswith(prefix), F.lit(kind))
    return result


def folder_competition(folder: Column) -> Column:
    """Competition named by a folder."""
    result = F.when(folder == UPCOMING, F.lit(UPCOMING))
    for prefix in FOLDER_TYPES:
        bare = F.replace(F.replace(folder, F.lit(prefix), F.lit("")), F.lit(SEASON_SUFFIX), F.lit(""))
        result = result.when(folder.startswith(prefix), bare)
    return result


def with_path_parts(files: DataFrame, path: str = "path") -> DataFrame:
    """Add ``folder``, ``raw_id``, ``data_type`` and ``competition`` read off the path."""
    folder = F.regexp_extract(path, r"([^/]+)/[^/]+\.json$", 1)
    return (
        files.withColumn("folder", folder)
        .withColumn("raw_id", F.regexp_extract(path, r"([^/]+)\.json$", 1))
        .withColumn("data_type", folder_type(F.col("folder")))
        .withColumn("competition", folder_competition(F.col("folder")))
    )


def list_files(spark: SparkSession, *roots: str) -> DataFrame:
    """Paths and modification times below the folders; no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .load(list(roots))
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_modification_time").alias("modification_time"),
        )
    )
    return payload_files(files)


def payload_files(files: DataFrame) -> DataFrame:
    """Keep JSON files outside the state and profile folders."""
    path = F.col("path")
    return files.filter(
        path.endswith(".json") & ~path.contains(f"/{PROFILES}/") & ~path.contains("/_state/")
    )


def new_files(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Files not yet processed; a file rewritten later counts as new.

    Paths begin alike, so both sides are sorted by a hash of the path first. Stored paths are
    compressed well, so the size of a registry says little, and it is never broadcast.
    """
    marked = lambda rows: rows.withColumn("_mark", F.xxhash64("path"))
    keys = ["_mark", "path", "modification_time"]
    return marked(files).join(marked(registry).hint("merge"), keys, "left_anti").drop("_mark")


def registry_union(registry: DataFrame, processed: DataFrame) -> DataFrame:
    """All registered files, each once."""
    keys = processed.filter(~F.col("path").contains(f"/{UPCOMING}/")).select(*registry.columns)
    return registry.unionByName(keys).distinct()


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry table; empty when there is none yet, any other failure is raised."""
    if not tables.table_exists(spark, path):
        return spark.createDataFrame([], REGISTRY)
    stored = tables.read_table(spark, path)
    return stored if "status" in stored.columns else stored.withColumn("status", F.lit(LOADED))


def register(spark: SparkSession, path: str, processed: DataFrame) -> None:
    """Append the (path, modification_time, status) rows that the registry does not hold yet, as
    one commit. Call it after the load has succeeded.

    After some appends the registry is written anew with the newest version of each path.
    """
    rows = processed.filter(~F.col("path").contains(f"/{UPCOMING}/")).select("path", "modification_time", "status")
    once = rows.groupBy("path", "modification_time").agg(F.min("status").alias("status"))
    if tables.append(spark, path, new_files(once, read_registry(spark, path))) > COMPACT_AFTER:
        newest = F.max_by(F.struct("modification_time", "status"), "modification_time").alias("newest")
        tables.overwrite(spark, path, read_registry(spark, path).groupBy("path").agg(newest).select("path", "newest.*"))


def _plain_path(uri: str) -> str:
    """A listed path as a reader wants it: not encoded, and no pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def read_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``(path, modification_time, payload)`` of exactly these files.

    Their paths go to the driver, as those of every scan do, and on to scans of ``SCAN_PATHS``
    files; executors open these and no others, and no content passes through a join.
    """
    paths = (_plain_path(r["path"]) for r in files.select("path").distinct().toLocalIterator())
    scans = [
        spark.read.text(list(part), wholetext=True).select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_modification_time").alias("modification_time"),
            F.col("value").alias("payload"),
        )
        for part in batched(paths, SCAN_PATHS)
    ]
    return union_all(scans) if scans else spark.createDataFrame([], "path string, modification_time timestamp, payload string")


def read_new(spark: SparkSession, new: DataFrame, *types: str) -> DataFrame:
    """Contents of the new files with their path parts; empty files, other folders and, if any are
    named, other payload types are left out. Those are not opened."""
    wanted = with_path_parts(new).filter(F.col("data_type").isin(*types) if types else F.col("data_type").isNotNull())
    return with_path_parts(read_files(spark, wanted)).filter(F.trim("payload") != "")


# -- writing -----------------------------------------------------------------------------


def object_path(root: str, folder: Column, raw_id: Column) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), folder, F.lit("/"), raw_id, F.lit(".json"))


def write_payloads(rows: DataFrame, root: str) -> int:
    """Write ``(folder, raw_id, payload)`` rows, one document per file."""
    return write_objects(
        rows.select(object_path(root, F.col("folder"), F.col("raw_id")).alias("path"), F.col("payload").alias("content"))
    )


def replace_folder(spark: SparkSession, rows: DataFrame, root: str, folder: str) -> int:
    """Make ``folder`` hold exactly the given ``(raw_id, payload)`` rows.

    New documents are written first and leftovers deleted afterwards, so an interruption
    leaves a folder that the next run repairs and never an empty one.
    """
    kept = rows.select("raw_id").distinct()
    written = write_payloads(rows.withColumn("folder", F.lit(folder)), root)
    present = with_path_parts(list_files(spark, f"{root.rstrip('/')}/{folder}"))
    delete_objects(present.join(kept, "raw_id", "left_anti"))
    return written


def pending_files(finished: DataFrame, stored: DataFrame) -> DataFrame:
    """Files still to be fetched: every finished match times every payload type, less those
    stored with a finished status. ``stored`` has ``folder_type``, ``raw_id`` and ``status``."""
    wanted = finished.withColumn("folder_type", F.explode(F.array(*map(F.lit, PAYLOAD_TYPES))))
    done = stored.filter(F.col("status") == FINISHED).select("folder_type", "raw_id")
    return wanted.join(done, ["folder_type", "raw_id"], "left_anti")


def stored_status(
    spark: SparkSession, root: str, index: str, season: str, candidates: DataFrame | None = None
) -> DataFrame:
    """Status recorded inside the stored documents of one season, as (folder_type, raw_id, status).

    The table ``index`` keeps the status of every version of a document met so far, so only new
    and rewritten ones are opened, and of these only the ``candidates`` (raw_id), if given.
    """
    folders = [f"{root.rstrip('/')}/{kind}_{season}" for kind in PAYLOAD_TYPES]
    present = [f for f in folders if path_exists(spark, f)]
    if not present:
        return spark.createDataFrame([], "folder_type string, raw_id string, status string")
    listed = with_path_parts(list_files(spark, *present))
    if candidates is not None:
        listed = listed.join(candidates.select("raw_id").distinct(), "raw_id", "left_semi")
    listed = cut_lineage(listed.select("path", "modification_time", "folder", "raw_id"))
    unknown = cut_lineage(new_files(listed, read_registry(spark, index)))
    if not unknown.isEmpty():
        status = F.get_json_object("payload", "$.partido.estado_partido").alias("status")
        register(spark, index, unknown.join(read_files(spark, unknown).select("path", status), "path", "left"))
    known = listed.join(read_registry(spark, index), ["path", "modification_time"])
    return known.select(F.replace("folder", F.lit(f"_{season}"), F.lit("")).alias("folder_type"), "raw_id", "status")
