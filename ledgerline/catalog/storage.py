"""Scans, registries and keyed sinks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog.registry import query, table
from ledgerline.functions.calendar import season_id
from ledgerline.operators import merge, payloads
from ledgerline.operators.quality import union_all
from ledgerline.sources import raw

SQL_SEASON = (
    "'liganacional' || CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) < 8 THEN 1 ELSE 0 END AS VARCHAR)"
    " || CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) < 8 THEN 0 ELSE 1 END AS VARCHAR) || '_basketball'"
)
SQL_FOLDER = f"""CASE o_orderpriority WHEN '1-URGENT' THEN 'pbp_' || {SQL_SEASON} WHEN '2-HIGH' THEN 'agg_by_player_' || {SQL_SEASON}
  WHEN '3-MEDIUM' THEN 'agg_by_team_' || {SQL_SEASON} WHEN '4-NOT SPECIFIED' THEN 'profiles' ELSE 'upcoming' END"""
SQL_FILES = f"""files AS (SELECT o_orderkey, o_orderstatus, o_orderdate, {SQL_FOLDER} AS folder,
  '/raw/' || {SQL_FOLDER} || '/' || CAST(o_orderkey AS VARCHAR) || '.json' AS path FROM orders)"""


def order_files(spark: SparkSession, folder: str) -> DataFrame:
    """One file per order, in a folder chosen by its priority."""
    season, priority = season_id(F.col("o_orderdate")), F.col("o_orderpriority")
    prefix = (
        F.when(priority == "1-URGENT", "pbp_").when(priority == "2-HIGH", "agg_by_player_").when(priority == "3-MEDIUM", "agg_by_team_")
    )
    # Filters repeat the path, so the season stands in it once.
    name = F.coalesce(F.concat(prefix, season), F.when(priority == "4-NOT SPECIFIED", "profiles").otherwise("upcoming"))
    return table(spark, folder, "orders").select(
        raw.object_path("/raw", name, F.col("o_orderkey").cast("string")).alias("path"),
        F.col("o_orderdate").alias("modification_time"), "o_orderstatus",
    )


@query("q_incremental_scan", f"""WITH {SQL_FILES}
SELECT path, o_orderdate AS modification_time FROM files WHERE o_orderstatus <> 'F' AND folder <> 'profiles'""")
def q_incremental_scan(spark: SparkSession, folder: str) -> DataFrame:
    files = order_files(spark, folder)
    # Files of status P were registered before they were rewritten.
    seen = F.when(F.col("o_orderstatus") == "P", F.col("modification_time") - F.expr("INTERVAL 1 DAY"))
    registry = files.filter(F.col("o_orderstatus") != "O").select(
        "path", F.coalesce(seen, "modification_time").alias("modification_time")
    )
    return raw.new_files(raw.payload_files(files.drop("o_orderstatus")), registry)


@query("q_folder_parse", f"""WITH {SQL_FILES}
SELECT path, folder, CAST(o_orderkey AS VARCHAR) AS raw_id, CASE WHEN folder LIKE 'pbp%' OR folder = 'upcoming' THEN 'pbp'
    WHEN folder LIKE 'agg_by_player%' THEN 'agg_player' WHEN folder LIKE 'agg_by_team%' THEN 'agg_team' END AS data_type,
  CASE WHEN folder = 'upcoming' THEN 'upcoming' WHEN folder <> 'profiles' THEN regexp_extract(folder, 'liganacional[0-9]+') END AS competition
FROM files""")
def q_folder_parse(spark: SparkSession, folder: str) -> DataFrame:
    return raw.with_path_parts(order_files(spark, folder).select("path"))


@query("q_registry_update", f"""WITH {SQL_FILES}
SELECT path, o_orderdate AS modification_time FROM files WHERE o_orderstatus = 'F' OR folder <> 'upcoming'""")
def q_registry_update(spark: SparkSession, folder: str) -> DataFrame:
    files = order_files(spark, folder)
    registry = files.filter(F.col("o_orderstatus") == "F").drop("o_orderstatus")
    return raw.registry_union(registry, files)


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("q_payload_pivot", "SELECT user_id, "
       + ", ".join(f"max(CASE WHEN event_type = '{t}' THEN props END) AS {t}" for t in EVENT_TYPES)
       + " FROM events GROUP BY user_id")
def q_payload_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return payloads.payload_per_type(table(spark, folder, "events"), ["user_id"], "event_type", "props", EVENT_TYPES)


SCANNED = ["customer", "supplier", "part", "orders", "lineitem"]


@query("q_scan_tables", " UNION ALL ".join(f"SELECT '{t}' AS entity, count(*) AS rows FROM {t}" for t in SCANNED))
def q_scan_tables(spark: SparkSession, folder: str) -> DataFrame:
    return union_all([
        table(spark, folder, t).agg(F.count("*").alias("rows")).select(F.lit(t).alias("entity"), "rows") for t in SCANNED
    ])


def line_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a batch of order rows; returned items become new orders."""
    key = F.col("l_orderkey") + F.when(F.col("l_returnflag") == "R", 1_000_000_000).otherwise(0)
    return table(spark, folder, "lineitem").select(
        key.alias("o_orderkey"), F.col("l_suppkey").alias("o_custkey"), F.col("l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.col("l_shipdate").alias("_1"), F.col("l_linenumber").alias("_2"), F.col("l_partkey").alias("_3"),
        F.col("l_extendedprice").alias("_4"),
    )


ORDER = ["_1", "_2", "_3", "_4"]
SQL_BATCH = """batch AS (
  SELECT l_orderkey + CASE WHEN l_returnflag = 'R' THEN 1000000000 ELSE 0 END AS o_orderkey, l_suppkey AS o_custkey,
    l_linestatus AS o_orderstatus, l_extendedprice AS o_totalprice FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey + CASE WHEN l_returnflag = 'R' THEN 1000000000 ELSE 0 END
    ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) = 1)"""


@query("q_upsert_last_wins", f"""WITH {SQL_BATCH}
SELECT * FROM batch UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)""")
def q_upsert_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    existing = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return merge.upsert(existing, line_batch(spark, folder), ["o_orderkey"], ORDER)


@query("q_snapshot_overwrite", f"WITH {SQL_BATCH} SELECT * FROM batch")
def q_snapshot_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    return merge.latest(line_batch(spark, folder), ["o_orderkey"], ORDER).drop(*ORDER)


@query("q_replace_partition", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'O'
UNION ALL SELECT l_orderkey, l_suppkey, 'O' FROM lineitem WHERE l_linestatus = 'O'""")
def q_replace_partition(spark: SparkSession, folder: str) -> DataFrame:
    existing = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    fresh = table(spark, folder, "lineitem").filter(F.col("l_linestatus") == "O").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("o_custkey"), F.col("l_linestatus").alias("o_orderstatus")
    )
    return merge.replace_partition(existing, fresh, "o_orderstatus", "O")


@query("q_pending_files", """
WITH kinds AS (SELECT * FROM (VALUES ('pbp', 'A'), ('agg_by_player', 'N'), ('agg_by_team', 'R')) AS k(folder_type, flag))
SELECT folder_type, CAST(o_orderkey AS VARCHAR) AS raw_id FROM orders, kinds WHERE o_orderstatus = 'F' AND NOT EXISTS (
  SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = flag AND l_linestatus = 'F')""")
def q_pending_files(spark: SparkSession, folder: str) -> DataFrame:
    finished = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").cast("string").alias("raw_id")
    )
    kind = F.when(F.col("l_returnflag") == "A", "pbp").when(F.col("l_returnflag") == "N", "agg_by_player").otherwise("agg_by_team")
    stored = table(spark, folder, "lineitem").select(
        kind.alias("folder_type"), F.col("l_orderkey").cast("string").alias("raw_id"),
        F.when(F.col("l_linestatus") == "F", payloads.FINISHED).otherwise("EN_JUEGO").alias("status"),
    )
    return raw.pending_files(finished, stored)
