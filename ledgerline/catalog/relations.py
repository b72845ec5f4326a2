"""Filters, lookups, deduplication and set operations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog.registry import query, table
from ledgerline.catalog.scalars import sql_uuid5
from ledgerline.functions import ids
from ledgerline.functions.calendar import clock_seconds
from ledgerline.operators import payloads
from ledgerline.operators.dedup import by_priority, duplicate_keys, first_per_key
from ledgerline.operators.lookups import fallback_team_ids, known_or_null, lookup, unmapped, unmapped_summary
from ledgerline.operators.quality import entity_summary, failures, union_all
from ledgerline.plans.gold import dim_match


# -- filters and projections -------------------------------------------------------------


@query("q_partition_status", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'upcoming' ELSE 'finished' END AS part
FROM orders WHERE o_orderstatus IN ('O', 'F')""")
def q_partition_status(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    parts = {"upcoming": status == "O", "finished": status == "F"}
    return payloads.routed(table(spark, folder, "orders"), "part", parts).select("o_orderkey", "part")


@query("q_upcoming_payload", """
SELECT o_orderkey, '{"resultado":"correcto","partido":{"tipo_acta":"ESTADÍSTICAS","estado_partido":"NO_COMENZADO","local":"'
  || coalesce(c_name, '') || '","visitante":"' || o_orderpriority || '","idlocal":"' || CAST(o_custkey AS VARCHAR)
  || '","idvisitante":"","tanteo_local":0,"tanteo_visitante":0,"numperiodos":4,"tiempo_total_partido":2400},'
  || '"envivo":{"jugadoresenpistalocal":[],"jugadoresenpistavisitante":[],"historialacciones":[]},"error":""}' AS payload
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def q_upcoming_payload(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    named = lookup(orders, table(spark, folder, "customer"), "o_custkey", "c_custkey", {"c_name": "home"})
    document = payloads.upcoming_payload(
        F.col("home"), F.col("o_orderpriority"), F.col("o_custkey"), F.lit(None).cast("string")
    )
    return named.select("o_orderkey", F.to_json(document).alias("payload"))


@query("q_error_filter", """
SELECT event_id, event_type, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events WHERE event_type <> 'error'""")
def q_error_filter(spark: SparkSession, folder: str) -> DataFrame:
    error = F.when(F.col("event_type") == "error", payloads.NO_DATA)
    parsed = F.from_json("props", "k int")["k"]
    return payloads.without_errors(table(spark, folder, "events"), error).select("event_id", "event_type", parsed.alias("k"))


@query("q_flatten_payload", """
WITH packed AS (SELECT doc_id, list_append(string_split(text, chr(10)), source) AS items FROM documents)
SELECT doc_id, CAST(unnest(range(len(items))) AS INTEGER) AS position, unnest(items) AS note FROM packed""")
def q_flatten_payload(spark: SparkSession, folder: str) -> DataFrame:
    action = lambda text: F.struct(text.alias("informacion_adicional"))
    packed = table(spark, folder, "documents").select(
        "doc_id",
        F.to_json(
            F.struct(
                F.transform(F.split("text", "\n"), action).alias("local"), F.array(action(F.col("source"))).alias("visitante")
            )
        ).alias("payload"),
    )
    item = "array<struct<informacion_adicional:string>>"
    parsed = packed.withColumn("doc", F.from_json("payload", f"local {item}, visitante {item}"))
    items = payloads.explode_items(parsed, payloads.both(F.col("doc.local"), F.col("doc.visitante")), "doc_id")
    return items.select("doc_id", "position", F.col("informacion_adicional").alias("note"))


@query("q_project_rename", """
SELECT event_id AS seq, event_type, user_id AS player_raw_id, value AS x, props AS note FROM events""")
def q_project_rename(spark: SparkSession, folder: str) -> DataFrame:
    names = {"event_id": "seq", "event_type": "event_type", "user_id": "player_raw_id", "value": "x", "props": "note"}
    return payloads.renamed(table(spark, folder, "events"), names)


@query("q_sentinel_null", """
SELECT l_orderkey, l_partkey, nullif(l_returnflag, 'N') AS flag, nullif(CAST(l_linenumber AS VARCHAR), '1') AS line FROM lineitem""")
def q_sentinel_null(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey",
        ids.sentinel_to_null(F.col("l_returnflag"), "N").alias("flag"),
        ids.sentinel_to_null(F.col("l_linenumber"), "1").alias("line"),
    )


@query("q_unknown_ref_null", """
SELECT o_orderkey, c_custkey AS o_custkey FROM orders LEFT JOIN (
  SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey""")
def q_unknown_ref_null(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return known_or_null(orders, known, "o_custkey", "c_custkey")


@query("q_default_fill", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 4 ELSE CAST(month(o_orderdate) AS INTEGER) END AS periods,
  CASE WHEN o_orderstatus = 'F' THEN 10 ELSE CAST(day(o_orderdate) AS INTEGER) END AS total_duration_mm, 5 AS extra_duration_mm FROM orders""")
def q_default_fill(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.month("o_orderdate")).alias("periods"),
        F.when(F.col("o_orderstatus") != "F", F.day("o_orderdate")).alias("total_duration_mm"),
        F.lit(None).cast("int").alias("extra_duration_mm"),
    )
    return payloads.with_defaults(rows)


@query("q_split_played", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'upcoming' ELSE 'played' END AS target FROM orders""")
def q_split_played(spark: SparkSession, folder: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "O", payloads.NOT_STARTED).when(F.col("o_orderstatus") == "F", payloads.FINISHED)
    ahead = payloads.is_upcoming()
    targets = {"played": ~ahead, "upcoming": ahead}
    return payloads.routed(table(spark, folder, "orders").withColumn("status", status), "target", targets).select("o_orderkey", "target")


# -- joins -------------------------------------------------------------------------------


@query("q_resolve_event_refs", """
SELECT l_orderkey, l_linenumber, l_partkey, s_name, p_name, o_custkey FROM lineitem
LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN orders ON l_orderkey = o_orderkey""")
def q_resolve_event_refs(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = lookup(rows, table(spark, folder, "supplier"), "l_suppkey", "s_suppkey", {"s_name": "s_name"})
    rows = lookup(rows, table(spark, folder, "part"), "l_partkey", "p_partkey", {"p_name": "p_name"})
    rows = lookup(rows, table(spark, folder, "orders"), "l_orderkey", "o_orderkey", {"o_custkey": "o_custkey"})
    return rows.drop("l_suppkey")


@query("q_unmapped_events", """
WITH missing AS (SELECT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')),
smallest AS (SELECT DISTINCT l_orderkey FROM missing ORDER BY l_orderkey LIMIT 5)
SELECT count(*) AS events, count(DISTINCT l_orderkey) AS keys,
  (SELECT string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY CAST(l_orderkey AS VARCHAR)) FROM smallest) AS sample FROM missing""")
def q_unmapped_events(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "F")
    return unmapped_summary(unmapped(table(spark, folder, "lineitem"), known, "l_orderkey", "o_orderkey"), "l_orderkey")


@query("q_match_dims", "SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def q_match_dims(spark: SparkSession, folder: str) -> DataFrame:
    return lookup(
        table(spark, folder, "nation"), table(spark, folder, "region"), "n_regionkey", "r_regionkey", {"r_name": "r_name"}, check=True
    ).select("n_nationkey", "n_name", "r_name")


@query("q_roleplay_join", """
SELECT l_orderkey, l_linenumber, l_partkey, h.n_name AS home, a.n_name AS away FROM lineitem
LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation h ON s_nationkey = h.n_nationkey
LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation a ON c_nationkey = a.n_nationkey""")
def q_roleplay_join(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    suppliers = lookup(suppliers, nation, "s_nationkey", "n_nationkey", {"n_name": "home"})
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    customers = lookup(customers, nation, "c_nationkey", "n_nationkey", {"n_name": "away"})
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    orders = lookup(orders, customers, "o_custkey", "c_custkey", {"away": "away"})
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = lookup(rows, suppliers, "l_suppkey", "s_suppkey", {"home": "home"})
    return lookup(rows, orders, "l_orderkey", "o_orderkey", {"away": "away"}).drop("l_suppkey")


@query("q_fallback_key", f"""
WITH m AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS home_raw, c_name AS home_name,
    CASE WHEN o_orderpriority <> '5-LOW' THEN n_name || o_orderpriority END AS away_raw, n_name || ' ' || o_orderpriority AS away_name
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
),
seen AS (SELECT home_raw AS raw, home_name AS name, 'LOCAL' AS label, o_orderkey, 0 AS side FROM m
  UNION ALL SELECT away_raw, away_name, 'AWAY', o_orderkey, 1 FROM m),
known AS (SELECT * FROM seen WHERE raw IS NOT NULL QUALIFY row_number() OVER (PARTITION BY raw ORDER BY o_orderkey, side) = 1),
named AS (SELECT * FROM known QUALIFY row_number() OVER (PARTITION BY name ORDER BY o_orderkey DESC, side DESC) = 1),
made AS (SELECT name, 'UNKNOWN_' || label || '_' || substr({sql_uuid5("'TEAM_' || replace(replace(replace(upper(name), '#', ' '), '_', ' '), '-', ' ')")}, 1, 8) AS raw
  FROM seen WHERE raw IS NULL AND name NOT IN (SELECT name FROM named)
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY o_orderkey, side) = 1),
all_names AS (SELECT name, raw FROM named UNION ALL SELECT name, raw FROM made)
SELECT o_orderkey, coalesce(home_raw, h.raw) AS home_raw, coalesce(away_raw, a.raw) AS away_raw
FROM m LEFT JOIN all_names h ON m.home_name = h.name LEFT JOIN all_names a ON m.away_name = a.name""")
def q_fallback_key(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    customers = lookup(customers, table(spark, folder, "nation"), "c_nationkey", "n_nationkey", {"n_name": "n_name"})
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    orders = lookup(orders, customers, "o_custkey", "c_custkey", {"c_name": "home_name", "n_name": "n_name"})
    matches = orders.select(
        "o_orderkey", "home_name",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("home_raw"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat("n_name", "o_orderpriority")).alias("away_raw"),
        F.concat_ws(" ", "n_name", "o_orderpriority").alias("away_name"),
    )
    resolved, _ = fallback_team_ids(matches, ["o_orderkey"])
    return resolved.select("o_orderkey", "home_raw", "away_raw")


@query("q_key_uniqueness", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_key_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- deduplication and unions ------------------------------------------------------------


@query("q_dedup_first", """
SELECT doc_id, lang, source, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def q_dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    return first_per_key(table(spark, folder, "documents"), ["text"], ["doc_id"]).drop("text")


@query("q_priority_dedup", """
SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderstatus, o_orderkey) = 1""")
def q_priority_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return by_priority(rows, ["o_custkey", "o_orderdate"], "o_orderstatus", ["F", "O"], ["o_orderkey"])


@query("q_union_branches", """
SELECT o_orderkey AS id, o_orderpriority AS label, 1 AS rank FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_orderpriority, 2 FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT c_custkey, c_mktsegment, 3 FROM customer""")
def q_union_branches(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    orders = payloads.routed(table(spark, folder, "orders"), "rank", {1: status == "F", 2: status == "O"})
    customers = payloads.renamed(table(spark, folder, "customer"), {"c_custkey": "id", "c_mktsegment": "label"})
    named = payloads.renamed(orders, {"o_orderkey": "id", "o_orderpriority": "label"}, "rank")
    return union_all([named, customers.withColumn("rank", F.lit(3))])


# -- summaries and checks ----------------------------------------------------------------

ENTITIES = {
    "documents": ("documents", ["text"]), "lineitem": ("lineitem", ["l_orderkey", "l_linenumber"]),
    "customers_with_orders": ("orders", ["o_custkey"]),
}


@query("q_run_summary", " UNION ALL ".join(
    f"SELECT '{name}' AS entity, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, count(*) AS kept, CAST(coalesce(sum(n), 0) - count(*) AS BIGINT) AS duplicates "
    f"FROM (SELECT count(*) AS n FROM {source} GROUP BY {', '.join(keys)})" for name, (source, keys) in ENTITIES.items()))
def q_run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return union_all([entity_summary(name, table(spark, folder, source), keys) for name, (source, keys) in ENTITIES.items()])


@query("q_dq_checks", """
SELECT 'known_part_unresolved' AS "check", count(*) AS failures FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_name IS NULL
UNION ALL SELECT 'event_without_match', count(*) FROM lineitem WHERE l_orderkey IS NULL
UNION ALL SELECT 'match_not_found', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT 'duplicate_key', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'bad_clock', count(*) FROM events WHERE event_type = 'error'""")
def q_dq_checks(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    resolved = lookup(lines, table(spark, folder, "part"), "l_partkey", "p_partkey", {"p_partkey": "found", "p_name": "p_name"})
    finished = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "F")
    clock = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.date_format("ts", "HH:mm:ss"))
    return union_all([
        failures("known_part_unresolved", resolved, F.col("found").isNotNull() & F.col("p_name").isNull()),
        failures("event_without_match", lines, F.col("l_orderkey").isNull()),
        failures("match_not_found", unmapped(lines, finished, "l_orderkey", "o_orderkey"), F.lit(True)),
        failures("duplicate_key", duplicate_keys(lines, ["l_orderkey", "l_linenumber"]), F.lit(True)),
        failures("bad_clock", table(spark, folder, "events"), clock_seconds(clock).isNull()),
    ])


# -- gold dimensions ---------------------------------------------------------------------


@query("q_dim_match", """
SELECT match_id, status, home_pts, away_pts, CASE WHEN home_pts > away_pts THEN 'HOME_WIN' WHEN away_pts > home_pts THEN 'AWAY_WIN'
  ELSE 'UNKNOWN' END AS result
FROM (SELECT o_orderkey AS match_id, o_orderstatus AS status, CAST(o_custkey % 7 AS INTEGER) AS home_pts,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 7 AS INTEGER) END AS away_pts FROM orders)""")
def q_dim_match(spark: SparkSession, folder: str) -> DataFrame:
    matches = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("match_id"), F.col("o_orderstatus").alias("status"),
        (F.col("o_custkey") % 7).cast("int").alias("home_pts"),
        F.when(F.col("o_orderstatus") != "P", (F.col("o_orderkey") % 7).cast("int")).alias("away_pts"),
    )
    return dim_match(matches)


@query("q_dims", """
SELECT 'player' AS dim, c_custkey AS id, c_name AS name FROM customer
UNION ALL SELECT 'team', s_suppkey, s_name FROM supplier
UNION ALL SELECT 'competition', CAST(n_nationkey AS BIGINT), n_name FROM nation""")
def q_dims(spark: SparkSession, folder: str) -> DataFrame:
    sources = {"player": ("customer", "c_custkey", "c_name"), "team": ("supplier", "s_suppkey", "s_name"), "competition": ("nation", "n_nationkey", "n_name")}
    return union_all([
        table(spark, folder, source).select(F.lit(dim).alias("dim"), F.col(key).cast("bigint").alias("id"), F.col(name).alias("name"))
        for dim, (source, key, name) in sources.items()
    ])
