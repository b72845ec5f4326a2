"""Scalar functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog.registry import query, table
from ledgerline.functions import calendar, ids
from ledgerline.functions.text import clean_text
from ledgerline.operators.lookups import lookup
from ledgerline.operators.resolve import with_overrides


def sql_uuid5(text: str) -> str:
    digest = f"sha1(unhex('{ids.NAMESPACE.hex}') || encode({text}))"
    return (
        f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3) || '-' || "
        f"translate(substr({digest}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({digest}, 18, 3) "
        f"|| '-' || substr({digest}, 21, 12)"
    )


def sql_clean(text: str) -> str:
    plain = f"upper(strip_accents(replace(coalesce({text}, ''), 'ß', 'ss')))"
    return f"trim(regexp_replace({plain}, '[^A-Z0-9()]+', ' ', 'g'))"


@query("q_clean_text", f"SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents")
def q_clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", clean_text(F.col("text")).alias("cleaned"))


@query("q_season_id", """
SELECT o_orderkey, 'liganacional' || CAST(y AS VARCHAR) || CAST(y + 1 AS VARCHAR) || '_basketball' AS season_id
FROM (SELECT o_orderkey, year(o_orderdate) - CASE WHEN month(o_orderdate) < 8 THEN 1 ELSE 0 END AS y FROM orders)""")
def q_season_id(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", calendar.season_id(F.col("o_orderdate")).alias("season_id"))


@query("q_uuid5", f"SELECT n_nationkey, {sql_uuid5('n_name')} AS id FROM nation")
def q_uuid5(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select("n_nationkey", ids.uuid5(F.col("n_name")).alias("id"))


@query("q_uuid5_nulls", f"""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN {sql_uuid5('o_orderpriority')} END AS id FROM orders""")
def q_uuid5_nulls(spark: SparkSession, folder: str) -> DataFrame:
    name = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return table(spark, folder, "orders").select("o_orderkey", ids.uuid5(name).alias("id"))


@query("q_entity_ids", f"""
SELECT c_custkey, {sql_uuid5("'TEAM_' || " + sql_clean("c_mktsegment"))} AS team_id,
  {sql_uuid5("'PLAYER_' || " + sql_clean("c_name"))} AS player_id,
  {sql_uuid5("'COMP_' || " + sql_clean("c_mktsegment"))} AS id_comp FROM customer""")
def q_entity_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_custkey",
        ids.team_id(F.col("c_mktsegment")).alias("team_id"),
        ids.player_id(F.col("c_name")).alias("player_id"),
        ids.competition_id(F.col("c_mktsegment")).alias("id_comp"),
    )


@query("q_match_id", f"""
SELECT o_orderkey, {sql_uuid5("'MATCH_' || strftime(o_orderdate, '%Y%m%d') || '_' || " + sql_clean("c_name") + " || '_' || " + sql_clean("o_orderpriority"))} AS match_id
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def q_match_id(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    named = lookup(orders, table(spark, folder, "customer"), "o_custkey", "c_custkey", {"c_name": "home"})
    return named.select(
        "o_orderkey", ids.match_id(F.col("home"), F.col("o_orderpriority"), F.col("o_orderdate")).alias("match_id")
    )


@query("q_event_id", f"""
SELECT event_id, {sql_uuid5("CAST(user_id AS VARCHAR) || '_' || CAST(event_id % 4 + 1 AS VARCHAR) || '_' || CASE WHEN event_type = 'error' THEN '00:00' ELSE strftime(ts, '%H:%M:%S') END || '_' || CAST(event_id AS VARCHAR) || '_' || event_type")} AS pbp_id
FROM events""")
def q_event_id(spark: SparkSession, folder: str) -> DataFrame:
    # Events of type error stand for an empty clock.
    clock = F.when(F.col("event_type") == "error", "").otherwise(F.date_format("ts", "HH:mm:ss.S"))
    return table(spark, folder, "events").select(
        "event_id",
        ids.event_id(
            F.col("user_id").cast("string"), F.col("event_id") % 4 + 1, clock, F.col("event_id"), F.col("event_type")
        ).alias("pbp_id"),
    )


@query("q_parse_filename_ts", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + INTERVAL 21 HOUR + INTERVAL 5 MINUTE END AS date
FROM orders""")
def q_parse_filename_ts(spark: SparkSession, folder: str) -> DataFrame:
    stamp = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM")).otherwise(
        F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("2105"))
    )
    raw_id = F.concat(F.lit("team_a_team_b_"), stamp, F.lit(".json"))
    return table(spark, folder, "orders").select("o_orderkey", calendar.file_timestamp(raw_id).alias("date"))



@query("q_clean_id", """
SELECT o_orderkey, CASE WHEN o_custkey = 0 AND o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') THEN NULL
  WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS id FROM orders""")
def q_clean_id(spark: SparkSession, folder: str) -> DataFrame:
    key, priority = F.col("o_custkey").cast("string"), F.col("o_orderpriority")
    raw = (
        F.when(priority == "1-URGENT", F.concat(F.lit(" "), key, F.lit(" ")))
        .when(priority == "2-HIGH", F.concat(key, F.lit(".0")))
        .when(priority == "3-MEDIUM", "0")
        .when(priority == "4-NOT SPECIFIED", "nan")
        .otherwise(key)
    )
    return table(spark, folder, "orders").select("o_orderkey", ids.clean_id(raw).alias("id"))


@query("q_name_override", f"""
SELECT CAST(c_custkey AS VARCHAR) AS raw_id, CASE WHEN c_mktsegment = 'BUILDING' AND n_nationkey IS NOT NULL THEN n_name || ', X'
  WHEN c_mktsegment = 'BUILDING' THEN 'NOMBRE' ELSE {sql_clean('c_name')} END AS player_name
FROM customer LEFT JOIN nation ON c_custkey = n_nationkey""")
def q_name_override(spark: SparkSession, folder: str) -> DataFrame:
    players = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("raw_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "NOMBRE").otherwise(F.col("c_name")).alias("player_name"),
    )
    overrides = table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("string").alias("raw_id"), F.concat("n_name", F.lit(", X")).alias("name")
    )
    return with_overrides(players, overrides)


@query("q_placeholder_ids", "SELECT c_custkey, 'UNKNOWN_' || CAST(c_custkey AS VARCHAR) AS player_id FROM customer")
def q_placeholder_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_custkey", ids.placeholder_player_id(F.col("c_custkey")).alias("player_id")
    )


@query("q_match_result", """
SELECT l_orderkey, CASE WHEN h > a THEN 'HOME_WIN' WHEN a > h THEN 'AWAY_WIN' ELSE 'UNKNOWN' END AS result
FROM (SELECT l_orderkey, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS h,
  sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS a FROM lineitem GROUP BY l_orderkey)""")
def q_match_result(spark: SparkSession, folder: str) -> DataFrame:
    points = lambda status: F.sum(F.when(F.col("l_linestatus") == status, F.col("l_quantity"))).cast("string")
    scores = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(points("F").alias("h"), points("O").alias("a"))
    return scores.select("l_orderkey", calendar.match_result(F.col("h"), F.col("a")).alias("result"))


@query("q_clock_seconds", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(minute(ts) * 60 + second(ts) AS DOUBLE) + 0.5 END AS seconds
FROM events""")
def q_clock_seconds(spark: SparkSession, folder: str) -> DataFrame:
    clock = F.when(F.col("event_type") == "error", "12:7").otherwise(F.concat(F.date_format("ts", "HH:mm:ss"), F.lit(".5")))
    return table(spark, folder, "events").select("event_id", calendar.clock_seconds(clock).alias("seconds"))
