"""Stint queries over ``events``: a hundred events make a match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog.registry import query, table
from ledgerline.operators.stints import StintTables, box_score, stint_tables
from ledgerline.plans.gold import career_totals, match_totals
from ledgerline.rules import STATS

SCORING = {"purchase": {"pts": 3, "fg3m": 1}, "click": {"ast": 1}, "view": {"tov": 1}}
USED = ("pts", "fg3m", "ast", "tov")


def event_log(spark: SparkSession, folder: str, match: Column | None = None) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    kind = (
        F.when(F.col("event_type") == "signup", "IN")
        .when(F.col("event_type") == "error", "OUT")
        .when((F.col("event_type") == "view") & (k < 20), "START")
        .when((F.col("event_type") == "view") & (k < 35), "END")
        .when((F.col("event_type") == "view") & (k >= 90), "IGNORE")
        .otherwise("PLAY")
    )
    match = F.floor(F.col("event_id") / 100) if match is None else match
    return table(spark, folder, "events").select(
        match.cast("bigint").alias("match_id"),
        F.col("event_id").alias("seq"),
        F.lit(0).alias("tie"),
        kind.alias("kind"),
        F.col("event_type").alias("code"),
        F.format_string("00:0%d:30.0", 9 - F.col("event_id") % 10).alias("clk"),
        (F.col("user_id") % 2).alias("team_id"),
        (F.col("user_id") % 12).alias("player_id"),
        (F.col("user_id") % 2 == 0).alias("home"),
    )


def event_stints(spark: SparkSession, folder: str) -> StintTables:
    return stint_tables(event_log(spark, folder), scoring=SCORING)


def skewed_match() -> Column:
    """The same log with one match that holds a third of all events."""
    return F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.floor(F.col("event_id") / 100))


def sql_log(match: str = "event_id // 100") -> str:
    return f"""
log AS (
  SELECT * FROM (
    SELECT CAST({match} AS BIGINT) AS match_id, event_id AS seq, event_type AS code,
      '00:0' || CAST(9 - event_id % 10 AS VARCHAR) || ':30.0' AS clk,
      user_id % 2 = 0 AS home, user_id % 12 AS player_id,
      CASE WHEN event_type = 'signup' THEN 'IN' WHEN event_type = 'error' THEN 'OUT'
        WHEN event_type = 'view' AND k < 20 THEN 'START' WHEN event_type = 'view' AND k < 35 THEN 'END'
        WHEN event_type = 'view' AND k >= 90 THEN 'IGNORE' ELSE 'PLAY' END AS kind
    FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)
  ) WHERE kind <> 'IGNORE'
),
numbered AS (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY seq) AS rn FROM log),
marked AS (
  SELECT *, coalesce(max(CASE kind WHEN 'START' THEN rn * 2 + 1 WHEN 'END' THEN rn * 2 END) OVER (
      PARTITION BY match_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1 AS active
  FROM numbered
),
waiting AS (
  SELECT *, kind IN ('START', 'PLAY') OR (kind = 'END' AND active) AS flushes,
    coalesce(max(CASE WHEN kind IN ('IN', 'OUT') THEN rn * 2 + 1
      WHEN kind IN ('START', 'PLAY') OR (kind = 'END' AND active) THEN rn * 2 END) OVER (
      PARTITION BY match_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1 AS pending
  FROM marked
),
opened AS (SELECT *, kind = 'START' OR (kind = 'PLAY' AND pending) AS opens FROM waiting),
counted AS (
  SELECT *,
    sum(CAST(opens AS INTEGER)) OVER upto - 1 AS sid,
    sum(CASE WHEN kind = 'START' THEN 1 ELSE 0 END) OVER upto AS nperiod,
    sum(CASE WHEN kind = 'END' THEN 1 ELSE 0 END) OVER upto AS epoch,
    min(CASE WHEN flushes THEN rn END) OVER (
      PARTITION BY match_id ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS flush_rn
  FROM opened WINDOW upto AS (PARTITION BY match_id ORDER BY rn)
),
life AS (
  SELECT *, lead(kind) OVER l AS next_kind, lead(active) OVER l AS next_active, lead(clk) OVER l AS next_clk,
    lag(opens) OVER l AS after_open
  FROM counted WHERE opens OR kind = 'END' WINDOW l AS (PARTITION BY match_id ORDER BY rn)
),
stints AS (
  SELECT match_id, CAST(sid AS BIGINT) AS stint_id, CAST(nperiod AS BIGINT) AS nperiod, epoch, clk AS start_clk,
    next_clk AS end_clk
  FROM life WHERE opens AND (next_kind = 'PLAY' OR (next_kind = 'END' AND next_active))
),
actions AS (
  SELECT s.match_id, o.epoch, s.home, s.player_id, o.sid AS osid, s.kind,
    row_number() OVER (PARTITION BY s.match_id, s.home, s.player_id, o.sid ORDER BY s.rn DESC) AS latest
  FROM counted s JOIN counted o ON s.match_id = o.match_id AND s.flush_rn = o.rn AND o.opens
  WHERE s.kind IN ('IN', 'OUT')
),
spans AS (
  SELECT *, lead(osid) OVER (PARTITION BY match_id, epoch, home, player_id ORDER BY osid) AS nsid
  FROM actions WHERE latest = 1
),
lineups AS (
  SELECT s.match_id, s.stint_id, i.home, i.player_id
  FROM stints s JOIN spans i ON s.match_id = i.match_id AND s.epoch = i.epoch
    AND s.stint_id >= i.osid AND (i.nsid IS NULL OR s.stint_id < i.nsid)
  WHERE i.kind = 'IN'
),
closers AS (
  SELECT match_id, rn, CASE WHEN kind = 'END' AND active THEN sid
    WHEN kind = 'PLAY' AND after_open THEN sid - 1 END AS closes FROM life
),
targets AS (
  SELECT c.match_id, c.home, c.player_id, c.code, CASE WHEN c.active THEN c.sid ELSE max(closes) OVER (
    PARTITION BY c.match_id ORDER BY c.rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS target, c.kind
  FROM counted c LEFT JOIN closers x ON c.match_id = x.match_id AND c.rn = x.rn
),
credits AS (
  SELECT match_id, target, home, player_id, CASE WHEN code = 'purchase' THEN 3 ELSE 0 END AS pts,
    CASE WHEN code = 'purchase' THEN 1 ELSE 0 END AS fg3m, CASE WHEN code = 'click' THEN 1 ELSE 0 END AS ast,
    CASE WHEN code = 'view' THEN 1 ELSE 0 END AS tov
  FROM targets WHERE kind = 'PLAY' AND target IS NOT NULL
)"""


def _columns(expression: str, stats: tuple[str, ...] = STATS, prefix: str = "") -> str:
    """SQL columns for the counters; those the binding never raises are zero."""
    return ", ".join(
        f"CAST({expression.format(s=s) if s in USED else 0} AS BIGINT) AS {prefix}{s}" for s in stats
    )


def sql_facts(match: str = "event_id // 100") -> str:
    return f"""WITH {sql_log(match)},
facts AS (
  SELECT l.stint_id, l.match_id, l.player_id, CASE WHEN l.home THEN 'HOME' ELSE 'AWAY' END AS team_id,
    {_columns("coalesce(c.{s}, 0)")}
  FROM lineups l LEFT JOIN (
    SELECT match_id, target, player_id, sum(pts) AS pts, sum(fg3m) AS fg3m, sum(ast) AS ast, sum(tov) AS tov
    FROM credits GROUP BY ALL) c
  ON l.match_id = c.match_id AND l.stint_id = c.target AND l.player_id = c.player_id
)"""


@query("q_stints", f"""WITH {sql_log()}
SELECT stint_id, match_id, nperiod, start_clk, end_clk,
  (CAST(substr(start_clk, 4, 2) AS DOUBLE) - CAST(substr(end_clk, 4, 2) AS DOUBLE)) * 60 AS duration_sec FROM stints""")
def q_stints(spark: SparkSession, folder: str) -> DataFrame:
    return event_stints(spark, folder).stints()


@query("q_lineups", f"""WITH {sql_log()}
SELECT match_id, stint_id, CASE WHEN home THEN 'HOME' ELSE 'AWAY' END AS side, player_id FROM lineups""")
def q_lineups(spark: SparkSession, folder: str) -> DataFrame:
    side = F.when(F.col("home"), F.lit("HOME")).otherwise(F.lit("AWAY"))
    return event_stints(spark, folder).keep().lineups().select("match_id", "stint_id", side.alias("side"), "player_id")


@query("q_player_stints", f"{sql_facts()} SELECT * FROM facts")
def q_player_stints(spark: SparkSession, folder: str) -> DataFrame:
    return event_stints(spark, folder).keep().player_stints()


SKEWED_SQL = "CASE WHEN event_id % 3 = 0 THEN -1 ELSE event_id // 100 END"


@query("q_player_stints_skewed", f"{sql_facts(SKEWED_SQL)} SELECT * FROM facts")
def q_player_stints_skewed(spark: SparkSession, folder: str) -> DataFrame:
    log = event_log(spark, folder, skewed_match())
    return stint_tables(log, scoring=SCORING, chunk_rows=1000).keep().player_stints()


@query("q_team_stints", f"""WITH {sql_log()}
SELECT s.match_id, s.stint_id, s.nperiod, s.start_clk, s.end_clk,
  {_columns("coalesce(c.h_{s}, 0)", prefix="h_")}, {_columns("coalesce(c.a_{s}, 0)", prefix="a_")}
FROM stints s LEFT JOIN (
  SELECT match_id, target, {", ".join(f"sum(CASE WHEN home THEN {s} ELSE 0 END) AS h_{s}, sum(CASE WHEN home THEN 0 ELSE {s} END) AS a_{s}" for s in USED)}
  FROM credits GROUP BY ALL) c ON s.match_id = c.match_id AND s.stint_id = c.target""")
def q_team_stints(spark: SparkSession, folder: str) -> DataFrame:
    return event_stints(spark, folder).keep().team_stints()


@query("q_boxscore", f"""WITH {sql_log()}
SELECT match_id, player_id, {_columns("sum({s})")}
FROM (SELECT match_id, player_id, CASE WHEN code = 'purchase' THEN 3 ELSE 0 END AS pts,
    CASE WHEN code = 'purchase' THEN 1 ELSE 0 END AS fg3m, CASE WHEN code = 'click' THEN 1 ELSE 0 END AS ast,
    CASE WHEN code = 'view' THEN 1 ELSE 0 END AS tov FROM log WHERE kind = 'PLAY')
GROUP BY match_id, player_id""")
def q_boxscore(spark: SparkSession, folder: str) -> DataFrame:
    return box_score(event_log(spark, folder), SCORING)


@query("q_rollup_match", f"""{sql_facts()}
SELECT match_id, team_id, {_columns("sum({s})")}, count(*) AS player_stints FROM facts GROUP BY match_id, team_id""")
def q_rollup_match(spark: SparkSession, folder: str) -> DataFrame:
    return match_totals(q_player_stints(spark, folder))


@query("q_rollup_player", f"""{sql_facts()}
SELECT player_id, {_columns("sum({s})")}, count(*) AS player_stints, count(DISTINCT match_id) AS matches
FROM facts GROUP BY player_id""")
def q_rollup_player(spark: SparkSession, folder: str) -> DataFrame:
    return career_totals(q_player_stints(spark, folder))
