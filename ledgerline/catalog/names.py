"""Name matching over names derived from ``customer``: three spellings per person.

Persons get a surname that spells their number in syllables, so that the names grow with
the table. No name is longer than 19 letters. Two leftovers can then differ by one letter
at most, which lets the SQL side use the built-in edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog.registry import query, table
from ledgerline.catalog.scalars import sql_clean, sql_uuid5
from ledgerline.functions.text import match_name
from ledgerline.operators.resolve import canonical_names, name_clusters, resolve_players
from ledgerline.operators.similar import best_matches, similar_names

SYLLABLES = ("BA", "CE", "DI", "FO", "GU", "HA", "JE", "KI", "LO", "MU", "NA", "PE", "RI", "SO", "TU", "VA")
FIRST = ("JUAN", "LUIS", "RAUL", "HUGO", "INES", "ALMA", "ROSA", "IVAN")
SECOND = ("ANA", "EVA", "LEO", "SOL", "PAZ", "MAR", "LUZ", "TEO")
SPELLED_SYLLABLES = 5


def _pick(words: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*map(F.lit, words)), (index % len(words)).cast("int"))


def spelled_name() -> Column:
    person, variant = F.floor(F.col("c_custkey") / 3), F.col("c_custkey") % 3
    surname = F.concat(*[_pick(SYLLABLES, F.floor(person / len(SYLLABLES) ** i)) for i in range(SPELLED_SYLLABLES)])
    first, second = _pick(FIRST, F.floor(person / 8)), _pick(SECOND, F.floor(person / 64))
    return (
        F.when(variant == 0, F.concat_ws(" ", surname, first, second))
        .when(variant == 1, F.concat_ws(" ", first, surname))
        .otherwise(F.concat(surname, F.substring(surname, -1, 1), F.lit(", "), first))
    )


def _sql_pick(words: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"([{listed}])[CAST(({index}) % {len(words)} + 1 AS INTEGER)]"


SQL_SURNAME = " || ".join(_sql_pick(SYLLABLES, f"c_custkey // 3 // {len(SYLLABLES) ** i}") for i in range(SPELLED_SYLLABLES))
SQL_SPELLED = f"""spelled AS (
  SELECT *, CASE c_custkey % 3 WHEN 0 THEN surname || ' ' || first || ' ' || second WHEN 1 THEN first || ' ' || surname
    ELSE surname || right(surname, 1) || ', ' || first END AS spelling
  FROM (SELECT *, {SQL_SURNAME} AS surname, {_sql_pick(FIRST, "c_custkey // 3 // 8")} AS first,
    {_sql_pick(SECOND, "c_custkey // 3 // 64")} AS second FROM customer))"""


def sql_pairs(names: str) -> str:
    """All pairs scored by definition; leftovers one letter apart are the only close ones."""
    return f"""names AS MATERIALIZED (SELECT name, list_sort(list_distinct(string_split(name, ' '))) AS t FROM ({names})),
compared AS (
  SELECT a.name AS name_a, b.name AS name_b, list_filter(a.t, lambda x: list_contains(b.t, x)) AS both_t,
    array_to_string(list_filter(a.t, lambda x: NOT list_contains(b.t, x)), ' ') AS ra,
    array_to_string(list_filter(b.t, lambda x: NOT list_contains(a.t, x)), ' ') AS rb
  FROM names a JOIN names b ON a.name < b.name
),
measured AS (SELECT *, length(array_to_string(both_t, ' ')) AS s, CASE WHEN len(both_t) > 0 THEN 1 ELSE 0 END AS gap FROM compared),
scored AS (
  SELECT name_a, name_b, CASE WHEN s > 0 AND (ra = '' OR rb = '') THEN 100.0 ELSE greatest(
    CASE WHEN s > 0 THEN 100.0 - 100.0 * (gap + length(ra)) / (2 * s + gap + length(ra)) ELSE 0 END,
    CASE WHEN s > 0 THEN 100.0 - 100.0 * (gap + length(rb)) / (2 * s + gap + length(rb)) ELSE 0 END,
    CASE WHEN levenshtein(ra, rb) = 1 AND length(ra) <> length(rb)
      THEN 100.0 - 100.0 * 1 / (2 * (s + gap) + length(ra) + length(rb)) ELSE 0 END) END AS score
  FROM measured
),
pairs AS MATERIALIZED (SELECT name_a, name_b, CAST(score AS DOUBLE) AS score FROM scored WHERE score >= 95)"""


SQL_NAMES = "SELECT DISTINCT trim(replace(spelling, ',', '')) AS name FROM spelled"
SQL_CLUSTERS = """edges AS (SELECT name_a AS u, name_b AS v FROM pairs UNION ALL SELECT name_b, name_a FROM pairs),
reached AS (
  SELECT name AS node, name AS seen FROM names
  UNION
  SELECT r.node, e.v FROM reached r JOIN edges e ON r.seen = e.u
),
clusters AS (SELECT node AS name, min(seen) AS component FROM reached GROUP BY node)"""
SQL_CANONICAL = """canonical AS (
  SELECT component, name AS canonical, count(*) OVER (PARTITION BY component) AS members FROM clusters
  QUALIFY row_number() OVER (PARTITION BY component ORDER BY length(name) DESC, name) = 1)"""


def customer_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(match_name(spelled_name()).alias("name"))


@query("q_fuzzy_pairs", f"WITH {SQL_SPELLED}, {sql_pairs(SQL_NAMES)} SELECT name_a, name_b, round(score, 6) AS score FROM pairs")
def q_fuzzy_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return similar_names(customer_names(spark, folder)).withColumn("score", F.round("score", 6))


@query("q_topk_matches", f"""WITH {SQL_SPELLED}, {sql_pairs(SQL_NAMES)}
SELECT name_a, name_b, round(score, 6) AS score, CAST(row_number() OVER w AS INTEGER) AS position FROM pairs
WINDOW w AS (PARTITION BY name_a ORDER BY score DESC, name_b) QUALIFY row_number() OVER w <= 5""")
def q_topk_matches(spark: SparkSession, folder: str) -> DataFrame:
    return best_matches(similar_names(customer_names(spark, folder)), 5).withColumn("score", F.round("score", 6))


@query("q_name_clusters", f"WITH RECURSIVE {SQL_SPELLED}, {sql_pairs(SQL_NAMES)}, {SQL_CLUSTERS} SELECT name, component FROM clusters")
def q_name_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return name_clusters(customer_names(spark, folder))


@query("q_canonical_name", f"""WITH RECURSIVE {SQL_SPELLED}, {sql_pairs(SQL_NAMES)}, {SQL_CLUSTERS}, {SQL_CANONICAL}
SELECT component, canonical, members FROM canonical""")
def q_canonical_name(spark: SparkSession, folder: str) -> DataFrame:
    return canonical_names(name_clusters(customer_names(spark, folder)))


@query("q_resolve_players", f"""WITH RECURSIVE {SQL_SPELLED},
players AS (
  SELECT CAST(c_custkey AS VARCHAR) AS raw_id, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'BUILDING' AND n_name IS NULL THEN 'NOMBRE'
    WHEN c_mktsegment = 'BUILDING' THEN n_name || ', X' ELSE {sql_clean("spelling")} END AS player_name
  FROM spelled LEFT JOIN nation ON c_custkey = n_nationkey
),
valid AS (SELECT raw_id, trim(replace(player_name, ',', '')) AS name FROM players WHERE player_name IS NOT NULL AND player_name <> 'NOMBRE'),
{sql_pairs("SELECT DISTINCT name FROM valid")}, {SQL_CLUSTERS}, {SQL_CANONICAL}
SELECT raw_id, {sql_uuid5("'PLAYER_' || " + sql_clean("canonical"))} AS player_id, canonical AS player_name
FROM valid JOIN clusters USING (name) JOIN canonical USING (component)
UNION ALL SELECT raw_id, 'UNKNOWN_' || raw_id, 'NOMBRE' FROM players WHERE player_name IS NULL OR player_name = 'NOMBRE'""")
def q_resolve_players(spark: SparkSession, folder: str) -> DataFrame:
    name = F.when(F.col("c_acctbal") < 0, F.lit(None)).when(F.col("c_mktsegment") == "BUILDING", "NOMBRE").otherwise(spelled_name())
    players = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("raw_id"), name.alias("player_name"), "c_custkey"
    )
    overrides = table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("string").alias("raw_id"), F.concat("n_name", F.lit(", X")).alias("name")
    )
    entities, by_raw_id = resolve_players(players, ["c_custkey"], overrides)
    return by_raw_id.join(entities, "player_id").select("raw_id", "player_id", "player_name")
