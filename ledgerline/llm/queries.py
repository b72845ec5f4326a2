"""The operators of this package on the test tables, and SQL where SQL can express them."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import contamination, counts, interpolation, languages, near, negatives, neighbours, packing, pii, repeats, runs, sharding, urls
from ledgerline.session import ensure_checkpoint_dir

TOKENIZER = "word_bpe_49k.json"
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, so that every text of the table is counted by this run."""
    cache = f"{ensure_checkpoint_dir(spark)}/token-counts-{uuid.uuid4().hex}"
    return counts.count_tokens(_documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), cache)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify(_documents(spark, sf_dir))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_documents(spark, sf_dir))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(_documents(spark, sf_dir))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_documents(spark, sf_dir))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), urls.rule_table(spark, URL_RULES))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_documents(spark, sf_dir), 24)


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` where the words of each tenth text, by the checksum h of its id, go round in a
    period from word a on. Null ids and texts without words are left as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    g, n = F.floor(h / 10), F.size("_words")
    rounds = (3 + F.col("_g") % 8).cast("int")
    split = docs.select("doc_id", "text", words.alias("_words"), g.alias("_g")).withColumn("_a", F.when(n > 0, F.col("_g") % n).cast("int"))
    split = split.withColumn("_p", (1 + F.floor((n - F.col("_a")) / rounds)).cast("int"))
    period = F.slice("_words", F.col("_a") + 1, F.col("_p"))
    around = F.slice(F.flatten(F.array_repeat(period, rounds)), F.lit(1), n - F.col("_a"))
    planted = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_a")), around), " ")
    return split.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(with_planted_periods(_documents(spark, sf_dir)))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n"))))
    start, length, period = -F.col("_best.s"), F.col("_best.l"), -F.col("_best.p")
    return found.withColumn("_best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_interpolated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score_texts(_documents(spark, sf_dir))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved))


QUERIES = {
    f.__name__: f for f in (
        op1_packing, op2_decontamination, op3_token_counts, op4_language, op5_pii, op6_near_duplicates, op7_substring_dedup,
        op8_url_rules, op9_sharding, op10_neighbours, op11_periodic_runs,
        op12_interpolated_scores, op13_hard_negatives,
    )
}

ORACLES = {
    "op2_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 13) AS n, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i, w FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM bw),
sizes AS (SELECT DISTINCT n FROM windows),
dw AS (SELECT doc_id, n, unnest(generate_series(1, len(w) - n + 1)) AS i, w FROM d, sizes WHERE len(w) >= n),
found AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN windows ON dw.n = windows.n AND array_to_string(w[i:i + dw.n - 1], ' ') = s),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (SELECT doc_id, unnest(generate_series(1, len(w) - 34)) AS i, w FROM d WHERE len(w) >= 35),
hashed AS (SELECT doc_id, i, md5_number(array_to_string(w[i:i + 34], ' ')) AS h FROM wins),
again AS (SELECT h FROM hashed GROUP BY h HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS p FROM hashed JOIN again USING (h)),
words AS (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS s, count(*) AS n FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op8_url_rules": r"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
rules(v, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (SELECT page_id, host, path, h || p AS rule, v FROM u LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM fit
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1""",
    "op10_neighbours": """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 20""",
    "op11_periodic_runs": r"""
WITH RECURSIVE crc(doc_id, text, h, rest) AS (
  SELECT doc_id, text, 4294967295::UBIGINT, CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, text, list_reduce([xor(h, ascii(rest)::UBIGINT)] || list_resize([0::UBIGINT], 8, 0::UBIGINT),
    lambda c, x: xor(c >> 1, 3988292384::UBIGINT * (c & 1))), rest[2:] FROM crc WHERE rest <> ''),
d AS (SELECT doc_id, xor(h, 4294967295::UBIGINT)::BIGINT AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM crc WHERE rest = ''),
s AS (SELECT *, CAST(len(w) AS BIGINT) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM s),
x AS (SELECT doc_id, n, i, CASE WHEN i >= a THEN w[1 + a + (i - a) % p] ELSE w[1 + i] END AS w FROM (SELECT *, unnest(range(n)) AS i FROM p)),
same AS (SELECT b.doc_id, b.i, b.i - c.i AS q FROM x b JOIN x c ON b.doc_id = c.doc_id AND b.w = c.w AND c.i < b.i AND 4 * (b.i - c.i) <= b.n),
parts AS (SELECT doc_id, q, min(i) - q AS start, count(*) + q AS length FROM (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same) GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM parts WHERE length >= greatest(6, 4 * q) GROUP BY ALL),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t FROM x ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, (1000 * length) // period AS exponent_milli,
       sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op13_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e FROM embeddings),
scored AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
           FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id) WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10""",
}
