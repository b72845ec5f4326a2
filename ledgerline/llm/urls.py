"""URL rules by host-suffix and path-prefix expressions; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_HEX = 8  # four bytes of the digest
SALTS = 32


def host_of(url: Column) -> Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A table of rules ``(verdict, host, path)`` from a literal list."""
    rows = ", ".join(f"(:v{i}, :h{i}, :p{i})" for i in range(len(rules)))
    if not rules:
        return spark.sql("SELECT '' AS verdict, '' AS host, '' AS path WHERE false")
    args = {f"{c}{i}": x for i, rule in enumerate(rules) for c, x in zip("vhp", rule)}
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(verdict, host, path)", args)


def _expression(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


def judge_urls(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow",
) -> DataFrame:
    """The key, host, path, rule and verdict of every row of ``pages``.

    A rule ``(verdict, host, path)`` fits its host and every subdomain, if the path starts with
    its path. Every URL is expanded into the host-suffix and path-prefix expressions of the
    shapes (labels, characters) that rules have; expressions meet rules by a short prefix of
    their digest and are then confirmed by the whole digest. The rule with the longest host and
    path together wins, then the longer host, then block before allow. Without a rule the
    verdict is ``default`` and the rule null.

    A null URL or one without ``://`` has an empty host and path and takes the default. Repeated
    rows each give a row, null keys are kept, other columns play no part, and empty tables are
    fine. URLs are judged once per distinct URL and salt, so one URL that fills a third of the
    table is spread over many tasks.
    """
    ruled = rules.filter(F.col("host").isNotNull()).select(
        F.col("verdict"), F.col("host").alias("_rule_host"), F.coalesce("path", F.lit("")).alias("_rule_path")
    )
    ruled = ruled.groupBy("_rule_host", "_rule_path").agg(F.max("verdict").alias("_verdict"))  # block over allow
    # How many labels and characters rules have: bounded by the longest rule, not by their number.
    shapes = ruled.select(
        F.size(F.split("_rule_host", r"\.")).alias("labels"), F.char_length("_rule_path").alias("chars")
    ).distinct()
    shape_list = [(r.labels, r.chars) for r in shapes.collect()]

    parts = pages.select(
        F.col(key).alias("_key"), F.col(url).alias("_url"), F.pmod(F.xxhash64(key), F.lit(SALTS)).alias("_salt")
    )
    distinct = parts.select("_url", "_salt").filter(F.col("_url").isNotNull()).distinct()
    split = distinct.select("_url", "_salt", host_of(F.col("_url")).alias("_host"), path_of(F.col("_url")).alias("_path"))
    split = split.filter(F.col("_host") != "").withColumn("_labels", F.split("_host", r"\."))
    options = [
        F.when(
            (F.size("_labels") >= n) & (F.char_length("_path") >= c),
            _expression(F.array_join(F.slice("_labels", -n, n), "."), F.substring("_path", 1, c)),
        )
        for n, c in shape_list
    ] or [F.lit(None).cast("string")]
    expanded = split.select("_url", "_salt", F.explode(F.array_compact(F.array(*options))).alias("_text"))
    expanded = expanded.withColumn("_digest", F.sha2("_text", 256)).drop("_text")
    expanded = expanded.withColumn("_prefix", F.substring("_digest", 1, PREFIX_HEX))

    keyed = ruled.withColumn("_rule_digest", F.sha2(_expression(F.col("_rule_host"), F.col("_rule_path")), 256))
    keyed = keyed.withColumn("_prefix", F.substring("_rule_digest", 1, PREFIX_HEX))
    met = expanded.join(keyed, "_prefix").filter(F.col("_digest") == F.col("_rule_digest"))
    rank = F.struct(
        (F.char_length("_rule_host") + F.char_length("_rule_path")).alias("both"), F.char_length("_rule_host").alias("host"),
        F.concat("_rule_host", "_rule_path").alias("rule"), F.col("_verdict").alias("verdict"),
    )
    best = met.groupBy("_url", "_salt").agg(F.max(rank).alias("_best"))
    return parts.join(best, ["_url", "_salt"], "left").select(
        F.col("_key").alias(key), host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"),
        F.col("_best.rule").alias("rule"), F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"),
    )
