"""Many-to-one joins against reference tables.

No side is hinted: Spark broadcasts a table only when its measured size allows and splits
skewed keys at run time. Null keys never match, so they are spread by a hash of their row
instead of meeting in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import ids
from ledgerline.functions.text import strip
from ledgerline.operators.dedup import first_per_key, require_unique
from ledgerline.session import write_out


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    table_key: str,
    columns: dict[str, str],
    check: bool = False,
) -> DataFrame:
    """Left join of ``rows.key`` on the unique ``table.table_key``.

    ``columns`` maps columns of ``table`` to their new names. With ``check`` a duplicate in
    the table is an error. Select the columns you need first: the hash that spreads null keys
    reads all columns of ``rows``.
    """
    if check:
        table = require_unique(table, [table_key])
    right = table.select(
        F.col(table_key).alias("_key"), F.lit(0).cast("bigint").alias("_slot"), *[F.col(c).alias(n) for c, n in columns.items()]
    )
    spread = F.xxhash64(*rows.columns)
    left = rows.withColumn("_row_slot", F.when(F.col(key).isNull(), spread).otherwise(0))
    matched = left.join(right, (F.col(key) == F.col("_key")) & (F.col("_row_slot") == F.col("_slot")), "left")
    return matched.drop("_key", "_slot", "_row_slot")


def known_or_null(rows: DataFrame, table: DataFrame, key: str, table_key: str) -> DataFrame:
    """Null out values of ``rows.key`` that ``table`` does not know."""
    known = table.select(F.col(table_key).alias("_known")).distinct()
    return lookup(rows, known, key, "_known", {"_known": "_hit"}).withColumn(key, F.col("_hit")).drop("_hit")


def unmapped(rows: DataFrame, table: DataFrame, key: str, table_key: str) -> DataFrame:
    """Rows whose key is missing from ``table``; a null key is missing too."""
    return rows.join(table.select(F.col(table_key).alias("_known")), F.col(key) == F.col("_known"), "left_anti")


def unmapped_summary(rows: DataFrame, key: str, sample: int = 5) -> DataFrame:
    """Number of rows and up to ``sample`` smallest distinct keys among unmapped rows.

    The keys are reduced to one row each before the few smallest are taken.
    """
    per_key = rows.groupBy(key).agg(F.count("*").alias("events"))
    smallest = per_key.select(key).orderBy(F.col(key).asc_nulls_last()).limit(sample)
    total = per_key.agg(F.coalesce(F.sum("events"), F.lit(0)).alias("events"), F.count("*").alias("keys"))
    listed = smallest.agg(F.concat_ws(",", F.array_sort(F.collect_list(F.col(key).cast("string")))).alias("sample"))
    # Two single rows, each with its own columns, folded into one.
    both = total.unionByName(listed, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def fallback_team_ids(matches: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Give every match two raw team ids, and list the teams.

    ``matches`` has ``home_raw``, ``away_raw`` (null when missing), ``home_name``,
    ``away_name``. A missing id is taken from a team of the same name; if there is none, a
    provisional id is derived from the name and the side on which it appeared first.
    Returns the matches and ``(raw_id, team_name, order columns, side_rank)`` of all teams,
    one row per raw id.
    """

    def side(prefix: str, label: str, rank: int) -> DataFrame:
        return matches.select(
            F.col(f"{prefix}_raw").alias("raw_id"),
            F.coalesce(strip(F.col(f"{prefix}_name")), F.lit("None")).alias("team_name"),
            F.lit(label).alias("label"), F.lit(rank).alias("side_rank"), *order,
        )

    in_order = [*order, "side_rank"]
    seen = side("home", "LOCAL", 0).unionByName(side("away", "AWAY", 1))
    # One pass over the matches; what follows works on teams, of which there are few.
    seen = write_out(first_per_key(seen, ["raw_id", "team_name"], in_order))
    known = first_per_key(seen.filter(F.col("raw_id").isNotNull()), ["raw_id"], in_order)
    # When two ids share a name, the one met last stands for the name.
    by_name = first_per_key(known, ["team_name"], [F.desc(c) for c in in_order]).select(
        "team_name", F.col("raw_id").alias("named_id")
    )
    nameless = seen.filter(F.col("raw_id").isNull()).join(by_name.select("team_name"), "team_name", "left_anti")
    named = nameless.withColumn("raw_id", ids.provisional_team_id(F.col("label"), F.col("team_name")))
    # Names that are equal once cleaned share a provisional id.
    provisional = first_per_key(named, ["raw_id"], in_order)
    ids_by_name = write_out(by_name.unionByName(named.select("team_name", F.col("raw_id").alias("named_id"))))

    def resolved(rows: DataFrame, prefix: str) -> DataFrame:
        raw, name = f"{prefix}_raw", f"{prefix}_name"
        needed = F.when(F.col(raw).isNull(), F.coalesce(strip(F.col(name)), F.lit("None")))
        rows = lookup(rows.withColumn("_needed", needed), ids_by_name, "_needed", "team_name", {"named_id": "_named"})
        return rows.withColumn(raw, F.coalesce(raw, "_named")).drop("_needed", "_named")

    teams = known.unionByName(provisional).select("raw_id", "team_name", *order, "side_rank")
    return resolved(resolved(matches, "home"), "away"), teams


def null_safe(left: Sequence[str], right: Sequence[str]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right, strict=True):
        condition = condition & F.col(a).eqNullSafe(F.col(b))
    return condition
