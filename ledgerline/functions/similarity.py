"""Token-set similarity of two names, 0 to 100, as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


def token_set(name: Column) -> Column:
    """Distinct blank-separated tokens in order."""
    tokens = F.split(F.trim(F.regexp_replace(name, r"\s+", " ")), " ")
    return F.array_sort(F.array_distinct(F.filter(tokens, lambda t: t != "")))


@F.pandas_udf(IntegerType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    """Longest common subsequence of two strings; null when either is null."""

    # Nested, so that executors need no copy of this package.
    def common_letters(x: str, y: str) -> int:
        """One column of the table per bit (the recurrence of Crochemore et al. 2001)."""
        where: dict[str, int] = {}
        for i, letter in enumerate(x):
            where[letter] = where.get(letter, 0) | (1 << i)
        full = (1 << len(x)) - 1
        row = full
        for letter in y:
            met = row & where.get(letter, 0)
            row = ((row + met) | (row - met)) & full
        return len(x) - row.bit_count()

    both = zip(a, b, strict=True)
    return pd.Series([None if x is None or y is None else common_letters(x, y) for x, y in both], dtype="Int32")


def _ratio(distance: Column, length: Column) -> Column:
    return F.lit(100.0) - F.lit(100.0) * distance / length


def with_similarity(pairs: DataFrame, a: str, b: str, threshold: float, name: str = "score") -> DataFrame:
    """Add the similarity of the token sets in columns ``a`` and ``b`` (sorted arrays).

    Common tokens are set aside. If nothing is left over on one side the score is 100.
    Otherwise it is the best of comparing the leftovers by insertions and deletions, and the
    common part with the common part plus either leftover; distances are related to the
    full lengths of the strings compared. Scores below ``threshold`` become 0.

    The steps are separate projections, so that no expression is evaluated twice.
    """
    columns = pairs.columns
    gap = F.when(F.col("_shared") > 0, 1).otherwise(0)
    rest_a, rest_b = F.length("_rest_a"), F.length("_rest_b")
    parts = pairs.select(
        *columns,
        F.length(F.array_join(F.array_intersect(a, b), " ")).alias("_shared"),
        F.array_join(F.array_sort(F.array_except(a, b)), " ").alias("_rest_a"),
        F.array_join(F.array_sort(F.array_except(b, a)), " ").alias("_rest_b"),
        ((F.size(a) > 0) & (F.size(b) > 0)).alias("_both"),
    )
    measured = parts.withColumn("_total", 2 * (F.col("_shared") + gap) + rest_a + rest_b)
    with_a = _ratio(gap + rest_a, 2 * F.col("_shared") + gap + rest_a)
    with_b = _ratio(gap + rest_b, 2 * F.col("_shared") + gap + rest_b)
    allowed = F.floor(F.col("_total") * (100.0 - threshold) / 100.0 + 1e-9)
    known = measured.select(
        "*",
        F.when(~F.col("_both"), 0.0)
        .when((F.col("_shared") > 0) & ((rest_a == 0) | (rest_b == 0)), 100.0)
        .when(F.col("_shared") > 0, F.greatest(with_a, with_b))
        .otherwise(0.0)
        .alias("_known"),
        # The built-in edit distance never exceeds the insert/delete distance: a cheap first look.
        (F.col("_both") & (F.levenshtein("_rest_a", "_rest_b") <= allowed)).alias("_near"),
    )
    # Only close leftovers are worth the exact distance, and only they reach Python.
    open_ = F.col("_near") & (F.col("_known") < 100)
    compared = known.withColumn(
        "_common", lcs_length(F.when(open_, F.col("_rest_a")), F.when(open_, F.col("_rest_b")))
    )
    leftovers = _ratio(rest_a + rest_b - 2 * F.col("_common"), F.col("_total"))
    score = F.greatest(F.col("_known"), leftovers)
    scored = compared.select(*columns, score.alias(name))
    return scored.withColumn(name, F.when(F.col(name) >= threshold, F.col(name)).otherwise(0.0))
