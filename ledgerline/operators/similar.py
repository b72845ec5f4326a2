"""All pairs of similar names, without comparing every name with every other.

The score depends only on the set of tokens, so equal sets are handled once. A pair that
reaches the threshold does so in one of two ways, and each leaves a trace that a join on
equality finds:

* one set is contained in the other, but for a few short tokens. Then one of the rarest
  tokens of the smaller set, or two of them where it has enough, also occur in the larger.
* the tokens that differ are ``d`` insertions and deletions apart, with ``d`` a small share
  of the total length. Up to two, which covers names of ordinary length, taking out letters
  on either side leads to the same tokens: an equality join on all such shortened forms
  (deletion neighbourhoods, Mor and Fraenkel 1982) whose size grows with the names alone.
  For long names, where more edits are allowed, each edit touches at most ``GRAM`` letter
  grams, so the rarest grams of both must overlap (prefix filtering, Bayardo et al. 2007).
  Requiring ``n`` common grams makes that join more selective at the price of a longer
  prefix (Wang et al. 2012): keys start with two grams, and names under a key that too many
  share move on to three and four grams. No candidate is ever dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.similarity import token_set, with_similarity
from ledgerline.operators.dedup import top_per_key
from ledgerline.session import cut_lineage, write_out

GRAM = 3
# Below this threshold a short name may share no gram at all with its partner.
LOWEST_THRESHOLD = 95.0
FIRST_LEVEL, LAST_LEVEL = 2, 4
# Pairs that may differ by this many letters or more are found by grams.
GRAM_EDITS = 3
# Longest prefix for which all subsets of 3 or 4 grams are listed, under a thousand each.
LONGEST_PREFIX = {3: 19, 4: 13}
# A key held by more names than this is refined.
BLOCK_ROWS = 2_000


def _shuffled(side: DataFrame) -> DataFrame:
    """``side``, to be joined by a sort-merge join. Plans estimate rows that an array was exploded
    into as if they were still one, so large sides would pass for small ones and be broadcast."""
    return side.hint("merge")


def token_sets(names: DataFrame) -> DataFrame:
    """Add ``key``: the distinct tokens in order, joined by blanks."""
    return names.withColumn("key", F.array_join(token_set(F.col("name")), " ")).filter(F.col("key") != "")


def _by_rarity(keys: DataFrame, name: str) -> DataFrame:
    """Per key its ``features``, the globally rarest first. The list is as long as one name."""
    one_each = keys.select("key", F.explode("features").alias("feature"))
    frequency = one_each.groupBy("feature").agg(F.count("*").alias("frequency"))
    return (
        one_each.join(_shuffled(frequency), "feature")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("frequency", "feature"))).alias("ranked"))
        .select("key", F.transform("ranked", lambda r: r["feature"]).alias(name))
    )


def _with_grams(keys: DataFrame) -> DataFrame:
    """Letter grams of every token, padded by one blank, repeated ones numbered."""

    def windows(token: Column) -> Column:
        padded = F.concat(F.lit(" "), token, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.length(token)), lambda i: F.substring(padded, i, F.lit(GRAM)))

    cut = keys.select("key", F.flatten(F.transform(F.split("key", " "), windows)).alias("_windows"))
    numbered = F.transform(
        "_windows",
        lambda g, i: F.concat(g, F.size(F.filter(F.slice("_windows", 1, i), lambda x: x == g)).cast("string")),
    )
    return cut.select("key", numbered.alias("features"))


def _edits(length: Column, threshold: float) -> Column:
    """The most insertions and deletions between a name of this length and any partner."""
    share = (100.0 - threshold) / 100.0
    longest_partner = F.floor(length * (1 + share) / (1 - share) + 1e-9)
    return F.floor((length + longest_partner) * share + 1e-9).cast("int")


def _subsets(prefix: Column, size: int) -> Column:
    """All subsets of ``size`` elements of an array, as strings."""

    def extend(start: Column, left: int, text: Column | None) -> Column:
        rest = F.slice(prefix, start, F.greatest(F.size(prefix) - start + 1, F.lit(0)))

        def pick(element: Column, i: Column) -> Column:
            joined = element if text is None else F.concat(text, F.lit("|"), element)
            return joined if left == 1 else extend(start + i + 1, left - 1, joined)

        picked = F.transform(rest, pick)
        return picked if left == 1 else F.flatten(picked)

    return extend(F.lit(1), size, None)


def _met(left: DataFrame, right: DataFrame, on: str, left_key: str, right_key: str, fresh: DataFrame | None) -> DataFrame:
    """Join on ``on``. With ``fresh`` (key) only where one of the two keys is fresh: values that no
    fresh key has are dropped on both sides before they meet."""
    if fresh is None:
        return left.join(_shuffled(right), on)
    parts = []
    for side, key in ((left, left_key), (right, right_key)):
        parts.append(side.join(_shuffled(fresh.select(F.col("key").alias(key))), key, "left_semi").select(on))
    touched = _shuffled(parts[0].unionByName(parts[1]).distinct())
    return left.join(touched, on, "left_semi").join(_shuffled(right.join(touched, on, "left_semi")), on)


def _contained_candidates(keys: DataFrame, threshold: float, fresh: DataFrame | None = None) -> DataFrame:
    """Pairs where the rare tokens of one set meet the tokens of another.

    A set that must have two tokens in common with its partner is looked up by pairs of its
    rarest tokens, so a surname that many people share is no key by itself.
    """
    share = (100.0 - threshold) / 100.0
    length = F.length("key")
    # Letters that may be left over: left + 1 <= share * (2 * length - left - 1).
    spare = F.floor((2 * share * length - share - 1) / (1 + share) + 1e-9)
    droppable = F.greatest(F.floor((spare + 1) / 2), F.lit(0)).cast("int")
    ranked = _by_rarity(keys.withColumn("features", F.split("key", " ")), "tokens")
    two = F.size("tokens") >= droppable + 2
    one_of = ranked.filter(~two).select(
        F.col("key").alias("small"), F.explode(F.slice("tokens", F.lit(1), droppable + 1)).alias("token")
    )
    two_of = ranked.filter(two).select(
        F.col("key").alias("small"), F.explode(_subsets(F.array_sort(F.slice("tokens", F.lit(1), droppable + 2)), 2)).alias("token")
    )
    single = keys.select(F.col("key").alias("large"), F.explode(F.split("key", " ")).alias("token"))
    double = keys.select(F.col("key").alias("large"), F.explode(_subsets(F.array_sort(F.split("key", " ")), 2)).alias("token"))
    met = _met(one_of, single, "token", "small", "large", fresh).unionByName(_met(two_of, double, "token", "small", "large", fresh))
    met = met.filter(F.col("small") != F.col("large"))
    # The leftovers of the small side must be as short as the threshold asks.
    left = F.array_join(F.array_except(F.split("small", " "), F.split("large", " ")), " ")
    short_enough = F.length(left) <= F.greatest(
        F.floor((2 * share * F.length("small") - share - 1) / (1 + share) + 1e-9), F.lit(0)
    )
    return met.filter(short_enough).select(
        F.least("small", "large").alias("key_a"), F.greatest("small", "large").alias("key_b")
    )


def _without_one_letter(tokens: Column) -> Column:
    """All token lists with one letter, or the blank between two tokens, taken out.

    Any two tokens may be neighbours, because common tokens between them are set aside.
    """
    count = F.size(tokens)

    def drop(token: Column, i: Column) -> Column:
        shorter = lambda j: F.concat(F.substring(token, F.lit(1), j - 1), F.substring(token, j + 1, F.length(token)))
        places = F.when(F.length(token) > 0, F.sequence(F.lit(1), F.length(token))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda j: F.concat(F.slice(tokens, 1, i), F.array(shorter(j)), F.slice(tokens, i + 2, count)))

    def merge(token: Column, i: Column) -> Column:
        return F.transform(
            F.slice(tokens, i + 2, count),
            lambda other, gap: F.concat(
                F.slice(tokens, 1, i), F.array(F.concat(token, other)), F.slice(tokens, i + 2, gap), F.slice(tokens, i + gap + 3, count)
            ),
        )

    return F.concat(F.flatten(F.transform(tokens, drop)), F.flatten(F.transform(tokens, merge)))


def _shortened(rows: DataFrame) -> DataFrame:
    """Every form of ``tokens`` with one letter less, each once per name."""
    lists = rows.select("key", "length", _without_one_letter(F.col("tokens")).alias("lists"))
    return lists.select("key", "length", F.explode(F.array_distinct("lists")).alias("tokens"))


def _few_edits_candidates(keys: DataFrame, threshold: float, fresh: DataFrame | None = None) -> DataFrame:
    """Pairs that meet after taking out at most two letters in all."""
    share = (100.0 - threshold) / 100.0
    size = F.col("length")
    # Names so long that any partner allows more edits are left to the grams.
    own = keys.select("key", F.length("key").alias("length"), F.split("key", " ").alias("tokens")).filter(
        (share * (2 * size + 1) + 1e-9 >= 1) & (share * (2 * size - 2) + 1e-9 < GRAM_EDITS)
    )
    once = _shortened(own.filter(share * (2 * size - 1) + 1e-9 >= 1))
    twice = _shortened(_shortened(own.filter(share * (2 * size - 2) + 1e-9 >= 2)))

    def forms(rows: DataFrame, taken: int, suffix: str) -> DataFrame:
        form = F.xxhash64(F.array_sort("tokens")).alias("form")
        return rows.select(
            form, F.col("key").alias(f"key_{suffix}"), size.alias(f"length_{suffix}"), F.lit(taken).alias(f"taken_{suffix}")
        ).distinct()

    # Whole names meet shortened ones, and names shortened once meet each other. Names
    # shortened twice never do, however many share a form.
    met = _met(forms(own, 0, "a"), forms(once, 1, "b").unionByName(forms(twice, 2, "b")), "form", "key_a", "key_b", fresh)
    both = _met(forms(once, 1, "a"), forms(once, 1, "b"), "form", "key_a", "key_b", fresh)
    met = met.unionByName(both.filter(F.col("key_a") < F.col("key_b")))
    edits = F.col("taken_a") + F.col("taken_b")
    same_size = F.col("length_a") - F.col("taken_a") == F.col("length_b") - F.col("taken_b")
    allowed = edits <= (F.col("length_a") + F.col("length_b")) * share + 1e-9
    return met.filter((F.col("key_a") != F.col("key_b")) & same_size & allowed).select(
        F.least("key_a", "key_b").alias("key_a"), F.greatest("key_a", "key_b").alias("key_b")
    )


def _many_edits_candidates(
    keys: DataFrame, threshold: float, block_rows: int, fresh: DataFrame | None = None
) -> DataFrame:
    """Pairs of long names whose rarest grams overlap enough for the rest to be close."""
    eligible = keys.filter(_edits(F.length("key"), threshold) >= GRAM_EDITS)
    if eligible.isEmpty():
        return keys.filter(F.lit(False)).select(F.col("key").alias("key_a"), F.col("key").alias("key_b"))
    names = cut_lineage(
        _by_rarity(_with_grams(eligible), "grams")
        .withColumn("length", F.length("key"))
        .withColumn("kept", _edits(F.length("key"), threshold) * GRAM)
    )
    share = (100.0 - threshold) / 100.0
    found = None
    for level in range(FIRST_LEVEL, LAST_LEVEL + 1):
        prefix = F.slice("grams", F.lit(1), F.col("kept") + level)
        # A name too short for the next level, or so long that it would have too many keys
        # there, must meet all its partners here.
        following = F.col("kept") + level + 1
        stuck = (F.size("grams") < following) | (following > LONGEST_PREFIX.get(level + 1, 0))
        blocks = names.select("key", "length", stuck.alias("stuck"), prefix.alias("prefix")).select(
            "key", "length", "stuck", F.explode(_subsets(F.col("prefix"), level)).alias("block")
        )
        crowded = None
        if level < LAST_LEVEL:
            sizes = blocks.groupBy("block").count().filter(F.col("count") > block_rows).select("block")
            crowded = cut_lineage(sizes)
            if crowded.isEmpty():
                crowded = None
            else:
                crowded = _shuffled(crowded)
        roomy = blocks if crowded is None else blocks.join(crowded, "block", "left_anti")
        pairs = _within_blocks(roomy, roomy, share, F.col("key_a") < F.col("key_b"), fresh)
        if crowded is not None:
            packed = blocks.join(crowded, "block", "left_semi")
            one_stuck = (F.col("key_a") != F.col("key_b")) & (~F.col("stuck_b") | (F.col("key_a") < F.col("key_b")))
            pairs = pairs.unionByName(_within_blocks(packed.filter("stuck"), packed, share, one_stuck, fresh))
        found = pairs if found is None else found.unionByName(pairs)
        if crowded is None:
            break
        movers = packed.filter(~F.col("stuck")).select("key").distinct()
        names = cut_lineage(names.join(_shuffled(movers), "key", "left_semi"))
    return found.select(F.least("key_a", "key_b").alias("key_a"), F.greatest("key_a", "key_b").alias("key_b"))


def _within_blocks(
    left: DataFrame, right: DataFrame, share: float, keep: Column, fresh: DataFrame | None = None
) -> DataFrame:
    a = left.select("block", *[F.col(c).alias(f"{c}_a") for c in ("key", "length", "stuck")])
    b = right.select("block", *[F.col(c).alias(f"{c}_b") for c in ("key", "length", "stuck")])
    total = F.col("length_a") + F.col("length_b")
    near = (F.abs(F.col("length_a") - F.col("length_b")) <= total * share + 1e-9) & (total * share + 1e-9 >= GRAM_EDITS)
    return _met(a, b, "block", "key_a", "key_b", fresh).filter(keep & near).select("key_a", "key_b")


def similar_sets(
    keys: DataFrame, threshold: float = 95.0, block_rows: int = BLOCK_ROWS, fresh: DataFrame | None = None
) -> DataFrame:
    """Pairs ``key_a < key_b`` of distinct token sets with their ``score``; with ``fresh``, some of
    the keys, only the pairs that one of those is part of."""
    if threshold < LOWEST_THRESHOLD:
        raise ValueError(f"candidates are only complete from threshold {LOWEST_THRESHOLD} on")
    candidates = (
        _contained_candidates(keys, threshold, fresh)
        .unionByName(_few_edits_candidates(keys, threshold, fresh))
        .unionByName(_many_edits_candidates(keys, threshold, block_rows, fresh))
        .distinct()
    )
    if fresh is not None:
        ends = [candidates.join(_shuffled(fresh.select(F.col("key").alias(side))), side, "left_semi") for side in ("key_a", "key_b")]
        candidates = ends[0].unionByName(ends[1].select("key_a", "key_b")).distinct()
    tokens = candidates.withColumn("_a", F.split("key_a", " ")).withColumn("_b", F.split("key_b", " "))
    return with_similarity(tokens, "_a", "_b", threshold).drop("_a", "_b").filter(F.col("score") >= threshold)


def distinct_keys(names: DataFrame) -> DataFrame:
    """The distinct token sets of ``names.name``, written out once.

    Later steps multiply the rows, so they are spread by a fixed count and not by size.
    """
    keys = token_sets(names.select("name").distinct()).select("key").distinct()
    partitions = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(keys.repartition(partitions, "key"))


def similar_names(names: DataFrame, threshold: float = 95.0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All unordered pairs ``name_a < name_b`` of distinct names with score >= threshold."""
    names = write_out(names.select("name").distinct())
    named = token_sets(names)
    sets = similar_sets(distinct_keys(names), threshold, block_rows)
    a = named.select(F.col("name").alias("name_a"), F.col("key").alias("key_a"))
    b = named.select(F.col("name").alias("name_b"), F.col("key").alias("key_b"))
    across = sets.join(_shuffled(a), "key_a").join(_shuffled(b), "key_b").select(
        F.least("name_a", "name_b").alias("name_a"), F.greatest("name_a", "name_b").alias("name_b"), "score"
    )
    # Spellings of one set are all full matches of each other.
    same = a.join(_shuffled(b), F.col("key_a") == F.col("key_b")).filter(F.col("name_a") < F.col("name_b"))
    return across.unionByName(same.select("name_a", "name_b", F.lit(100.0).alias("score")))


def best_matches(pairs: DataFrame, limit: int = 5) -> DataFrame:
    """Per name its best later partners, ties in alphabetical order."""
    return top_per_key(pairs, ["name_a"], [F.desc("score"), "name_b"], limit)
