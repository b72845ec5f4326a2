"""From spelled names to entities: clusters of similar names and their canonical member."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import ids
from ledgerline.functions.text import clean_text, match_name
from ledgerline.operators.components import components
from ledgerline.operators.dedup import first_per_key
from ledgerline.operators.lookups import lookup
from ledgerline.operators.similar import BLOCK_ROWS, distinct_keys, similar_sets, token_sets
from ledgerline.session import cut_lineage, write_out

# Fixed value of the feed: the name of a player whose name is not known.
PLACEHOLDER = "NOMBRE"


def name_clusters(names: DataFrame, threshold: float = 95.0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(name, component)`` for every distinct name; single linkage over similar pairs.

    Clusters are built over token sets and each spelling follows its set, which keeps the
    graph free of the pairs between spellings of one set.
    """
    names = write_out(names.select("name").distinct())
    named = token_sets(names)
    keys = distinct_keys(names)
    edges = similar_sets(keys, threshold, block_rows).select(F.col("key_a").alias("u"), F.col("key_b").alias("v"))
    grouped = components(edges).select(F.col("node").alias("_node"), "component")
    clustered = named.join(grouped, F.col("key") == F.col("_node"), "left").select(
        "name", F.coalesce("component", "key").alias("set")
    )
    # A cluster is named by its smallest spelling.
    smallest = clustered.groupBy("set").agg(F.min("name").alias("component"))
    return clustered.join(smallest, "set").select("name", "component")


def extend_clusters(
    stored: DataFrame, names: DataFrame, threshold: float = 95.0, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(name, component)`` of all names, stored and new, as ``name_clusters`` would give for them
    together. ``stored`` is such a result for earlier names.

    Only pairs with a new name are looked for. A stored cluster enters the graph as one node, so
    what is contracted has the size of the batch and of the clusters that it touches.
    """
    new = names.select("name").distinct().join(stored, "name", "left_anti")
    known = cut_lineage(token_sets(stored.select("name", "component")))
    added = cut_lineage(token_sets(new))
    keys = known.select("key").unionByName(added.select("key")).distinct()
    fresh = cut_lineage(added.select("key").distinct().join(known, "key", "left_anti"))
    # A node is a stored cluster, by its name, or a new token set.
    node_of = known.select("key", F.concat(F.lit("cluster "), "component").alias("node")).distinct().unionByName(
        fresh.select("key", F.concat(F.lit("set "), "key").alias("node"))
    )
    pairs = similar_sets(cut_lineage(keys), threshold, block_rows, fresh)
    edges = pairs
    for side, end in (("key_a", "u"), ("key_b", "v")):
        edges = edges.join(node_of.select(F.col("key").alias(side), F.col("node").alias(end)), side)
    grouped = components(edges.select("u", "v")).select(F.col("node").alias("node"), F.col("component").alias("group"))
    placed = known.unionByName(added, allowMissingColumns=True).join(node_of, "key").join(grouped, "node", "left")
    placed = placed.select("name", F.coalesce("group", "node").alias("group"))
    smallest = placed.groupBy("group").agg(F.min("name").alias("component"))
    return placed.join(smallest, "group").select("name", "component")


def canonical_names(clusters: DataFrame) -> DataFrame:
    """``(component, canonical, members)``: the longest name, the first of equally long ones."""
    return clusters.groupBy("component").agg(
        F.min(F.struct((-F.length("name")).alias("short"), "name"))["name"].alias("canonical"),
        F.count("*").alias("members"),
    )


def name_mapping(clusters: DataFrame) -> DataFrame:
    """``(name, canonical)`` for every clustered name."""
    return clusters.join(canonical_names(clusters), "component").select("name", "canonical")


def with_overrides(players: DataFrame, overrides: DataFrame | None) -> DataFrame:
    """Final names: an override for placeholders with a known raw id, else the clean name.

    ``players`` has ``raw_id`` and ``player_name``; ``overrides`` has ``raw_id`` and ``name``
    and is used as written.
    """
    cleaned = clean_text(F.col("player_name"))
    if overrides is None:
        return players.withColumn("player_name", cleaned)
    keyed = players.withColumn("_wanted", F.when(F.col("player_name") == PLACEHOLDER, F.col("raw_id")))
    found = lookup(keyed, overrides, "_wanted", "raw_id", {"name": "_fixed"})
    return found.withColumn("player_name", F.coalesce(F.col("_fixed"), cleaned)).drop("_wanted", "_fixed")


def resolve_players(
    players: DataFrame,
    order: list[str],
    overrides: DataFrame | None = None,
    known_names: DataFrame | None = None,
    threshold: float = 95.0,
    block_rows: int = BLOCK_ROWS,
    cluster: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Resolve raw players to entities.

    Returns the entities ``(player_id, player_name)`` and the lookup ``(raw_id, player_id)``.
    ``known_names`` (``name``) adds the spellings of earlier batches to the clustering. ``cluster``
    takes the place of ``name_clusters``: it gets the spellings (``name``) and gives their clusters.
    """
    # A player is listed once per match; the first listing of each spelling is enough.
    spelled = first_per_key(players, ["raw_id", "player_name"], order)
    named = with_overrides(spelled, overrides).withColumn("name", match_name(F.col("player_name")))
    # A missing name says as little as the placeholder, and so is treated alike.
    is_placeholder = F.upper(F.trim("player_name")).isin(PLACEHOLDER, "") | (F.col("name") == "")
    named = write_out(named.withColumn("rank", is_placeholder.cast("int")))
    valid, unknown = named.filter("rank = 0"), named.filter("rank = 1")
    spellings = valid.select("name").distinct()
    if known_names is not None:
        spellings = spellings.unionByName(known_names.select("name")).distinct()
    mapping = name_mapping(cluster(spellings) if cluster else name_clusters(spellings, threshold, block_rows))
    mapped = lookup(valid, mapping, "name", "name", {"canonical": "canonical"})
    resolved = mapped.withColumn("player_name", F.col("canonical")).withColumn(
        "player_id", ids.player_id(F.col("canonical"))
    )
    placeholders = unknown.withColumn("player_name", F.lit(PLACEHOLDER)).withColumn(
        "player_id", ids.placeholder_player_id(F.col("raw_id"))
    )
    columns = ["raw_id", "player_id", "player_name", "rank", *order]
    everyone = resolved.select(*columns).unionByName(placeholders.select(*columns))
    entities = first_per_key(everyone, ["player_id"], ["rank", *order]).select("player_id", "player_name")
    by_raw_id = first_per_key(everyone, ["raw_id"], ["rank", *order]).select("raw_id", "player_id")
    return entities, by_raw_id
