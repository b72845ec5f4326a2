"""Deterministic identifiers and identifier clean-up."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.text import clean_text

# They define every stored identifier.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_DNS, "basketball.etl.system")
TEAM_PREFIX = "TEAM_"
PLAYER_PREFIX = "PLAYER_"
COMPETITION_PREFIX = "COMP_"
MATCH_PREFIX = "MATCH_"
UNKNOWN_PREFIX = "UNKNOWN_"
MISSING_IDS = ("0", "", "nan", "None")


def uuid5(name: Column, namespace: uuid.UUID = NAMESPACE) -> Column:
    """Version-5 UUID of a string, computed with ``sha1`` inside the JVM; null for null."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"), F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12),
    )


def team_id(name: Column) -> Column:
    return uuid5(F.concat(F.lit(TEAM_PREFIX), clean_text(name)))


def player_id(name: Column) -> Column:
    return uuid5(F.concat(F.lit(PLAYER_PREFIX), clean_text(name)))


def competition_id(name: Column) -> Column:
    return uuid5(F.concat(F.lit(COMPETITION_PREFIX), clean_text(name)))


def match_id(home_name: Column, away_name: Column, date: Column) -> Column:
    """Identifier of a match: day and the two clean names; the hour plays no part. Without a
    readable day there is none."""
    return uuid5(
        F.concat(
            F.lit(MATCH_PREFIX),
            F.date_format(date, "yyyyMMdd"),
            F.lit("_"),
            clean_text(home_name),
            F.lit("_"),
            clean_text(away_name),
        )
    )


def event_id(match: Column, period: Column, clock: Column, seq: Column, event_type: Column) -> Column:
    """Identifier of a play-by-play event; the fraction of the clock plays no part."""
    clk = F.when(clock.isNull() | (clock == ""), F.lit("00:00")).otherwise(F.split_part(clock, F.lit("."), F.lit(1)))
    return uuid5(
        F.concat_ws(
            "_",
            F.coalesce(match, F.lit("unknown")),
            F.coalesce(period.cast("string"), F.lit("0")),
            clk,
            F.coalesce(seq.cast("string"), F.lit("0")),
            F.coalesce(event_type, F.lit("")),
        )
    )


def placeholder_player_id(raw_id: Column) -> Column:
    return F.concat(F.lit(UNKNOWN_PREFIX), F.coalesce(raw_id.cast("string"), F.lit("None")))


def provisional_team_id(side: Column, name: Column) -> Column:
    """Stand-in raw id for a team that arrives without one; ``side`` is LOCAL or AWAY."""
    return F.concat(F.lit(UNKNOWN_PREFIX), side, F.lit("_"), F.substring(team_id(name), 1, 8))


def clean_id(raw: Column) -> Column:
    """Trim, drop a trailing ``.0`` and turn the spellings of 'missing' into null."""
    text = F.regexp_replace(F.trim(raw.cast("string")), r"\.0$", "")
    return F.when(~text.isin(*MISSING_IDS), text)


def sentinel_to_null(value: Column, sentinel: str = "-1") -> Column:
    text = value.cast("string")
    return F.when(text != sentinel, text)
