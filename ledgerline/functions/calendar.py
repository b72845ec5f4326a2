"""Dates, seasons, file-name timestamps and game clocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the season label and of the file-name timestamp.
SEASON_PREFIX, SEASON_SUFFIX = "liganacional", "_basketball"
SEASON_FIRST_MONTH = 8
FILE_TIMESTAMP = r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})$"


def season_start(date: Column) -> Column:
    """First calendar year of the season a date falls in."""
    return F.year(date) - (F.month(date) < SEASON_FIRST_MONTH).cast("int")


def season_id(date: Column) -> Column:
    """Season label of a date, or of a string in ISO form."""
    start = season_start(date)
    # A formatter for each row would cost more than the rest of a path.
    years = [F.coalesce(year.cast("string"), F.lit("null")) for year in (start, start + 1)]
    return F.concat(F.lit(SEASON_PREFIX), *years, F.lit(SEASON_SUFFIX))


def file_timestamp(raw_id: Column) -> Column:
    """Minute-precision time in the last ``_`` token of a file name; null when malformed."""
    token = F.regexp_replace(F.substring_index(raw_id, "_", -1), r"\.json$", "")
    # Cast without a time zone: a clock time that a zone skips is still a valid time.
    iso = F.regexp_replace(token, FILE_TIMESTAMP, "$1-$2-$3 $4:$5:00")
    return F.when(token.rlike(FILE_TIMESTAMP), iso).try_cast("timestamp_ntz")


def clock_seconds(clock: Column) -> Column:
    """Seconds left on an ``HH:MM:SS.f`` clock; the hour field is ignored."""
    parts = F.split(clock, ":")
    minutes = F.get(parts, 1).try_cast("int")
    seconds = F.get(parts, 2).try_cast("double")
    return F.when(F.size(parts) == 3, minutes * 60 + seconds)


def match_result(home_points: Column, away_points: Column) -> Column:
    """HOME_WIN, AWAY_WIN, or UNKNOWN for ties and scores that are not numbers."""
    home = F.nanvl(home_points.try_cast("double"), F.lit(None).cast("double"))
    away = F.nanvl(away_points.try_cast("double"), F.lit(None).cast("double"))
    return F.when(home > away, F.lit("HOME_WIN")).when(away > home, F.lit("AWAY_WIN")).otherwise(F.lit("UNKNOWN"))
