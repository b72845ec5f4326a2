"""Text normalisation."""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@cache
def _folding() -> tuple[str, str]:
    """Arguments of ``translate``: accented Latin characters to their base, marks to nothing."""
    accented, plain, marks = [], [], []
    for code in (*range(0x80, 0x20000), *range(0xE0100, 0xE01F0)):
        char = chr(code)
        if unicodedata.category(char) == "Mn":
            marks.append(char)
            continue
        parts = unicodedata.normalize("NFD", char)
        base = [p for p in parts if unicodedata.category(p) != "Mn"]
        if parts != char and len(base) == 1 and base[0].upper().isascii():
            accented.append(char)
            plain.append(base[0])
    return "".join(accented + marks), "".join(plain)


def clean_text(text: Column, remove_punctuation: bool = True) -> Column:
    """Strip accents, upper-case, blank out punctuation and squeeze whitespace.

    Null becomes the empty string. With ``remove_punctuation`` only ``A-Z0-9()`` and
    single spaces survive, so the whole function stays in the JVM: a character that has
    no ASCII base ends up as a blank whichever way it decomposes.
    """
    if not remove_punctuation:
        return _clean_keep_punctuation(F.coalesce(text, F.lit("")))
    folded = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, *_folding())).otherwise(text)
    blanked = F.regexp_replace(F.upper(folded), "[^A-Z0-9()]+", " ")
    return F.coalesce(F.trim(blanked), F.lit(""))


@F.pandas_udf(StringType())
def _clean_keep_punctuation(text: pd.Series) -> pd.Series:
    # Spark has no normalize() function and any script may appear here.
    bare = text.map(
        lambda s: "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")
    )
    return bare.map(lambda s: " ".join(s.upper().split()))


def match_name(name: Column) -> Column:
    """The form of a player name used for matching: no commas, single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(name, ",", ""), r"\s+", " "))


def strip(text: Column) -> Column:
    """Trim every kind of blank, not only the space character."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")
