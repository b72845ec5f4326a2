"""Fixed values of the play-by-play feed: event codes, roles and what each code scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Counters, in table order.
STATS = (
    "pts", "pf", "fg3m", "fg3a", "fg2m", "fg2a", "fg1m", "fg1a", "fta", "ftm", "tov",
    "stl", "orb", "drb", "ast", "blk", "ba", "tout", "tech", "flg", "ftrips",
)

# Codes that steer the stint machine.
PERIOD_START = ("INICIO-PERIODO",)
PERIOD_END = ("FINAL-PERIODO", "FINAL-PARTIDO")
PLAYER_IN = ("CAMBIO-JUGADOR-ENTRA",)
PLAYER_OUT = ("CAMBIO-JUGADOR-SALE",)
IGNORED = (
    "FALTA-RECIBIDA",
    "1-TIRO-LIBRE",
    "FLECHA-ALTERNANCIA-LOCAL",
    "FLECHA-ALTERNANCIA-VISITANTE",
)

# What each code adds. A missed free throw adds to fg1m in the feed's own
# bookkeeping; CORRECTED_SCORING counts it as an attempt instead.
SCORING = {
    "ASISTENCIA": {"ast": 1},
    "CANASTA-1P": {"pts": 1, "fg1m": 1, "ftm": 1, "fta": 1},
    "CANASTA-2P": {"pts": 2, "fg2m": 1, "fg2a": 1},
    "CANASTA-3P": {"pts": 3, "fg3m": 1, "fg3a": 1},
    "TIRO1-FALLADO": {"fg1m": 1, "fta": 1},
    "TIRO2-FALLADO": {"fg2a": 1},
    "TIRO3-FALLADO": {"fg3a": 1},
    "PERDIDA": {"tov": 1},
    "RECUPERACION": {"stl": 1},
    "REBOTE-DEFENSIVO": {"drb": 1},
    "REBOTE-OFENSIVO": {"orb": 1},
    "TAPON-COMETIDO": {"blk": 1},
    "TAPON-RECIBIDO": {"ba": 1},
    "FALTA-COMETIDA": {"pf": 1},
    "TANTIDEPORTIVA": {"flg": 1, "pf": 1},
    "TECNICA": {"tech": 1, "pf": 1},
    "TECNICA-E": {"tech": 1},
    "TBANQUILLO-B": {"tech": 1, "pf": 1},
    "TBANQUILLO-C": {"tech": 1, "pf": 1},
    "TDESCALIFICANTE": {"tech": 1, "pf": 1},
    "TIEMPO-MUERTO-SOLICITADO": {"tout": 1},
    "2-TIROS-LIBRES": {"ftrips": 1},
    "3-TIROS-LIBRES": {"ftrips": 1},
}
CORRECTED_SCORING = {
    **SCORING,
    "CANASTA-1P": {"pts": 1, "fg1m": 1, "fg1a": 1, "ftm": 1, "fta": 1},
    "TIRO1-FALLADO": {"fg1a": 1, "fta": 1},
}


def event_kind(code: Column) -> Column:
    """Role of an event: START, END, IN, OUT, IGNORE, or PLAY for everything else."""
    return (
        F.when(code.isin(*IGNORED), F.lit("IGNORE"))
        .when(code.isin(*PERIOD_START), F.lit("START"))
        .when(code.isin(*PERIOD_END), F.lit("END"))
        .when(code.isin(*PLAYER_IN), F.lit("IN"))
        .when(code.isin(*PLAYER_OUT), F.lit("OUT"))
        .otherwise(F.lit("PLAY"))
    )


def stat_increment(code: Column, stat: str, scoring: dict[str, dict[str, int]]) -> Column:
    """What an event of this code adds to one counter."""
    by_value: dict[int, list[str]] = {}
    for name, adds in scoring.items():
        if stat in adds:
            by_value.setdefault(adds[stat], []).append(name)
    value = F.lit(0)
    for amount, names in by_value.items():
        value = F.when(code.isin(*names), F.lit(amount)).otherwise(value)
    return value.cast("bigint")
