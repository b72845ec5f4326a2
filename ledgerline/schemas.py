"""Declared schemas of the raw documents and of the stored tables."""

from __future__ import annotations

# Scalars of the raw documents are read as text: the feed writes ids and numbers both ways.
RAW_MATCH = (
    "estado_partido string, tipo_acta string, local string, visitante string, idlocal string, "
    "idvisitante string, tanteo_local string, tanteo_visitante string, numperiodos string, "
    "tiempo_total_partido string, numperiodos_total string, duracion_partido_mm string, "
    "duracion_periodo_extra_mm string"
)
RAW_EVENT = (
    "autoincremental_id string, equipo_id string, componente_id string, numero_periodo string, "
    "tiempo_partido string, accion_tipo string, posicion_x string, posicion_y string, dorsal string, "
    "zona string, informacion_adicional string"
)
RAW_PLAYER = "IdJugador string, Nombre string"
RAW_DOCUMENT = (
    "resultado string, error string, "
    f"partido struct<{RAW_MATCH.replace(' string', ':string')}>, "
    f"envivo struct<historialacciones:array<struct<{RAW_EVENT.replace(' string', ':string')}>>>, "
    "EnVivoJugadoresOTT struct<"
    f"JugadoresEnVivoLocal:array<struct<{RAW_PLAYER.replace(' string', ':string')}>>, "
    f"JugadoresEnVivoVisitante:array<struct<{RAW_PLAYER.replace(' string', ':string')}>>>"
)

TEAM_KEY = ["team_id"]
PLAYER_KEY = ["player_id"]
COMPETITION_KEY = ["id_comp"]
MATCH_KEY = ["match_id"]
EVENT_KEY = ["pbp_id"]
STINT_KEY = ["stint_id", "match_id"]
FACT_KEY = ["stint_id", "match_id", "team_id", "player_id"]

MATCH_TABLE = [
    "match_id", "home_id", "away_id", "id_comp", "date", "status", "home_pts", "away_pts",
    "periods", "total_duration_mm", "extra_duration_mm",
]
EVENT_TABLE = [
    "seq", "period", "clk", "event_type", "jersey", "x", "y", "zone", "note", "team_id",
    "player_id", "match_id", "pbp_id",
]
