"""Raw payloads: fixture lists, synthetic payloads, nested documents to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the feed.
NOT_STARTED_FIXTURE = "No comenzado"
FINISHED_FIXTURE = "Terminado"
FINISHED = "FINALIZADO"
NOT_STARTED = "NO_COMENZADO"
NO_DATA = "sin datos"
PAYLOAD_TYPES = ("pbp", "agg_by_player", "agg_by_team")
DEFAULTS = {"periods": 4, "total_duration_mm": 10, "extra_duration_mm": 5}

# Raw names of the event columns and ours.
EVENT_COLUMNS = {
    "autoincremental_id": "seq",
    "numero_periodo": "period",
    "tiempo_partido": "clk",
    "accion_tipo": "event_type",
    "dorsal": "jersey",
    "posicion_x": "x",
    "posicion_y": "y",
    "zona": "zone",
    "informacion_adicional": "note",
    "equipo_id": "team_raw_id",
    "componente_id": "player_raw_id",
}
# Raw names of the match columns and ours.
MATCH_COLUMNS = {
    "estado_partido": "status",
    "tanteo_local": "home_pts",
    "tanteo_visitante": "away_pts",
    "numperiodos_total": "periods",
    "duracion_partido_mm": "total_duration_mm",
    "duracion_periodo_extra_mm": "extra_duration_mm",
}


def split_by_value(rows: DataFrame, column: str, *values: str) -> tuple[DataFrame, ...]:
    """One frame per value; rows with any other value belong to none."""
    return tuple(rows.filter(F.col(column) == value) for value in values)


def routed(rows: DataFrame, column: str, routes: dict[str | int, Column]) -> DataFrame:
    """Every row once for each route whose condition holds, with the route in ``column``.

    The rows are read once, however many routes there are; a row on no route is dropped.
    """
    taken = F.array(*[F.when(condition, F.lit(route)) for route, condition in routes.items()])
    return rows.withColumn(column, F.explode(F.filter(taken, lambda route: route.isNotNull())))


def is_upcoming(column: str = "status", upcoming: str = NOT_STARTED) -> Column:
    """Whether a match has not been played; an unknown status counts as played."""
    return F.coalesce(F.col(column) == upcoming, F.lit(False))


def split_played(matches: DataFrame, column: str = "status", upcoming: str = NOT_STARTED) -> tuple[DataFrame, DataFrame]:
    """Played and upcoming matches; an unknown status counts as played."""
    ahead = is_upcoming(column, upcoming)
    return matches.filter(~ahead), matches.filter(ahead)


def without_errors(rows: DataFrame, error: Column, marker: str = NO_DATA) -> DataFrame:
    """Drop payloads that carry the no-data marker; a missing error field is fine."""
    return rows.filter(~error.eqNullSafe(F.lit(marker)))


def upcoming_payload(home_name: Column, away_name: Column, home_id: Column, away_id: Column) -> Column:
    """The document stored for a match that has not been played: scores 0, no events."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    nothing = F.array().cast("array<string>")
    return F.struct(
        F.lit("correcto").alias("resultado"),
        F.struct(
            F.lit("ESTADÍSTICAS").alias("tipo_acta"),
            F.lit(NOT_STARTED).alias("estado_partido"),
            text(home_name).alias("local"),
            text(away_name).alias("visitante"),
            text(home_id).alias("idlocal"),
            text(away_id).alias("idvisitante"),
            F.lit(0).alias("tanteo_local"),
            F.lit(0).alias("tanteo_visitante"),
            F.lit(4).alias("numperiodos"),
            F.lit(2400).alias("tiempo_total_partido"),
        ).alias("partido"),
        F.struct(
            nothing.alias("jugadoresenpistalocal"),
            nothing.alias("jugadoresenpistavisitante"),
            nothing.alias("historialacciones"),
        ).alias("envivo"),
        F.lit("").alias("error"),
    )


def explode_items(rows: DataFrame, items: Column, *keep: str) -> DataFrame:
    """One row per element of an array of structs, with its ``position``; nulls give none."""
    return rows.select(*keep, F.posexplode(items).alias("position", "item")).select(*keep, "position", "item.*")


def both(first: Column, second: Column) -> Column:
    """Two arrays as one, either may be null."""
    return F.when(first.isNull(), second).when(second.isNull(), first).otherwise(F.concat(first, second))


def renamed(rows: DataFrame, names: dict[str, str], *keep: str) -> DataFrame:
    """Project to ``keep`` and the renamed columns."""
    return rows.select(*keep, *[F.col(raw).alias(name) for raw, name in names.items()])


def with_defaults(rows: DataFrame, defaults: dict[str, int] = DEFAULTS) -> DataFrame:
    """Fill missing values row by row."""
    return rows.fillna(defaults)


def whole_number(value: Column) -> Column:
    """A bigint from a number or from text such as ``12`` or ``12.0``; null when malformed."""
    return value.cast("string").try_cast("decimal(38,6)").try_cast("bigint")


def payload_per_type(files: DataFrame, keys: list[str], type_column: str, value: str, types: list[str]) -> DataFrame:
    """One row per key and a column per payload type.

    ``max`` stands for "the payload of that type": there is one file per key and type.
    """
    return files.groupBy(*keys).pivot(type_column, types).agg(F.max(value))
