"""Per-event notification text: a praise message, or a quarantine alert with its reasons.

Stateless column expressions after a stream-static join with the employee
directory, so the same function serves a batch table and a live stream.
The random template pick of the original becomes a deterministic pick by
activity id (reproducible, and identical in any engine).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import is_blank
from ..functions.rules import cap_for
from ..functions.text import fill_template, full_name, km_text, pick_filled, whole_km_text, with_comment
from ..functions.time import clock, duration_min
from ..schemas import DEFAULT_CAP_M
from .routing import time_type

# --- Fixed values: message texts ----------------------------------------------
PRAISE_WITH_DISTANCE = [
    "Bravo {nom} ! Tu viens de faire {sport} : {distance} km en {duree} min ! Quelle énergie ! 🔥🏅",
    "Magnifique {nom} ! {distance} km de {sport} dans les pattes aujourd'hui ! 🌄",
    "Superbe séance {nom} ! {distance} km en {duree} min, tu progresses ! 💪",
]
PRAISE_WITHOUT_DISTANCE = [
    "Bravo {nom} ! Une séance de {sport} de {duree} min bien méritée ! 💪",
    "GG {nom} ! {sport} au programme aujourd'hui, {duree} min bien remplies ! 🔥",
]
UNKNOWN_EMPLOYEE = "Salarié #"
UNKNOWN_DURATION = "?"
REASON_NO_ID = "identifiant salarié absent"
REASON_NO_SPORT = "discipline non renseignée"
REASON_NEGATIVE = "distance négative ({d} m)"
REASON_ABOVE_CAP = "distance irréaliste pour {sport} ({km} km déclarés, max : {cap} km)"
REASON_FUTURE = "horodatage situé dans le futur"
ALERT_LINES = [
    "🚨 *[ALERTE MONITORING - QUARANTAINE]*",
    "Une activité anormale a été bloquée à l'ingestion.",
    "• *Collaborateur* : {nom}",
    "• *Anomalie(s)* : {anomalies}",
    "• *Statut* : Déroutée vers la table Quarantaine (exclue des calculs RH).",
]
KIND_MESSAGE, KIND_ALERT = "message", "alerte"
# --- end of fixed values ------------------------------------------------------


def directory(hr: DataFrame) -> DataFrame:
    """id_salarie -> "First Last", one row per id (partial aggregation absorbs repeats)."""
    return hr.groupBy("id_salarie").agg(F.max(full_name("prenom", "nom")).alias("nom_complet"))


def with_name(events: DataFrame, dir_df: DataFrame | None) -> DataFrame:
    """Add ``nom_affiche``; unknown id (or no directory at all) -> ``Salarié #<id>``.

    The directory grows with the staff, so no broadcast is forced: the adaptive planner
    broadcasts it only under the size threshold. Pass a directory with unique ids that is read
    from a table (``sources.tables.stored``): both join inputs are then plain exchanges, whose
    skewed partitions are split. An aggregate right under the join would prevent that.
    """
    fallback = F.concat(F.lit(UNKNOWN_EMPLOYEE), F.coalesce(F.col("id_salarie").cast("string"), F.lit("None")))
    if dir_df is None:
        return events.withColumn("nom_affiche", fallback)
    d = dir_df.select(F.col("id_salarie").alias("_dir_id"), "nom_complet")
    j = events.join(d, events["id_salarie"] == d["_dir_id"], "left")
    keep = [c for c in events.columns]
    return j.select(*keep, F.coalesce(F.col("nom_complet"), fallback).alias("nom_affiche"))


def alert_reasons(as_of: dt.datetime | None = None, tolerance_s: int = 300,
                  caps: dict[str, int] | None = None, default: int = DEFAULT_CAP_M,
                  tt: str = "timestamp_ntz") -> Column:
    """array<string> of anomaly texts (truthiness semantics: 0 and '' count as absent)."""
    d, sport, start = F.col("distance_m"), F.col("sport_type"), F.col("date_debut")
    cap = cap_for(sport, caps, default)
    above = fill_template(REASON_ABOVE_CAP, {
        "sport": F.coalesce(sport, F.lit("None")), "km": km_text(d), "cap": whole_km_text(cap)})
    limit = F.timestamp_add("SECOND", F.lit(int(tolerance_s)), clock(as_of, tt))
    return F.array_compact(F.array(
        F.when(is_blank("id_salarie", "number"), F.lit(REASON_NO_ID)),
        F.when(is_blank("sport_type"), F.lit(REASON_NO_SPORT)),
        F.when(d < 0, fill_template(REASON_NEGATIVE, {"d": d.cast("string")})),
        F.when((d >= 0) & (d > cap), above),
        F.when(start.isNotNull() & (start > limit), F.lit(REASON_FUTURE)),
    ))


def praise_text() -> Column:
    """Praise message for an activity without anomaly (expects ``nom_affiche``)."""
    duree = F.coalesce(duration_min("date_debut", "date_fin").cast("string"), F.lit(UNKNOWN_DURATION))
    values = {"nom": F.col("nom_affiche"), "sport": F.col("sport_type"), "distance": km_text("distance_m"), "duree": duree}
    text = (F.when(~is_blank("distance_m", "number"), pick_filled(PRAISE_WITH_DISTANCE, "id", values))
            .otherwise(pick_filled(PRAISE_WITHOUT_DISTANCE, "id", values)))
    return with_comment(text, F.col("commentaire"))


def alert_text(reasons_col: Column) -> Column:
    """Multi-line alert with name, reasons and status (expects ``nom_affiche``)."""
    return fill_template("\n".join(ALERT_LINES), {"nom": F.col("nom_affiche"), "anomalies": F.array_join(reasons_col, ", ")})


def with_anomalies(events: DataFrame, as_of: dt.datetime | None = None, tolerance_s: int = 300,
                   caps: dict[str, int] | None = None) -> DataFrame:
    """Add ``anomalies`` (array<string>) to each change event."""
    return events.withColumn("anomalies", alert_reasons(as_of, tolerance_s, caps, tt=time_type(events)))


def messages(events: DataFrame, dir_df: DataFrame | None, as_of: dt.datetime | None = None,
             tolerance_s: int = 300, caps: dict[str, int] | None = None) -> DataFrame:
    """One output per event: (id, id_salarie, type_message, texte)."""
    e = with_name(with_anomalies(events, as_of, tolerance_s, caps), dir_df)
    is_alert = F.size("anomalies") > 0
    return e.select(
        "id", "id_salarie",
        F.when(is_alert, F.lit(KIND_ALERT)).otherwise(F.lit(KIND_MESSAGE)).alias("type_message"),
        F.when(is_alert, alert_text(F.col("anomalies"))).otherwise(praise_text()).alias("texte"),
    )
