"""Declared schemas and the small fixed-value tables of the business rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Measured commute distances (replaces one HTTP look-up per employee).
DISTANCE_SCHEMA = T.StructType([
    T.StructField("id_salarie", T.IntegerType()),
    T.StructField("profile", T.StringType()),
    T.StructField("metres", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("measured_at", T.TimestampNTZType()),
])

PARAMS_SCHEMA = T.StructType([
    T.StructField("taux_prime", T.DoubleType()),
    T.StructField("seuil_activites_bien_etre", T.IntegerType()),
    T.StructField("jours_bien_etre_accordes", T.IntegerType()),
])

# Source tables the fixtures are derived from (declared, so no footer inference per read).
SOURCE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
}

# --- Fixed values (must equal the agreed wire format, sheet headers and business rules) ----
# CDC wire format: the ``after`` image of one ``activities`` row as it arrives on the change
# stream (times are microseconds since the epoch), the kind of change, its time and its place in
# the source's log.
ACTIVITY_COLUMNS = ["id", "id_salarie", "date_debut", "sport_type", "distance_m", "date_fin", "commentaire"]

IMAGE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("id_salarie", T.IntegerType()),
    T.StructField("date_debut", T.LongType()),
    T.StructField("sport_type", T.StringType()),
    T.StructField("distance_m", T.IntegerType()),
    T.StructField("date_fin", T.LongType()),
    T.StructField("commentaire", T.StringType()),
])

# As read: the distance keeps its JSON type, so that a text or a fraction can be told from a missing one.
AFTER_SCHEMA = T.StructType([T.StructField(f.name, T.VariantType() if f.name == "distance_m" else f.dataType)
                             for f in IMAGE_SCHEMA.fields])

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("payload", T.StructType([
        T.StructField("after", AFTER_SCHEMA),
        T.StructField("source", T.StructType([T.StructField("ts_ms", T.LongType()), T.StructField("lsn", T.LongType())])),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ])),
])

# HR sheet as delivered (header names of the source sheet) and the
# snake_case names used everywhere after ``standardise_hr``.
HR_SHEET_SCHEMA = T.StructType([
    T.StructField("ID salarié", T.IntegerType()),
    T.StructField("Prénom", T.StringType()),
    T.StructField("Nom", T.StringType()),
    T.StructField("BU", T.StringType()),
    T.StructField("Salaire brut", T.DoubleType()),
    T.StructField("Moyen de déplacement", T.StringType()),
    T.StructField("Adresse du domicile", T.StringType()),
])
SPORT_SHEET_SCHEMA = T.StructType([
    T.StructField("ID salarié", T.IntegerType()),
    T.StructField("Pratique d'un sport", T.StringType()),
])
HR_RENAMES = {
    "ID salarié": "id_salarie",
    "Prénom": "prenom",
    "Nom": "nom",
    "BU": "bu",
    "Salaire brut": "salaire_brut",
    "Moyen de déplacement": "moyen_declare",
    "Adresse du domicile": "adresse",
    "Pratique d'un sport": "pratique",
}

# Distance caps in metres per sport label; any other label uses the default.
DISTANCE_CAPS_M = {
    "Course": 42000,
    "Running": 42000,
    "Course à pied": 42000,
    "Marche": 25000,
    "Walking": 25000,
    "Vélo": 150000,
    "Cyclisme": 150000,
    "Bike": 150000,
}
DEFAULT_CAP_M = 10000

# Declared commute modes that count as active, with their km threshold and
# the travel profile used to measure the distance.
ACTIVE_MODES = {
    "Marche/running": (15, "walking"),
    "Vélo/Trottinette/Autres": (25, "bicycling"),
}

# Sports the quality check accepts.
KNOWN_SPORTS = [
    "Course à pied", "Randonnée", "Vélo", "Natation", "Triathlon",
    "Tennis", "Football", "Rugby", "Badminton", "Voile",
    "Judo", "Boxe", "Escalade", "Équitation", "Tennis de table", "Basketball",
]

# Business parameters shipped with the reference configuration.
DEFAULT_PARAMS = {"taux_prime": 0.05, "seuil_activites_bien_etre": 15, "jours_bien_etre_accordes": 5}
# --- end of fixed values ------------------------------------------------------


def caps_table(spark: SparkSession, caps: dict[str, int] | None = None) -> DataFrame:
    """sport_type -> cap_m as a small DataFrame (bounded by the rule list)."""
    caps = DISTANCE_CAPS_M if caps is None else caps
    return spark.createDataFrame(sorted(caps.items()), "sport_type string, cap_m int")


def modes_table(spark: SparkSession, modes: dict[str, tuple[int, str]] | None = None) -> DataFrame:
    """moyen_declare -> (seuil_km, profile) as a small DataFrame."""
    modes = ACTIVE_MODES if modes is None else modes
    rows = [(m, int(t), p) for m, (t, p) in sorted(modes.items())]
    return spark.createDataFrame(rows, "moyen_declare string, seuil_km int, profile string")
