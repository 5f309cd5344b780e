"""Gold tables: per-employee eligibility and per-business-unit KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.time import clock, window_start
from ..params import Params
from .referential import standardise_hr
from .routing import time_type

NOMINATIVE = ["id_salarie", "salaire_brut", "nom", "prenom", "adresse", "moyen_declare", "distance_km", "montant_prime"]


def lookback(df: DataFrame, params: Params) -> DataFrame:
    """Activities that started on or after midnight of ``as_of - lookback_days``.

    On a table partitioned by day (``jour``) the same bound on the partition
    column prunes whole days before any file is opened.
    """
    start = window_start(params.as_of, params.lookback_days, time_type(df))
    out = df.filter(F.col("date_debut") >= start)
    if "jour" in df.columns:
        out = out.filter(F.col("jour") >= window_start(params.as_of, params.lookback_days, "date"))
    return out


def count_activities(bronze: DataFrame, params: Params) -> DataFrame:
    """Per-employee number of activities inside the look-back window.

    Only two columns are read and the date filter reaches the scan (and the
    day partitions when present); the partial aggregate absorbs a very active
    employee before the shuffle.
    """
    return (lookback(bronze, params).select("id_salarie")
            .groupBy("id_salarie").agg(F.count(F.lit(1)).alias("nb_activites_12mois")))


def day_counts(bronze: DataFrame, day: str = "jour") -> DataFrame:
    """Activities per employee and day of their start: what any look-back over whole days is a sum of."""
    return bronze.groupBy("id_salarie", day).agg(F.count(F.lit(1)).alias("nb"))


def count_from_days(counts: DataFrame, params: Params) -> DataFrame:
    """``count_activities`` from day counts: a sum over the look-back's days (the bound reaches the scan).

    The look-back starts at midnight, so whole days are exact.
    """
    start = window_start(params.as_of, params.lookback_days, "date")
    return (counts.where(F.col("jour") >= start).groupBy("id_salarie")
            .agg(F.sum("nb").cast("bigint").alias("nb_activites_12mois")))


def join_counts(hr_std: DataFrame, counts: DataFrame) -> DataFrame:
    """HR left join the counts; employees without activity get 0."""
    return hr_std.join(counts, "id_salarie", "left").fillna(0, subset=["nb_activites_12mois"])


def eligibility(bronze: DataFrame | None, referential: DataFrame, params: Params, counts: DataFrame | None = None) -> DataFrame:
    """One row per employee with both benefits decided (internal: carries the salary).

    ``counts`` are the activities per employee in the look-back, if they are known already
    (``count_from_days``); else they are counted from ``bronze``.
    """
    p = params
    joined = join_counts(standardise_hr(referential), count_activities(bronze, p) if counts is None else counts)
    # flags are built as expressions over the joined columns and added in one projection
    mode = rules.active_mode()
    bonus = rules.bonus_eligible(mode)
    well = rules.wellness(p.seuil_activites_bien_etre)
    return joined.select(
        "*",
        mode.alias("mode_actif_declare"),
        rules.distance_pending(mode).alias("distance_a_valider"),
        bonus.alias("eligible_prime"),
        rules.bonus_amount(p.taux_prime, bonus).alias("montant_prime"),
        well.alias("eligible_bien_etre"),
        rules.wellness_days(p.jours_bien_etre_accordes, well).alias("jours_bien_etre"),
        clock(p.as_of, "timestamp_ntz").alias("calcule_le"),
    )


def stamp(df: DataFrame, params: Params, col: str = "calcule_le") -> DataFrame:
    """Add the computation time (the injected ``as_of`` when set)."""
    return df.withColumn(col, clock(params.as_of, "timestamp_ntz"))


def kpis(elig: DataFrame, params: Params, money_scale: int | None = 4) -> DataFrame:
    """Per BU: staff, bonus-eligible count and cost, wellness-eligible count and days, pending checks.

    NULL BU is its own group. Flags are summed as 0/1 (NULL skipped, all-NULL
    gives NULL). ``money_scale`` rounds the summed cost so that the result does
    not depend on the summation order (cents x a rate in % are exact at 4 decimals).
    """
    cost = F.sum("montant_prime")
    if money_scale is not None:
        cost = F.round(cost, money_scale)
    out = elig.groupBy("bu").agg(
        F.count(F.lit(1)).alias("nb_salaries"),
        F.sum(F.col("eligible_prime").cast("int")).cast("long").alias("nb_eligibles_prime"),
        cost.alias("cout_total_prime"),
        F.sum(F.col("eligible_bien_etre").cast("int")).cast("long").alias("nb_eligibles_bien_etre"),
        F.sum("jours_bien_etre").cast("long").alias("total_jours_bien_etre"),
        F.sum(F.col("distance_a_valider").cast("int")).cast("long").alias("nb_en_attente_validation_distance"),
    )
    return stamp(out, params)


def kpis_total(elig: DataFrame, money_scale: int | None = 4) -> DataFrame:
    """Company-wide figures: staff, bonus budget, wellness days and employees, anomalies."""
    cost = F.sum("montant_prime")
    if money_scale is not None:
        cost = F.round(cost, money_scale)
    return elig.agg(
        F.count(F.lit(1)).alias("nb_salaries"),
        cost.alias("budget_prime"),
        F.coalesce(F.sum("jours_bien_etre"), F.lit(0)).cast("long").alias("total_jours_bien_etre"),
        F.count_if(F.coalesce(F.col("eligible_bien_etre"), F.lit(False))).alias("nb_eligibles_bien_etre"),
        F.count_if(F.coalesce(F.col("eligible_prime"), F.lit(False))).alias("nb_eligibles_prime"),
        F.count_if(F.coalesce(F.col("distance_anormale"), F.lit(False))).alias("nb_anomalies_distance"),
    )


def shareable(df: DataFrame) -> DataFrame:
    """Drop every column that names or singles out an employee (id, salary, names, address, commute,
    individual amount); what leaves the company are the KPI tables."""
    return df.drop(*[c for c in NOMINATIVE if c in df.columns])
