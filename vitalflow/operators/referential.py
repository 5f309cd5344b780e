"""HR referential: declared sport, commute-mode rules, measured distance, three-state anomaly.

The reference calls a routing web service once per employee; here the
measured distances are a table and the enrichment is two joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import three_state_anomaly
from ..schemas import DISTANCE_SCHEMA, modes_table
from ..sources.tables import ROW_ORDER

HR_STD_COLUMNS = ["id_salarie", "bu", "salaire_brut", "moyen_declare", "distance_km", "distance_anormale"]


def standardise_hr(ref: DataFrame) -> DataFrame:
    """The six columns the gold job uses; names, address and sport are pruned."""
    return ref.select(*HR_STD_COLUMNS)


def join_sport(hr: DataFrame, sport: DataFrame | None) -> DataFrame:
    """HR left join the declared-sport sheet: a row for each row that the sheet has for an employee."""
    if sport is None:
        return hr.withColumn("pratique", F.lit(None).cast("string"))
    return hr.join(sport.select("id_salarie", "pratique"), "id_salarie", "left")


def sports_of(sport: DataFrame) -> DataFrame:
    """One row per employee with all declared sports, in order, as one text (NULL if none is given)."""
    told = F.array_sort(F.collect_set("pratique"))
    return sport.groupBy("id_salarie").agg(F.when(F.size(told) > 0, F.array_join(told, ", ")).alias("pratique"))


def with_sports(hr: DataFrame, sport: DataFrame | None) -> DataFrame:
    """HR with all declared sports in one column: one row per employee, so no later count doubles.

    Because the right side is unique per key, Catalyst removes the join (and
    the sheet scan) from any plan that does not use ``pratique``, e.g. gold.
    """
    if sport is None:
        return hr.withColumn("pratique", F.lit(None).cast("string"))
    return hr.join(sports_of(sport), "id_salarie", "left")


def practice_flag(hr: DataFrame, sport: DataFrame | None, order: str | None = None) -> DataFrame:
    """``pratique_declaree``: the employee's last sheet row names a practice.

    ``order`` is the sheet's row order; by default the one that the reader gave it. A sheet without
    one has no last row: there any named practice counts. An employee who is not in the sheet declared
    nothing. Reduced to one row per id first (partial aggregation), so a repeated id
    never concentrates in one task.
    """
    if sport is None:
        return hr.withColumn("pratique_declaree", F.lit(False))
    order = order or (ROW_ORDER if ROW_ORDER in sport.columns else None)
    last = F.max(F.struct(F.col(order), F.col("pratique")))["pratique"] if order else F.max("pratique")
    one = sport.groupBy("id_salarie").agg(last.alias("_pratique"))
    return (hr.join(one, "id_salarie", "left")
            .withColumn("pratique_declaree", F.col("_pratique").isNotNull()).drop("_pratique"))


def with_mode_rules(hr: DataFrame, modes: DataFrame) -> DataFrame:
    """Commute mode -> (seuil_km, profile); unknown mode -> NULLs.

    ``modes`` is the rule list (one row per mode, a handful of rows), so it is
    broadcast: its size is bounded by the parameter, not by the data.
    """
    return hr.join(F.broadcast(modes.select("moyen_declare", "seuil_km", "profile")), "moyen_declare", "left")


def latest_distances(distances: DataFrame) -> DataFrame:
    """The latest measurement of each (employee, profile), so that the join keeps one row per employee.

    Ties on ``measured_at`` go to the greater (status, metres); an undated row comes first.
    """
    when = F.col("measured_at") if "measured_at" in distances.columns else F.lit(None)
    row = F.struct(F.coalesce(when.cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz")).alias("at"), "status", "metres")
    return (distances.groupBy("id_salarie", "profile").agg(F.max(row).alias("last"))
            .select("id_salarie", "profile", "last.metres", "last.status"))


def no_distances(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DISTANCE_SCHEMA)


def with_distance(hr: DataFrame, distances: DataFrame) -> DataFrame:
    """Employee -> measured commute in km (metres / 1000 when the look-up succeeded).

    Adds ``measured`` (a row exists) and ``lookup_failed`` (row with status <> OK).
    The distance table grows with the staff, so no broadcast is forced: the
    adaptive planner broadcasts it only when its measured size is under the threshold.
    """
    d = latest_distances(distances).withColumn("_row", F.lit(True))
    j = hr.join(d, ["id_salarie", "profile"], "left")
    measured = F.coalesce(F.col("_row"), F.lit(False))
    keep = [c for c in j.columns if c not in ("_row", "metres", "status")]
    return j.select(*keep,
                    measured.alias("measured"),
                    (measured & (F.coalesce(F.col("status"), F.lit("")) != "OK")).alias("lookup_failed"),
                    F.when(F.col("status") == "OK", F.col("metres") / F.lit(1000.0)).alias("distance_km"))


def build_referential(spark: SparkSession, hr: DataFrame, distances: DataFrame | None,
                      sport: DataFrame | None = None, modes: DataFrame | None = None,
                      failed_policy: str = "pending") -> DataFrame:
    """HR (+ sport) + ``distance_km`` (double) + ``distance_anormale`` (nullable boolean).

    Without measured distances every active mode is pending.
    """
    distances = no_distances(spark) if distances is None else distances
    modes = modes if modes is not None else modes_table(spark)
    base = with_sports(hr, sport) if sport is not None else hr
    if sport is not None:
        base = practice_flag(base, sport)
    enriched = with_distance(with_mode_rules(base, modes), distances)
    keep = [c for c in base.columns if c not in ("distance_km", "distance_anormale")]
    return enriched.select(*keep, "distance_km",
                           three_state_anomaly(failed_policy=failed_policy).alias("distance_anormale"))


def anomaly_count(ref: DataFrame) -> DataFrame:
    """Number of anomalous declarations (NULL counts as not anomalous) and staff size."""
    return ref.agg(F.count_if(F.coalesce(F.col("distance_anormale"), F.lit(False))).alias("nb_anomalies"),
                   F.count(F.lit(1)).alias("nb_salaries"))
