"""What-if tables for the dashboard sliders: every wellness threshold, and named scenarios.

No join with the employee table: employees are reduced to a histogram of activity counts per
BU (partial aggregation). The thresholds of interest join it as rows without employees, and a
running sum per BU from the highest count down gives "count >= t" at each of them. The rows
after the histogram are as many as its own and the thresholds together, per BU.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..params import Params


def _suffix_sums(elig: DataFrame, count: Column, thresholds: Column) -> DataFrame:
    """bu, t, nb_salaries, at_least (employees with count >= t), nb_eligibles_prime, masse: one row per BU and threshold.

    ``thresholds``: an array column of the thresholds. A histogram row and a threshold of the
    same value meet in one row, so the running sum from the top includes it.
    """
    hist = elig.groupBy("bu", count.alias("t")).agg(
        F.count(F.lit(1)).alias("k"),
        F.count_if(F.coalesce(F.col("eligible_prime"), F.lit(False))).alias("k_prime"),
        F.sum(F.when(F.col("eligible_prime"), F.col("salaire_brut"))).alias("masse"))
    # one row per BU with its histogram: as long as there are different counts
    per_bu = hist.groupBy("bu").agg(
        F.collect_list(F.struct("t", "k", F.lit(False).alias("asked"))).alias("h"), F.sum("k").alias("nb_salaries"),
        F.sum("k_prime").alias("nb_eligibles_prime"), F.sum("masse").alias("masse"))
    asked = F.transform(thresholds, lambda t: F.struct(t.alias("t"), F.lit(0).cast("bigint").alias("k"), F.lit(True).alias("asked")))
    rows = per_bu.select("bu", "nb_salaries", "nb_eligibles_prime", "masse", F.explode(F.concat("h", asked)).alias("x"))
    of_bu = ["nb_salaries", "nb_eligibles_prime", "masse"]
    at = rows.groupBy("bu", F.col("x.t").alias("t")).agg(
        F.sum("x.k").alias("k"), F.max("x.asked").alias("asked"), *[F.max(c).alias(c) for c in of_bu])
    down = Window.partitionBy("bu").orderBy(F.col("t").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return at.withColumn("at_least", F.sum("k").over(down)).where("asked").drop("k", "asked")


def threshold_grid(elig: DataFrame, max_t: int = 30, days: int | None = None,
                   params: Params | None = None) -> DataFrame:
    """Per (bu, seuil in 0..max_t): staff, wellness-eligible staff (count >= seuil), days granted,
    bonus-eligible staff and their salary mass (cost = rate x mass, linear in the rate).

    Counts above ``max_t`` are one histogram row, so a BU has at most 2 x (max_t + 1) rows in flight.
    """
    days = days if days is not None else (params.jours_bien_etre_accordes if params else 5)
    capped = F.least(F.greatest(F.col("nb_activites_12mois"), F.lit(0)), F.lit(max_t)).cast("int")
    grid = _suffix_sums(elig, capped, F.sequence(F.lit(0), F.lit(max_t)))
    return grid.select(
        "bu", F.col("t").alias("seuil"), "nb_salaries", F.col("at_least").alias("nb_eligibles_bien_etre"), "nb_eligibles_prime",
        F.col("masse").alias("masse_salariale_prime"), (F.col("at_least") * F.lit(int(days))).alias("total_jours_bien_etre"))


def scenarios_table(spark: SparkSession, scenarios: list[tuple[str, float, int, int]]) -> DataFrame:
    """(scenario, taux_prime, seuil, jours) rows given by the user."""
    return spark.createDataFrame(scenarios, "scenario string, taux_prime double, seuil int, jours int")


def scenario_kpis(elig: DataFrame, scenarios: DataFrame, money_scale: int | None = 4) -> DataFrame:
    """KPIs per (scenario, bu) without recomputing eligibility, at exactly the thresholds listed.

    An employee is wellness-eligible at a threshold if their count is at least as large; a NULL
    threshold is an error. The distinct thresholds are a parameter and come to the driver as such; every
    BU has a row for each of them, and the scenarios (of any number) are joined to these by threshold.
    """
    listed = [r["seuil"] for r in scenarios.select("seuil").distinct().collect()]
    if None in listed:
        raise ValueError("a scenario has no threshold (seuil)")
    # as one text literal: an array of literals would be one expression per threshold
    thresholds = F.split(F.lit(",".join(str(t) for t in sorted(listed))), ",").cast("array<int>")
    if not listed:
        thresholds = F.array().cast("array<int>")
    grid = _suffix_sums(elig, F.col("nb_activites_12mois").cast("int"), thresholds)
    j = grid.join(scenarios.select("scenario", "taux_prime", "jours", "seuil"), F.col("t") == F.col("seuil"))
    cost = F.coalesce(F.col("masse") * F.col("taux_prime"), F.lit(0.0))
    if money_scale is not None:
        cost = F.round(cost, money_scale)
    return j.select(
        "scenario", "bu", "nb_salaries", "nb_eligibles_prime",
        cost.alias("cout_total_prime"),
        F.col("at_least").alias("nb_eligibles_bien_etre"),
        (F.col("at_least") * F.col("jours")).cast("long").alias("total_jours_bien_etre"),
    )
