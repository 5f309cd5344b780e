"""The 11 data-quality checks as Spark queries.

Checks on the same table share one scan: each is a ``count_if`` in a single
aggregation, then the row of counts is unpivoted into one row per check.
NULL handling follows the pandas semantics of the original checks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import default, in_list
from ..functions.time import clock
from ..params import Params
from ..schemas import KNOWN_SPORTS
from .dedup import duplicate_count
from .routing import time_type

# --- Fixed values: check names and report texts ------------------------------
CHECKS = [
    ("distance_non_negative", "La distance parcourue ne doit jamais être négative"),
    ("date_debut_renseignee", "La date de début d'activité doit toujours être renseignée"),
    ("date_debut_pas_future", "La date de début ne doit pas être dans le futur"),
    ("date_fin_apres_debut", "La date de fin doit être postérieure (ou égale) à la date de début"),
    ("sport_type_connu", "Le type de sport doit faire partie de la liste des sports gérés"),
    ("id_salarie_unique", "Chaque ID salarié doit apparaître une seule fois dans le référentiel"),
    ("salaire_positif", "Le salaire brut doit être strictement positif"),
    ("distance_coherente", "Si une distance a été calculée, elle doit être positive"),
    ("id_salarie_existe_dans_rh", "Chaque activité doit référencer un salarié existant dans le référentiel RH"),
    ("montant_prime_positif_ou_nul", "Le montant de prime calculé ne doit jamais être négatif"),
    ("jours_bien_etre_valides", "Les jours bien-être accordés doivent être 0 ou {jours} (valeur paramétrée)"),
]
STATUS_OK, STATUS_FAILED = "OK", "ÉCHEC"
REPORT_TITLE = "# Rapport de qualité des données"
REPORT_GENERATED = "Généré le "
REPORT_HEADER = ["| Check | Description | Statut | Violations |", "|---|---|---|---|"]
# --- end of fixed values ------------------------------------------------------

CHECK_ORDER = {name: i + 1 for i, (name, _) in enumerate(CHECKS)}


def descriptions(params: Params) -> dict[str, str]:
    return {n: d.format(jours=params.jours_bien_etre_accordes) for n, d in CHECKS}


# --- violation predicates (TRUE = row violates) -------------------------------

def bronze_predicates(params: Params, tt: str = "timestamp_ntz") -> dict[str, Column]:
    start, end = F.col("date_debut"), F.col("date_fin")
    return {
        "distance_non_negative": default("distance_m", 0) < 0,
        "date_debut_renseignee": start.isNull(),
        "date_debut_pas_future": F.coalesce(start > clock(params.as_of, tt), F.lit(False)),
        "date_fin_apres_debut": F.coalesce(end.isNotNull() & (end < start), F.lit(False)),
        "sport_type_connu": ~in_list("sport_type", KNOWN_SPORTS),
    }


def referential_predicates() -> dict[str, Column]:
    km = F.col("distance_km")
    return {
        "salaire_positif": default("salaire_brut", 0) <= 0,
        "distance_coherente": F.coalesce(km.isNotNull() & (km <= 0), F.lit(False)),
    }


def gold_predicates(params: Params) -> dict[str, Column]:
    return {
        "montant_prime_positif_ou_nul": default("montant_prime", 0) < 0,
        "jours_bien_etre_valides": ~in_list("jours_bien_etre", [0, params.jours_bien_etre_accordes]),
    }


# --- runners ------------------------------------------------------------------

def count_violations(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """One pass over ``df``: (check, violations) per predicate."""
    names = list(predicates)
    return _unpivot(df.agg(*[F.count_if(p).alias(n) for n, p in predicates.items()]), names)


# NULL ids must match each other (pandas ``isin`` matches NaN with NaN). A NULL-safe
# join (``<=>``) would be planned on (coalesce(id, 0), isnull(id)) and re-shuffle
# both sides; keying both sides by one column that maps NULL to a value outside
# the int range keeps the per-employee partitioning for the join.
NULL_ID_KEY = -(2 ** 63)


def id_key(col: str = "id_salarie"):
    """Null-safe join key for an int employee id."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID_KEY)).alias("_k")


def _hr_ids(hr: DataFrame) -> DataFrame:
    return hr.select(id_key()).distinct()


def orphan_count(bronze: DataFrame, hr: DataFrame) -> DataFrame:
    """Activities whose employee is not in HR (NULL id included), one row.

    Activities are first reduced to one row per employee (partial aggregate),
    so the anti join shuffles distinct ids, not every activity.
    """
    per_emp = bronze.groupBy(id_key()).agg(F.count(F.lit(1)).alias("n"))
    orphans_ = per_emp.join(_hr_ids(hr), "_k", "left_anti")
    return orphans_.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations"))


def orphans(bronze: DataFrame, hr: DataFrame) -> DataFrame:
    """The orphan activity rows themselves (left anti join, NULL-safe).

    Both sides are plain exchanges (no ``distinct``, which an anti join does not need), so the
    partition of a very active employee is split.
    """
    return bronze.select("*", id_key()).join(hr.select(id_key()), "_k", "left_anti").drop("_k")


def known(bronze: DataFrame, hr: DataFrame) -> DataFrame:
    """Activities whose employee is in HR (left semi join, NULL-safe)."""
    return bronze.select("*", id_key()).join(hr.select(id_key()), "_k", "left_semi").drop("_k")


def finish(counts: DataFrame, params: Params) -> DataFrame:
    """(check, violations) -> (ordre, check, description, statut, violations)."""
    desc = descriptions(params)
    desc_map = F.create_map(*[x for n in CHECK_ORDER for x in (F.lit(n), F.lit(desc[n]))])
    order_map = F.create_map(*[x for n, i in CHECK_ORDER.items() for x in (F.lit(n), F.lit(i))])
    return counts.select(
        F.element_at(order_map, F.col("check")).alias("ordre"),
        F.col("check"),
        F.element_at(desc_map, F.col("check")).alias("description"),
        F.when(F.col("violations") > 0, F.lit(STATUS_FAILED)).otherwise(F.lit(STATUS_OK)).alias("statut"),
        F.col("violations"),
    )


def check_bronze(bronze: DataFrame, params: Params, only: list[str] | None = None) -> DataFrame:
    preds = bronze_predicates(params, time_type(bronze))
    if only:
        preds = {k: v for k, v in preds.items() if k in only}
    return finish(count_violations(bronze, preds), params)


def check_referential(ref: DataFrame, params: Params, only: list[str] | None = None) -> DataFrame:
    parts = []
    want = set(only or ["id_salarie_unique", "salaire_positif", "distance_coherente"])
    if "id_salarie_unique" in want:
        parts.append(duplicate_count(ref, "id_salarie").select(F.lit("id_salarie_unique").alias("check"), "violations"))
    preds = {k: v for k, v in referential_predicates().items() if k in want}
    if preds:
        parts.append(count_violations(ref, preds))
    return finish(reduce(DataFrame.unionByName, parts), params)


def check_integrity(bronze: DataFrame, hr: DataFrame, params: Params) -> DataFrame:
    counts = orphan_count(bronze, hr).select(F.lit("id_salarie_existe_dans_rh").alias("check"), "violations")
    return finish(counts, params)


def check_gold(elig: DataFrame, params: Params, only: list[str] | None = None) -> DataFrame:
    preds = gold_predicates(params)
    if only:
        preds = {k: v for k, v in preds.items() if k in only}
    return finish(count_violations(elig, preds), params)


def _unpivot(counts: DataFrame, names: list[str]) -> DataFrame:
    pairs = [x for n in names for x in (F.lit(n), F.col(n).cast("long"))]
    return counts.select(F.stack(F.lit(len(names)), *pairs).alias("check", "violations"))


def bronze_and_integrity(bronze: DataFrame, hr: DataFrame, params: Params) -> DataFrame:
    """The 5 bronze checks and the orphan check in ONE pass over the activities.

    Activities are reduced per employee (partial aggregation: a very active
    employee costs one row per map task) carrying the per-check counts; the
    anti-join then runs on distinct employees only.
    """
    preds = bronze_predicates(params, time_type(bronze))
    per_emp = bronze.groupBy(id_key()).agg(F.count(F.lit(1)).alias("_n"),
                                           *[F.count_if(p).alias(n) for n, p in preds.items()])
    j = per_emp.join(_hr_ids(hr).withColumn("_known", F.lit(True)), "_k", "left")
    counts = j.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in preds],
                   F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0))
                   .alias("id_salarie_existe_dans_rh"))
    return _unpivot(counts, [*preds, "id_salarie_existe_dans_rh"])


def referential_checks(ref: DataFrame) -> DataFrame:
    """Uniqueness, salary and distance checks in ONE pass (one row per id, then a global sum)."""
    preds = referential_predicates()
    per_id = ref.groupBy("id_salarie").agg(F.count(F.lit(1)).alias("_n"),
                                           *[F.count_if(p).alias(n) for n, p in preds.items()])
    counts = per_id.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("id_salarie_unique"),
                        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in preds])
    return _unpivot(counts, ["id_salarie_unique", *preds])


def run_checks(bronze: DataFrame, ref: DataFrame, elig: DataFrame, params: Params) -> DataFrame:
    """All 11 checks: 11 rows (ordre, check, description, statut, violations).

    Three passes: activities (bronze checks + orphans), referential, gold.
    """
    counts = reduce(DataFrame.unionByName, [
        bronze_and_integrity(bronze, ref, params),
        referential_checks(ref),
        count_violations(elig, gold_predicates(params)),
    ])
    return finish(counts, params)


def summary(checks: DataFrame) -> DataFrame:
    """Passed / total, one row."""
    return checks.agg(F.count_if(F.col("statut") == STATUS_OK).alias("nb_ok"),
                      F.count(F.lit(1)).alias("nb_checks"))


def report_lines(checks: DataFrame, params: Params) -> DataFrame:
    """Markdown report as (ordre, line); the header carries the generation time."""
    gen = F.concat(F.lit(REPORT_GENERATED),
                   F.date_format(clock(params.as_of, "timestamp_ntz"), "dd/MM/yyyy 'à' HH:mm"))
    head = checks.sparkSession.range(1).select(F.explode(F.array(
        F.struct(F.lit(1).alias("ordre"), F.lit(REPORT_TITLE).alias("line")),
        F.struct(F.lit(2).alias("ordre"), gen.alias("line")),
        F.struct(F.lit(3).alias("ordre"), F.lit("").alias("line")),
        F.struct(F.lit(4).alias("ordre"), F.lit(REPORT_HEADER[0]).alias("line")),
        F.struct(F.lit(5).alias("ordre"), F.lit(REPORT_HEADER[1]).alias("line")),
    )).alias("r")).select("r.*")
    rows = checks.select(
        (F.col("ordre") + 10).alias("ordre"),
        F.format_string("| %s | %s | %s | %d |", "check", "description", "statut", "violations").alias("line"))
    return head.unionByName(rows)


def write_report(lines: DataFrame, path: str) -> None:
    """Write the report as one text file (a handful of lines: one per check)."""
    lines.orderBy("ordre").coalesce(1).select("line").write.mode("overwrite").text(path)
