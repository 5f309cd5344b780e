"""Quality checks: each check fails on a planted fault, pandas NULL semantics, the report."""

from __future__ import annotations

import datetime as dt

from vitalflow.operators import quality
from vitalflow.params import Params

P = Params(as_of=dt.datetime(2024, 1, 31))
B_SCHEMA = ("id long, id_salarie int, date_debut timestamp_ntz, sport_type string, distance_m int, "
            "date_fin timestamp_ntz, commentaire string")
OK_ROW = (1, 1, dt.datetime(2024, 1, 10), "Tennis", None, dt.datetime(2024, 1, 10, 1), None)


def bronze_counts(spark, rows):
    df = spark.createDataFrame(rows, B_SCHEMA)
    return {r["check"]: r["violations"] for r in quality.check_bronze(df, P).collect()}


def test_bronze_checks_each_fail_on_their_fault(spark):
    faults = [
        (2, 1, dt.datetime(2024, 1, 10), "Tennis", -3, None, None),           # negative distance
        (3, 1, None, "Tennis", None, None, None),                              # missing start
        (4, 1, dt.datetime(2030, 1, 1), "Tennis", None, None, None),           # future start
        (5, 1, dt.datetime(2024, 1, 10), "Tennis", None, dt.datetime(2024, 1, 9), None),  # end before start
        (6, 1, dt.datetime(2024, 1, 10), "Curling", None, None, None),         # unknown sport
        (7, 1, dt.datetime(2024, 1, 10), None, None, None, None),              # NULL sport = unknown
    ]
    got = bronze_counts(spark, [OK_ROW] + faults)
    assert got == {"distance_non_negative": 1, "date_debut_renseignee": 1, "date_debut_pas_future": 1,
                   "date_fin_apres_debut": 1, "sport_type_connu": 2}
    assert set(bronze_counts(spark, [OK_ROW]).values()) == {0}


def test_referential_and_gold_checks(spark):
    ref = spark.createDataFrame(
        [(1, 100.0, 3.0), (1, 0.0, None), (2, None, -1.0), (None, 10.0, 0.0), (None, 5.0, 2.0)],
        "id_salarie int, salaire_brut double, distance_km double")
    got = {r["check"]: (r["statut"], r["violations"]) for r in quality.check_referential(ref, P).collect()}
    assert got == {"id_salarie_unique": ("ÉCHEC", 2), "salaire_positif": ("ÉCHEC", 2),
                   "distance_coherente": ("ÉCHEC", 2)}
    gold = spark.createDataFrame([(1, 10.0, 0), (2, -1.0, 5), (3, None, 3), (4, 0.0, None)],
                                 "id_salarie int, montant_prime double, jours_bien_etre int")
    got = {r["check"]: r["violations"] for r in quality.check_gold(gold, P).collect()}
    assert got == {"montant_prime_positif_ou_nul": 1, "jours_bien_etre_valides": 2}


def test_orphans_null_safe(spark):
    bronze = spark.createDataFrame([(1, 1), (2, 9), (3, None), (4, 1)], "id long, id_salarie int")
    hr = spark.createDataFrame([(1,), (2,)], "id_salarie int")
    assert quality.check_integrity(bronze, hr, P).first()["violations"] == 2
    hr_null = spark.createDataFrame([(1,), (None,)], "id_salarie int")
    assert quality.check_integrity(bronze, hr_null, P).first()["violations"] == 1
    assert sorted(r["id"] for r in quality.orphans(bronze, hr).collect()) == [2, 3]
    assert sorted(r["id"] for r in quality.known(bronze, hr).collect()) == [1, 4]


def test_report_and_summary(spark):
    from vitalflow.plans.medallion import Flow
    f = Flow(spark, "/root/testdata/sf0.001")
    checks = quality.run_checks(f.bronze, f.referential, f.eligibility, f.params)
    rows = {r["check"]: r["violations"] for r in checks.collect()}
    assert len(rows) == 11
    # FIXTURES.md figures on the pipeline tables at sf0.001
    assert [rows[k] for k in ["distance_non_negative", "date_debut_renseignee", "date_debut_pas_future",
                              "date_fin_apres_debut", "sport_type_connu"]] == [0, 0, 0, 9, 182]
    assert rows["salaire_positif"] == 11 and rows["distance_coherente"] == 0
    assert rows["id_salarie_existe_dans_rh"] == 7 and rows["montant_prime_positif_ou_nul"] == 1
    s = quality.summary(checks).first()
    assert (s["nb_ok"], s["nb_checks"]) == (6, 11)
    lines = [r["line"] for r in quality.report_lines(checks, f.params).orderBy("ordre").collect()]
    assert lines[0] == "# Rapport de qualité des données"
    assert lines[1] == "Généré le 31/01/2024 à 00:00"
    assert lines[3] == "| Check | Description | Statut | Violations |"
    assert lines[5] == "| distance_non_negative | La distance parcourue ne doit jamais être négative | OK | 0 |"
    assert lines[-1].startswith("| jours_bien_etre_valides | Les jours bien-être accordés doivent être 0 ou 5")
    assert len(lines) == 16
