"""Gold rules, referential three-state anomaly, what-if fast path = naive cross join."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitalflow.operators import gold, referential, whatif
from vitalflow.params import Params
from vitalflow.plans.medallion import Flow
from vitalflow.schemas import modes_table

SF = "/root/testdata/sf0.001"


def test_three_state_anomaly(spark):
    hr = spark.createDataFrame(
        [(1, "Marche/running"), (2, "Marche/running"), (3, "Marche/running"), (4, "Vélo/Trottinette/Autres"),
         (5, "Transports en commun"), (6, None), (7, "Marche/running")],
        "id_salarie int, moyen_declare string")
    dist = spark.createDataFrame(
        [(1, "walking", 15000, "OK"), (2, "walking", 15001, "OK"), (3, "walking", 2000, "NOT_FOUND"),
         (4, "bicycling", 30000, "OK"), (5, "walking", 100, "OK")],
        "id_salarie int, profile string, metres int, status string")
    pending = {r["id_salarie"]: (r["distance_km"], r["distance_anormale"]) for r in
               referential.build_referential(spark, hr, dist).collect()}
    assert pending == {1: (15.0, False), 2: (15.001, True), 3: (None, None), 4: (30.0, True),
                       5: (None, False), 6: (None, False), 7: (None, None)}
    accept = {r["id_salarie"]: r["distance_anormale"] for r in
              referential.build_referential(spark, hr, dist, failed_policy="accept").collect()}
    assert accept[3] is False and accept[7] is None
    n = referential.anomaly_count(referential.build_referential(spark, hr, dist)).first()
    assert (n["nb_anomalies"], n["nb_salaries"]) == (2, 7)


def test_figures_sf0001(spark):
    f = Flow(spark, SF)
    ref = f.referential
    walk = {r[0]: r[1] for r in ref.filter(F.col("moyen_declare") == "Marche/running")
            .groupBy("distance_anormale").count().collect()}
    assert walk == {False: 10, True: 24, None: 5}
    bike = {r[0]: r[1] for r in ref.filter(F.col("moyen_declare") == "Vélo/Trottinette/Autres")
            .groupBy("distance_anormale").count().collect()}
    assert bike == {False: 19, True: 13, None: 5}
    assert f.fx.sport().filter("pratique = 'Tennis'").count() == 71


def test_eligibility_rules(spark):
    ref = spark.createDataFrame(
        [(1, "A", 1000.0, "Marche/running", 3.0, False), (2, "A", 2000.0, "Marche/running", None, None),
         (3, "B", None, "Vélo/Trottinette/Autres", 5.0, False), (4, "B", -10.0, "Marche/running", 1.0, False),
         (5, None, 500.0, "Transports en commun", None, False), (6, None, 700.0, None, None, None)],
        "id_salarie int, bu string, salaire_brut double, moyen_declare string, distance_km double, "
        "distance_anormale boolean")
    act = spark.createDataFrame([(i, 1, dt.datetime(2024, 1, 30), "Tennis", None, None, None) for i in range(16)],
                                "id long, id_salarie int, date_debut timestamp_ntz, sport_type string, "
                                "distance_m int, date_fin timestamp_ntz, commentaire string")
    p = Params(as_of=dt.datetime(2024, 1, 31), lookback_days=7)
    e = {r["id_salarie"]: r for r in gold.eligibility(act, ref, p).collect()}
    assert e[1]["eligible_prime"] is True and e[1]["montant_prime"] == 50.0
    assert e[1]["nb_activites_12mois"] == 16 and e[1]["jours_bien_etre"] == 5
    assert e[2]["eligible_prime"] is None and e[2]["distance_a_valider"] is True and e[2]["montant_prime"] == 0.0
    assert e[3]["eligible_prime"] is True and e[3]["montant_prime"] is None
    assert e[4]["montant_prime"] == -0.5
    assert e[5]["mode_actif_declare"] is False and e[6]["mode_actif_declare"] is None
    k = {r["bu"]: r for r in gold.kpis(gold.eligibility(act, ref, p), p).collect()}
    assert set(k) == {"A", "B", None}
    assert k[None]["nb_eligibles_prime"] == 0 and k[None]["nb_salaries"] == 2
    shared = gold.shareable(gold.eligibility(act, ref, p))
    assert not {"id_salarie", "distance_km", "moyen_declare", "salaire_brut", "montant_prime"} & set(shared.columns)


def test_whatif_equals_naive_cross_join(spark):
    elig = Flow(spark, SF).eligibility
    fast = {(r["bu"], r["seuil"]): (r["nb_eligibles_bien_etre"], r["total_jours_bien_etre"])
            for r in whatif.threshold_grid(elig, 30, days=5).collect()}
    grid = spark.range(31).select(F.col("id").cast("int").alias("seuil"))
    naive = (elig.crossJoin(grid)  # test-only reference: the O(staff x thresholds) form
             .groupBy("bu", "seuil")
             .agg(F.count_if(F.col("nb_activites_12mois") >= F.col("seuil")).alias("n")).collect())
    assert {(r["bu"], r["seuil"]): (r["n"], 5 * r["n"]) for r in naive} == fast


def test_scenarios_match_direct_recompute(spark):
    f = Flow(spark, SF)
    s = whatif.scenarios_table(spark, [("x", 0.07, 3, 2)])
    got = {r["bu"]: r for r in whatif.scenario_kpis(f.eligibility, s).collect()}
    p2 = f.params.replace(taux_prime=0.07, seuil_activites_bien_etre=3, jours_bien_etre_accordes=2)
    direct = {r["bu"]: r for r in gold.kpis(gold.eligibility(f.bronze, f.referential, p2), p2).collect()}
    for bu, r in direct.items():
        assert got[bu]["nb_eligibles_bien_etre"] == r["nb_eligibles_bien_etre"]
        assert got[bu]["total_jours_bien_etre"] == r["total_jours_bien_etre"]
        assert abs(got[bu]["cout_total_prime"] - r["cout_total_prime"]) < 1e-3


def test_scenario_thresholds_are_taken_as_given(spark):
    elig = spark.createDataFrame([("A", n, True, 10.0) for n in (0, 5, 40, 150)],
                                 "bu string, nb_activites_12mois long, eligible_prime boolean, salaire_brut double")
    s = whatif.scenarios_table(spark, [("none", 0.1, 151, 1), ("far", 0.1, 100, 1), ("mid", 0.1, 5, 1), ("all", 0.1, -3, 1)])
    got = {r["scenario"]: r["nb_eligibles_bien_etre"] for r in whatif.scenario_kpis(elig, s).collect()}
    assert got == {"none": 0, "far": 1, "mid": 3, "all": 4}
    with pytest.raises(ValueError):
        whatif.scenario_kpis(elig, whatif.scenarios_table(spark, [("x", 0.1, None, 1)]))


def test_whatif_rows_are_linear_in_the_thresholds(spark):
    """Very many thresholds and scenarios, all exact; the plan has no join before the scenarios and two exchanges up to there."""
    elig = spark.range(3000).selectExpr("if(id % 7 = 0, NULL, concat('B', id % 3)) AS bu", "id % 40 * 50 AS nb_activites_12mois",
                                        "id % 2 = 0 AS eligible_prime", "1.0D AS salaire_brut")
    s = spark.range(20_000).selectExpr("concat('s', id) AS scenario", "0.1D AS taux_prime", "CAST(id % 12000 - 5 AS INT) AS seuil", "1 AS jours")
    got = whatif.scenario_kpis(elig, s)
    assert got.count() == 20_000 * 4
    check = {(r["scenario"], r["bu"]): r["nb_eligibles_bien_etre"] for r in got.where("scenario IN ('s0', 's105', 's1955', 's1956', 's13000')").collect()}
    rows = elig.collect()
    for name, t in (("s0", -5), ("s105", 100), ("s1955", 1950), ("s1956", 1951), ("s13000", 995)):
        for bu in {r["bu"] for r in rows}:
            assert check[name, bu] == sum(r["bu"] == bu and r["nb_activites_12mois"] >= t for r in rows)
    text = whatif.threshold_grid(elig, 30)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2 and "Join" not in text
    assert whatif.scenario_kpis(elig, s.limit(0)).count() == 0


def test_modes_table(spark):
    m = {r["moyen_declare"]: (r["seuil_km"], r["profile"]) for r in modes_table(spark).collect()}
    assert m == {"Marche/running": (15, "walking"), "Vélo/Trottinette/Autres": (25, "bicycling")}
