"""The command-line jobs end to end on files derived from the test tables."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from vitalflow import jobs
from vitalflow.operators import gold, referential
from vitalflow.operators.cdc import decode_changes
from vitalflow.operators.dedup import dedup_batch
from vitalflow.operators.routing import route
from vitalflow.params import Params
from vitalflow.schemas import modes_table
from vitalflow.sources.cdc import read_cdc_stream
from vitalflow.sources.fixtures import Fixtures
from vitalflow.streaming.ingest import read_routes
from vitalflow.sources.tables import read_distances, read_hr, read_table

SF = "/root/testdata/sf0.001"


def test_jobs_end_to_end(spark, tmp_dir):
    fx = Fixtures(spark, SF)
    d = {n: os.path.join(tmp_dir, n) for n in
         ["landing", "sink", "ck", "hr", "sport", "dist", "ref", "gold", "quality", "whatif", "msgs", "ck2"]}
    fx.cdc().select("value").filter(F.col("value").isNotNull()).write.text(d["landing"])
    fx.hr_sheet().write.option("header", True).csv(d["hr"])
    fx.sport().select(F.col("id_salarie").alias("ID salarié"), F.col("pratique").alias("Pratique d'un sport")) \
        .write.option("header", True).csv(d["sport"])
    fx.distances().write.parquet(d["dist"])
    params = os.path.join(tmp_dir, "parametres.json")
    with open(params, "w") as fh:
        json.dump({"taux_prime": 0.05, "seuil_activites_bien_etre": 15, "jours_bien_etre_accordes": 5}, fh)
    clock = ["--params", params, "--as-of", "2024-01-31T00:00:00", "--lookback-days", "7"]

    jobs.main(["ingest", "--source", d["landing"], "--out", d["sink"], "--checkpoint", d["ck"],
               "--available-now", *clock], spark)
    jobs.main(["referential", "--hr", d["hr"], "--sport", d["sport"], "--distances", d["dist"],
               "--out", d["ref"]], spark)
    jobs.main(["gold", "--bronze", d["sink"], "--referential", d["ref"], "--out", d["gold"], *clock], spark)
    scen = os.path.join(tmp_dir, "scenarios.json")
    with open(scen, "w") as fh:
        json.dump([{"scenario": "a", "taux_prime": 0.05, "seuil": 15, "jours": 5},
                   {"scenario": "b", "taux_prime": 0.06, "seuil": 40, "jours": 2}], fh)
    jobs.main(["whatif", "--gold", d["gold"], "--out", d["whatif"], "--scenarios", scen, *clock], spark)
    jobs.main(["quality", "--bronze", d["sink"], "--referential", d["ref"], "--gold", d["gold"],
               "--out", d["quality"], *clock], spark)
    jobs.main(["notify", "--source", d["landing"], "--out", d["msgs"], "--checkpoint", d["ck2"],
               "--referential", d["ref"], "--available-now"], spark)
    jobs.main(["preview", "--table", d["gold"] + "/eligibilite"], spark)

    rows = read_routes(spark, d["sink"]).count()
    jobs.main(["reconcile", "--source", d["landing"], "--sink", d["sink"], *clock], spark)   # one batch saw all: nothing late
    jobs.main(["compact", "--sink", d["sink"]], spark)
    assert read_routes(spark, d["sink"]).count() == rows
    assert read_table(spark, d["ref"]).where("pratique_declaree").count() > 0

    # the same computation as batch functions over the same files
    p = Params(as_of=__import__("datetime").datetime(2024, 1, 31), lookback_days=7)
    batch = decode_changes(read_cdc_stream(spark, d["landing"], stream=False), ntz=False)
    bronze = route(dedup_batch(batch.drop("ingested_at")), p).valid
    hr, sport = read_hr(spark, d["hr"], d["sport"])
    ref = referential.build_referential(spark, hr, read_distances(spark, d["dist"]), sport=sport,
                                        modes=modes_table(spark))
    expected = {r["bu"]: tuple(r)[1:7] for r in gold.kpis(gold.eligibility(bronze, ref, p), p).collect()}
    got = {r["bu"]: tuple(r)[1:7] for r in read_table(spark, d["gold"] + "/kpis_par_bu").collect()}
    assert got == expected and len(got) == 5
    assert read_table(spark, d["quality"] + "/quality_checks").count() == 11
    assert read_table(spark, d["whatif"] + "/seuils").count() == 5 * 31
    scen_a = {r["bu"]: (r["nb_eligibles_bien_etre"], r["total_jours_bien_etre"])
              for r in read_table(spark, d["whatif"] + "/scenarios").filter("scenario = 'a'").collect()}
    assert scen_a == {bu: (v[3], v[4]) for bu, v in expected.items()}
    assert spark.read.parquet(d["msgs"]).count() > 900
