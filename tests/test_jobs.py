"""Table-writing jobs, parameter loading, sheet reading, text helpers."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from vitalflow.functions import text, time as ftime
from vitalflow.operators import notify
from vitalflow.params import load_params
from vitalflow.plans.medallion import Flow, read_route, run_bronze_batch, run_gold, run_quality
from vitalflow.session import ensure_checkpoint_dir
from vitalflow.sources.tables import preview, read_hr, read_table

SF = "/root/testdata/sf0.001"


def test_batch_jobs_write_and_read_back(spark, tmp_dir):
    f = Flow(spark, SF)
    run_bronze_batch(f.landing, f.params, tmp_dir)
    bronze = read_route(spark, tmp_dir, "valid")
    assert bronze.count() == 933 and read_route(spark, tmp_dir, "quarantine").count() == 66
    kpis = run_gold(spark, bronze.drop("reasons"), f.referential, f.params, tmp_dir)
    assert kpis.count() == 5
    checks = run_quality(spark, bronze.drop("reasons"), f.referential, read_table(spark, f"{tmp_dir}/eligibilite"),
                         f.params, tmp_dir)
    assert checks.count() == 11
    report = [p for p in os.listdir(f"{tmp_dir}/rapport_qualite") if p.startswith("part-")]
    with open(f"{tmp_dir}/rapport_qualite/{report[0]}", encoding="utf-8") as fh:
        lines = fh.read().splitlines()
    assert lines[0] == "# Rapport de qualité des données" and len(lines) == 16


def test_preview_is_ordered_top10(spark):
    rows = preview(Flow(spark, SF).bronze, 10).collect()
    ids = [r["id"] for r in rows]
    assert len(ids) == 10 and ids == sorted(ids)


def test_load_params(spark, tmp_dir):
    path = os.path.join(tmp_dir, "parametres.json")
    with open(path, "w") as fh:
        json.dump({"taux_prime": 0.07, "seuil_activites_bien_etre": 12, "jours_bien_etre_accordes": 4}, fh, indent=2)
    p = load_params(spark, path, as_of=dt.datetime(2024, 1, 31))
    assert (p.taux_prime, p.seuil_activites_bien_etre, p.jours_bien_etre_accordes) == (0.07, 12, 4)
    assert p.as_of == dt.datetime(2024, 1, 31)


def test_read_hr_sheet_with_optional_sport(spark, tmp_dir):
    hr_path = os.path.join(tmp_dir, "rh.csv")
    with open(hr_path, "w", encoding="utf-8") as fh:
        fh.write("ID salarié,Prénom,Nom,BU,Salaire brut,Moyen de déplacement,Adresse du domicile\n")
        fh.write("1,Ada,Lovelace,R&D,52000.5,Marche/running,1 rue A\n")
        fh.write("2,Alan,Turing,R&D,48000,véhicule thermique/électrique,2 rue B\n")
    hr, sport = read_hr(spark, hr_path, os.path.join(tmp_dir, "missing.csv"))
    assert sport is None
    assert hr.columns == ["id_salarie", "prenom", "nom", "bu", "salaire_brut", "moyen_declare", "adresse"]
    names = {r["id_salarie"]: r["nom_complet"] for r in notify.directory(hr).collect()}
    assert names == {1: "Ada Lovelace", 2: "Alan Turing"}


def test_sheets_are_read_by_header_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rh.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("Remarque,BU,Nom,Prénom,ID salarié,Moyen de déplacement,Salaire brut,Adresse du domicile\n")
        fh.write("x,R&D,Lovelace,Ada,1,Marche/running,30000,1 rue A\n")
    r = read_hr(spark, path)[0].first()
    assert (r["id_salarie"], r["nom"], r["bu"], r["salaire_brut"]) == (1, "Lovelace", "R&D", 30000.0)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("ID salarié,Nom\n1,Lovelace\n")
    with pytest.raises(ValueError, match="Salaire brut"):
        read_hr(spark, path)


def test_referential_keeps_one_row_per_employee(spark):
    """Two sports and two measurements of one employee: all sports told, the latest distance counts."""
    from vitalflow.operators import referential
    hr = spark.createDataFrame([(1, "A", "Marche/running")], "id_salarie int, bu string, moyen_declare string")
    sport = spark.createDataFrame([(1, "Tennis", 1), (1, "Judo", 2), (1, None, 3)], "id_salarie int, pratique string, n int")
    old, new = dt.datetime(2022, 1, 1), dt.datetime(2023, 1, 1)
    dist = spark.createDataFrame([(1, "walking", 2000, "OK", new), (1, "walking", 90000, "OK", old)],
                                 "id_salarie int, profile string, metres int, status string, measured_at timestamp_ntz")
    r = referential.build_referential(spark, hr, dist, sport).collect()
    assert [(x["pratique"], x["distance_km"], x["distance_anormale"]) for x in r] == [("Judo, Tennis", 2.0, False)]
    assert referential.join_sport(hr, sport).count() == 3  # a row for each declaration
    assert [x["pratique_declaree"] for x in referential.practice_flag(hr, sport, order="n").collect()] == [False]
    assert [x["pratique_declaree"] for x in referential.practice_flag(hr, sport).collect()] == [True]
    without = referential.build_referential(spark, hr, None).first()
    assert without["distance_km"] is None and without["distance_anormale"] is None


def test_placeholders_inside_values_stay(spark):
    out = spark.range(1).select(text.fill_template("{nom} : {sport} {x}!", {"nom": F.lit("{sport}"), "sport": F.lit("{duree}")}))
    assert out.first()[0] == "{sport} : {duree} {x}!"


def test_fixed_values_are_the_agreed_ones():
    """Written out here, so that a changed rule table shows."""
    from vitalflow import schemas
    assert schemas.DEFAULT_CAP_M == 10000 and schemas.DISTANCE_CAPS_M["Vélo"] == 150000
    assert schemas.DISTANCE_CAPS_M["Course à pied"] == 42000 and schemas.DISTANCE_CAPS_M["Marche"] == 25000
    assert schemas.ACTIVE_MODES == {"Marche/running": (15, "walking"), "Vélo/Trottinette/Autres": (25, "bicycling")}
    assert len(schemas.KNOWN_SPORTS) == 16 and schemas.DEFAULT_PARAMS["taux_prime"] == 0.05


def test_text_helpers(spark):
    df = spark.createDataFrame([(0,), (49,), (50,), (12345,), (12350,), (150000,)], "m int")
    got = [r[0] for r in df.select(text.km_text("m")).collect()]
    assert got == ["0.0", "0.0", "0.1", "12.3", "12.4", "150.0"]
    caps = [r[0] for r in df.select(text.whole_km_text(F.lit(42000))).collect()]
    assert set(caps) == {"42"}


def test_duration_rounds_half_even(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [(t0, t0 + dt.timedelta(seconds=s)) for s in (29, 30, 90, 150, 3600)] + [(t0, None)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(ftime.duration_min("a", "b")).collect()]
    assert got == [0, 0, 2, 2, 60, None]


def test_messages_unknown_employee_and_templates(spark):
    ev = spark.createDataFrame(
        [(3, 99, dt.datetime(2024, 1, 1, 8), "Tennis", None, dt.datetime(2024, 1, 1, 9), ""),
         (4, None, dt.datetime(2024, 1, 1, 8), "", 60000, None, None)],
        "id long, id_salarie int, date_debut timestamp_ntz, sport_type string, distance_m int, "
        "date_fin timestamp_ntz, commentaire string")
    m = {r["id"]: r for r in notify.messages(ev, None, as_of=dt.datetime(2024, 1, 31)).collect()}
    assert m[3]["type_message"] == "message"
    assert m[3]["texte"] == "GG Salarié #99 ! Tennis au programme aujourd'hui, 60 min bien remplies ! 🔥"
    assert m[4]["type_message"] == "alerte"
    assert "• *Collaborateur* : Salarié #None" in m[4]["texte"]
    assert ("identifiant salarié absent, discipline non renseignée, distance irréaliste pour  "
            "(60.0 km déclarés, max : 10 km)") in m[4]["texte"]


def test_checkpoint_dir_respects_session_setting(spark):
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_last_sheet_row_wins(spark, tmp_dir):
    """The row order comes from the reader, over files and pieces of a sheet."""
    from vitalflow.operators import referential
    hr, sport = os.path.join(tmp_dir, "rh.csv"), os.path.join(tmp_dir, "sport.csv")
    with open(hr, "w", encoding="utf-8") as fh:
        fh.write("ID salarié,Prénom,Nom,BU,Salaire brut,Moyen de déplacement,Adresse du domicile\n")
        fh.writelines(f"{i},A,B,X,1,Marche/running,r\n" for i in range(4))
    with open(sport, "w", encoding="utf-8") as fh:
        fh.write("ID salarié,Pratique d'un sport\n0,Tennis\n1,Judo\n1,\n2,\n2,Tennis\n")
        fh.writelines("0,Judo\n" for _ in range(500))
        fh.write("0,\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")   # several pieces
    try:
        got = {r["id_salarie"]: r["pratique_declaree"] for r in referential.practice_flag(*read_hr(spark, hr, sport)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == {0: False, 1: False, 2: True, 3: False}


def test_failed_overwrite_leaves_the_old_rows(spark, tmp_dir):
    """A table is replaced by one log entry: a job that fails before changes nothing, readers under way go on."""
    from pyspark.errors import PySparkException

    from vitalflow.sources import versions
    from vitalflow.sources.tables import read_table, write_table
    path = os.path.join(tmp_dir, "t")
    write_table(spark.range(5), path)
    reader = read_table(spark, path)
    with pytest.raises(PySparkException):
        write_table(spark.range(100).select(F.raise_error(F.lit("no"))), path)
    assert read_table(spark, path).count() == 5
    write_table(spark.range(7).withColumn("p", F.col("id") % 2), path, partition_by=["p"])
    assert reader.count() == 5 and read_table(spark, path).count() == 7     # across one replacement
    assert "PartitionFilters: [isnotnull(p" in read_table(spark, path).where("p = 1")._jdf.queryExecution().toString()
    write_table(spark.range(1), path)
    assert read_table(spark, path).count() == 1 and len(os.listdir(f"{path}/data")) == 2
    assert len(versions.live(spark, path)) == 1
    with pytest.raises(ValueError):
        versions.read_live(spark, os.path.join(tmp_dir, "nothing"))
