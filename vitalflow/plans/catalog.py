"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Every query reads the given test tables (through the fixture formulas of
FIXTURES.md) with ``TEST_PARAMS`` (as_of 2024-01-31, 7-day look-back, rate
0.05, threshold 15, 5 days). Timestamps are TIMESTAMP_NTZ (UTC wall clock)
and money sums are rounded to 4 decimals, so results compare exactly with the
DuckDB oracle of :mod:`vitalflow.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nulls, rules, text, time as ftime
from ..operators import cdc, dedup, gold, lookups, notify, quality, referential, routing, whatif
from ..params import TEST_PARAMS
from ..schemas import KNOWN_SPORTS, caps_table, modes_table
from ..sources import fixtures
from ..session import scratch_path
from ..sources.cdc import ARRIVAL, UNREADABLE, decode_envelope, read_cdc_stream, write_records
from ..sources.tables import preview, read_hr, read_table, stored
from .medallion import Flow

P = TEST_PARAMS
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
WHATIF_SCENARIOS = [("base", 0.05, 15, 5), ("seuil_10", 0.05, 10, 5), ("genereux", 0.06, 8, 7),
                    ("strict", 0.04, 25, 3), ("hors_grille", 0.05, 100, 5), ("tous", 0.05, -1, 5)]


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _flow(spark, sf) -> Flow:
    return Flow(spark, sf, P)


def _motifs(col="reasons"):
    return F.concat_ws(",", F.col(col)).alias("motifs")


# --- A. sources and sinks -------------------------------------------------------

@register("src_cdc_stream")
def q_src_cdc_stream(spark, sf):
    """The change stream's records, landed in a folder and read back by the source; a tombstone has a key and no value."""
    path = scratch_path(spark, f"src-cdc-{uuid.uuid4().hex}")
    write_records(_flow(spark, sf).fx.cdc(), path)
    records = read_cdc_stream(spark, path, fmt="records", stream=False)
    return records.withColumn("timestamp", ftime.utc_wall(F.col("timestamp")))


@register("cdc_decode")
def q_cdc_decode(spark, sf):
    return decode_envelope(_flow(spark, sf).fx.cdc())


@register("scan_bronze")
def q_scan_bronze(spark, sf):
    from ..schemas import SOURCE_SCHEMAS
    return fixtures.activities(read_table(spark, f"{sf}/events.parquet", schema=SOURCE_SCHEMAS["events"]))


@register("src_hr")
def q_src_hr(spark, sf):
    """The HR sheet as CSV with its columns in another order and one more, read by header name."""
    path = scratch_path(spark, f"src-hr-{uuid.uuid4().hex}")
    sheet = _flow(spark, sf).fx.hr_sheet()
    sheet.select(F.lit("x").alias("Remarque"), *reversed(sheet.columns)).write.option("header", True).csv(path)
    return read_hr(spark, path)[0]


@register("preview_bronze")
def q_preview_bronze(spark, sf):
    return preview(_flow(spark, sf).bronze, 10, "id")


@register("row_count")
def q_row_count(spark, sf):
    return _flow(spark, sf).bronze.agg(F.count(F.lit(1)).alias("nb_lignes"))


@register("quality_report")
def q_quality_report(spark, sf):
    f = _flow(spark, sf)
    return quality.report_lines(quality.run_checks(f.stored_bronze, f.stored_referential, f.stored_eligibility, P), P)


# --- B. projections, filters, predicates ---------------------------------------

@register("cdc_drop_deletes")
def q_cdc_drop_deletes(spark, sf):
    return cdc.drop_deletes(decode_envelope(_flow(spark, sf).fx.cdc()))


@register("cdc_guard_empty")
def q_cdc_guard_empty(spark, sf):
    return cdc.guard_empty(cdc.decode_with_guard_flag(_flow(spark, sf).fx.cdc()))


@register("cdc_timestamps")
def q_cdc_timestamps(spark, sf):
    return cdc.decode_changes(_flow(spark, sf).fx.cdc(), as_of=P.as_of, ntz=True)


@register("rule_distance_cap")
def q_rule_distance_cap(spark, sf):
    return _flow(spark, sf).landing.select(
        "id", "sport_type", "distance_m", rules.cap_for().alias("cap_m"), rules.distance_ok().alias("distance_ok"))


@register("rule_valid")
def q_rule_valid(spark, sf):
    return _flow(spark, sf).deduplicated.select("id", rules.is_valid(P.as_of).alias("regle_valide"))


@register("bronze_valid")
def q_bronze_valid(spark, sf):
    return _flow(spark, sf).bronze


@register("bronze_quarantine")
def q_bronze_quarantine(spark, sf):
    q = _flow(spark, sf).quarantine
    return q.select(*[c for c in q.columns if c != "reasons"], _motifs())


@register("bronze_unrouted")
def q_bronze_unrouted(spark, sf):
    f = Flow(spark, sf, P, null_policy="drop")
    u = f.routed.unrouted
    return u.select(*[c for c in u.columns if c != "reasons"], _motifs())


@register("lookback_filter")
def q_lookback_filter(spark, sf):
    return gold.lookback(_flow(spark, sf).bronze, P).select("id", "id_salarie", "date_debut")


@register("hr_project")
def q_hr_project(spark, sf):
    return referential.standardise_hr(_flow(spark, sf).referential)


def _elig_cols(*cols):
    def q(spark, sf):
        return _flow(spark, sf).eligibility.select("id_salarie", *cols)
    return q


register("active_mode_flag")(_elig_cols("moyen_declare", "mode_actif_declare"))
register("distance_pending_flag")(_elig_cols("mode_actif_declare", "distance_anormale", "distance_a_valider"))
register("bonus_eligible_flag")(_elig_cols("eligible_prime"))
register("bonus_amount")(_elig_cols("salaire_brut", "eligible_prime", "montant_prime"))
register("wellness_flag_days")(_elig_cols("nb_activites_12mois", "eligible_bien_etre", "jours_bien_etre"))
register("computed_at")(_elig_cols("calcule_le"))


@register("privacy_projection")
def q_privacy_projection(spark, sf):
    return gold.shareable(_flow(spark, sf).eligibility)


# --- C. joins -------------------------------------------------------------------

@register("join_eligibility")
def q_join_eligibility(spark, sf):
    f = _flow(spark, sf)
    return gold.join_counts(referential.standardise_hr(f.referential), gold.count_activities(f.bronze, P))


@register("join_hr_sport")
def q_join_hr_sport(spark, sf):
    f = _flow(spark, sf)
    return referential.join_sport(f.hr, f.fx.sport_rows()).select("id_salarie", "nom", "pratique")


@register("declared_practice_flag")
def q_declared_practice_flag(spark, sf):
    """The practice sheet has several rows for an employee, some of them blank: the last one counts."""
    f = _flow(spark, sf)
    return referential.practice_flag(f.hr, f.fx.sport_rows(), order="ligne").select("id_salarie", "pratique_declaree")


@register("orphan_activities")
def q_orphan_activities(spark, sf):
    f = _flow(spark, sf)
    return quality.orphans(f.landing, f.hr).select("id", "id_salarie")


@register("known_activities")
def q_known_activities(spark, sf):
    f = _flow(spark, sf)
    return quality.known(f.landing, f.hr).select("id", "id_salarie")


@register("stream_directory_join")
def q_stream_directory_join(spark, sf):
    f = _flow(spark, sf)
    return notify.with_name(f.landing, f.directory).select("id", "id_salarie", "nom_affiche")


@register("cap_lookup_join")
def q_cap_lookup_join(spark, sf):
    return lookups.with_cap(_flow(spark, sf).landing, caps_table(spark)).select("id", "sport_type", "cap_m")


@register("mode_threshold_join")
def q_mode_threshold_join(spark, sf):
    return (referential.with_mode_rules(_flow(spark, sf).hr, modes_table(spark))
            .select("id_salarie", "moyen_declare", "seuil_km", "profile"))


@register("join_commute_distance")
def q_join_commute_distance(spark, sf):
    f = _flow(spark, sf)
    j = referential.with_distance(referential.with_mode_rules(f.hr, modes_table(spark)), f.fx.distances())
    return j.select("id_salarie", "profile", "distance_km", "measured", "lookup_failed")


@register("whatif_grid")
def q_whatif_grid(spark, sf):
    return whatif.threshold_grid(_flow(spark, sf).eligibility, 30, params=P).select("bu", "seuil")


# --- D. aggregations ----------------------------------------------------------

@register("activity_count")
def q_activity_count(spark, sf):
    """The look-back's activities per employee, summed from a stored table of counts per day."""
    days = stored(gold.day_counts(_flow(spark, sf).bronze.select("id_salarie", F.to_date("date_debut").alias("jour"))), "day-counts")
    return gold.count_from_days(days, P)


@register("eligibility")
def q_eligibility(spark, sf):
    return _flow(spark, sf).eligibility


@register("kpis_by_bu")
def q_kpis_by_bu(spark, sf):
    return _flow(spark, sf).kpis


@register("kpis_total")
def q_kpis_total(spark, sf):
    return gold.kpis_total(_flow(spark, sf).eligibility)


@register("anomaly_count")
def q_anomaly_count(spark, sf):
    return referential.anomaly_count(_flow(spark, sf).referential)


@register("violation_counts")
def q_violation_counts(spark, sf):
    f = _flow(spark, sf)
    return quality.run_checks(f.stored_bronze, f.stored_referential, f.stored_eligibility, P)


@register("checks_summary")
def q_checks_summary(spark, sf):
    f = _flow(spark, sf)
    return quality.summary(quality.run_checks(f.stored_bronze, f.stored_referential, f.stored_eligibility, P))


@register("whatif_threshold")
def q_whatif_threshold(spark, sf):
    g = whatif.threshold_grid(_flow(spark, sf).eligibility, 30, params=P)
    return g.withColumn("masse_salariale_prime", F.round("masse_salariale_prime", 4))


@register("whatif_params")
def q_whatif_params(spark, sf):
    s = whatif.scenarios_table(spark, WHATIF_SCENARIOS)
    return whatif.scenario_kpis(_flow(spark, sf).eligibility, s)


@register("quarantine_stats")
def q_quarantine_stats(spark, sf):
    return routing.reject_stats(_flow(spark, sf).quarantine)


# --- E. windows / duplicates ------------------------------------------------------

@register("duplicate_ids")
def q_duplicate_ids(spark, sf):
    return dedup.duplicate_keys(fixtures.hr_with_repeats(_flow(spark, sf).hr))


@register("dedup_batch")
def q_dedup_batch(spark, sf):
    """The first image of each (employee, start, sport) in the order of the changes."""
    return dedup.dedup_batch(_flow(spark, sf).fx.changes()).drop("op", *ARRIVAL)


@register("cdc_arrival")
def q_cdc_arrival(spark, sf):
    """The image that stays of each key, with its time and place as its envelope tells them."""
    envelopes = fixtures.change_envelopes(_flow(spark, sf).fx.changes())
    rows = cdc.decode_changes(envelopes, as_of=P.as_of, ntz=True, arrival=True)
    return dedup.dedup_batch(rows).select("id", "distance_m", "change_ms", "log_position")


# --- G. set operations -------------------------------------------------------------

@register("split_partition_check")
def q_split_partition_check(spark, sf):
    # the rows are used four times: as a written table, or each task would deduplicate its share once for every use
    rows = stored(_flow(spark, sf).deduplicated, "deduplicated")
    return routing.split_check(rows, routing.route(rows, P, null_policy="drop"))


# --- H. scalar functions ----------------------------------------------------------

@register("fn_epoch_micros")
def q_fn_epoch_micros(spark, sf):
    d = cdc.drop_deletes(decode_envelope(_flow(spark, sf).fx.cdc()))
    return d.select("id", F.col("date_debut").alias("debut_us"),
                    ftime.utc_wall(ftime.from_micros("date_debut")).alias("date_debut"))


@register("fn_duration_min")
def q_fn_duration_min(spark, sf):
    return _flow(spark, sf).landing.select("id", ftime.duration_min("date_debut", "date_fin").alias("duree_min"))


@register("fn_distance_km")
def q_fn_distance_km(spark, sf):
    return _flow(spark, sf).landing.select("id", "distance_m", text.km("distance_m").alias("distance_km"))


@register("fn_km_format")
def q_fn_km_format(spark, sf):
    return _flow(spark, sf).landing.select(
        "id", text.km_text("distance_m").alias("km_texte"),
        text.whole_km_text(rules.cap_for()).alias("plafond_texte"))


@register("fn_date_window")
def q_fn_date_window(spark, sf):
    start = ftime.window_start(P.as_of, P.lookback_days)
    return _flow(spark, sf).landing.select("id", (F.col("date_debut") >= start).alias("dans_fenetre"))


@register("fn_null_default")
def q_fn_null_default(spark, sf):
    return _flow(spark, sf).landing.select("id", nulls.default("distance_m", 0).alias("distance_ou_zero"))


@register("fn_bool_to_int")
def q_fn_bool_to_int(spark, sf):
    return (_flow(spark, sf).eligibility.groupBy("moyen_declare")
            .agg(nulls.flag_sum("eligible_prime").cast("long").alias("nb_eligibles_prime"),
                 nulls.flag_sum("distance_a_valider").cast("long").alias("nb_a_valider")))


@register("fn_isin")
def q_fn_isin(spark, sf):
    return _flow(spark, sf).landing.select(
        "id", nulls.in_list("sport_type", KNOWN_SPORTS).alias("sport_connu"),
        F.col("sport_type").isin(KNOWN_SPORTS).alias("sport_connu_3v"))


@register("fn_concat_name")
def q_fn_concat_name(spark, sf):
    return notify.directory(_flow(spark, sf).hr)


@register("fn_template")
def q_fn_template(spark, sf):
    f = _flow(spark, sf)
    e = notify.with_name(f.landing, f.directory)
    return e.select("id", notify.praise_text().alias("texte"))


@register("fn_append_comment")
def q_fn_append_comment(spark, sf):
    return _flow(spark, sf).landing.select(
        "id", text.with_comment(F.col("sport_type"), F.col("commentaire")).alias("texte"))


@register("fn_reason_array")
def q_fn_reason_array(spark, sf):
    """Reasons of every change, with a distance that is no integer told from a missing one."""
    d = cdc.decode_changes(_flow(spark, sf).fx.cdc(), as_of=P.as_of, ntz=True, unreadable=True)
    return d.select("id", F.concat_ws(",", rules.reasons(P.as_of, unreadable=UNREADABLE)).alias("motifs"))


@register("fn_json")
def q_fn_json(spark, sf):
    from ..schemas import ENVELOPE_SCHEMA
    e = _flow(spark, sf).fx.cdc().select(F.from_json("value", ENVELOPE_SCHEMA).alias("e"))
    return e.select(F.col("e.payload.after.id").alias("id"), F.col("e.payload.op").alias("op"),
                    F.col("e.payload.after").isNull().alias("after_absent"))


@register("fn_three_state_anomaly")
def q_fn_three_state_anomaly(spark, sf):
    return _flow(spark, sf).referential.select("id_salarie", "moyen_declare", "distance_km", "distance_anormale")


@register("fn_truthy")
def q_fn_truthy(spark, sf):
    return _flow(spark, sf).landing.select(
        "id", nulls.is_blank("sport_type").alias("sport_vide"),
        nulls.is_blank("distance_m", "number").alias("distance_vide"),
        nulls.is_blank("commentaire").alias("commentaire_vide"))


# --- I. streaming operators, batch twins --------------------------------------------

@register("stream_dedup")
def q_stream_dedup(spark, sf):
    """Keys that survive the streaming dedup (an availableNow run) and how many rows have them: one, dated or not."""
    keys = _stream_rows(_ingested(spark, sf)).select(*dedup.DEDUP_KEYS)
    return keys.groupBy(*dedup.DEDUP_KEYS).agg(F.count(F.lit(1)).alias("n"))


def _ingested(spark, sf) -> DataFrame:
    """The routed sink table of one availableNow run of the streaming ingest."""
    from .medallion import run_stream_ingest_once
    return run_stream_ingest_once(spark, _flow(spark, sf).fx.cdc(), P)


def _stream_rows(df):
    """The sink's rows without what arrival decides: the id (twins differ by it alone), the clock, and of
    rows without event time, whose key stands for several activities, all but key and route."""
    start = ftime.utc_wall(F.col("date_debut"))
    timed = start <= F.current_timestamp().cast("timestamp_ntz")
    of_one = lambda c: F.when(timed, F.col(c)).alias(c)
    return df.select("id_salarie", start.alias("date_debut"), "sport_type", of_one("distance_m"),
                     F.when(timed, ftime.utc_wall(F.col("date_fin"))).alias("date_fin"), of_one("commentaire"),
                     of_one("reasons"), "route")


@register("stream_route")
def q_stream_route(spark, sf):
    """The real streaming ingest (one availableNow run) over the change records derived from the tables."""
    return _stream_rows(_ingested(spark, sf))


LATE_CUT = "2024-01-15 00:00:00"


def _restart_runs(spark, sf, reconciled: bool = False):
    """Three ingest runs on one checkpoint: rows from LATE_CUT on (and undated), the same rows
    replayed after a restart, then the older rows after another restart."""
    from ..sources.fixtures import cdc_records
    from .medallion import run_stream_restarts
    d = _flow(spark, sf).landing
    old = F.col("date_debut") < F.lit(LATE_CUT).cast("timestamp_ntz")
    recent = cdc_records(d.filter(~old | F.col("date_debut").isNull()))
    return run_stream_restarts(spark, [recent, recent, cdc_records(d.filter(old))], P, reconciled=reconciled)


@register("stream_checkpoint")
def q_stream_checkpoint(spark, sf):
    """Sink rows after restart + replay + late rows, with the number of copies: the replay adds
    nothing, dated or not, and the older rows are late."""
    sink, _ = _restart_runs(spark, sf)
    rows = _stream_rows(sink)
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@register("stream_late_drop")
def q_stream_late_drop(spark, sf):
    """Watermark reached by the first run and rows dropped as late by the last run (from query progress), and the
    rows of the sink once the batch reconciliation has added what was late."""
    sink, stats = _restart_runs(spark, sf, reconciled=True)
    row = [(stats[0]["watermark"], int(stats[-1]["late"]), sink.count())]
    df = spark.createDataFrame(row, "filigrane string, n_tardives_ignorees long, n_apres_rattrapage long")
    return df.select(ftime.utc_wall(F.to_timestamp("filigrane")).alias("filigrane"), "n_tardives_ignorees", "n_apres_rattrapage")


@register("stream_watermark")
def q_stream_watermark(spark, sf):
    """Event time of each change in a running stream: the start time, NULL when later than now + tolerance."""
    from ..streaming.ingest import EVENT_TIME, await_end, with_watermark
    root = scratch_path(spark, f"stream-watermark-{uuid.uuid4().hex}")
    write_records(_flow(spark, sf).fx.cdc(), f"{root}/landing")
    rows = cdc.decode_changes(read_cdc_stream(spark, f"{root}/landing", fmt="records"))
    timed = with_watermark(rows, "2 hours", gate_future_s=P.future_tolerance_s).select("id", EVENT_TIME)
    await_end(timed.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
              .trigger(availableNow=True).start(f"{root}/out"))
    out = spark.read.schema(timed.schema).parquet(f"{root}/out")
    return out.select("id", ftime.utc_wall(F.col(EVENT_TIME)).alias("temps_evenement"))


@register("fn_now")
def q_fn_now(spark, sf):
    """The run clock stamped on every landed row (injected as_of)."""
    return _flow(spark, sf).landing.select("id", ftime.clock(P.as_of).alias("horodatage"))


@register("stream_await")
def q_stream_await(spark, sf):
    """An availableNow ingest ends by itself (awaitTermination returns) after reading every landed message."""
    from .medallion import run_stream_ingest_once
    progress: list = []
    run_stream_ingest_once(spark, _flow(spark, sf).fx.cdc(), P, progress=progress)
    row = [(not progress[0]["active"], int(progress[0]["input_rows"]))]
    return spark.createDataFrame(row, "termine boolean, n_messages_lus long")


@register("sink_bronze_stream")
def q_sink_bronze_stream(spark, sf):
    """Valid rows of the streaming ingest sink."""
    return _stream_rows(_ingested(spark, sf).filter(F.col("route") == "valid"))


@register("sink_quarantine_stream")
def q_sink_quarantine_stream(spark, sf):
    """Quarantined rows of the streaming ingest sink."""
    return _stream_rows(_ingested(spark, sf).filter(F.col("route") == "quarantine"))


@register("sink_notify")
def q_sink_notify(spark, sf):
    """Messages written by the streaming notifier (availableNow) over the derived change events."""
    from .medallion import run_stream_notifier_once
    f = _flow(spark, sf)
    out = run_stream_notifier_once(spark, f.fx.cdc(), notify.directory(f.hr), P.future_tolerance_s)
    return out.drop("query", "batch_id")


@register("sink_overwrite")
def q_sink_overwrite(spark, sf):
    """The eligibility table written in overwrite mode and read back."""
    from ..sources.tables import write_table
    path = scratch_path(spark, f"sink-overwrite-{uuid.uuid4().hex}")
    elig = _flow(spark, sf).eligibility
    write_table(elig, path)
    write_table(elig, path, mode="overwrite")  # a second run replaces, never appends
    return read_table(spark, path)


@register("stream_anomalies")
def q_stream_anomalies(spark, sf):
    a = notify.with_anomalies(_flow(spark, sf).landing, P.as_of, P.future_tolerance_s)
    return a.select("id", F.concat_ws(" | ", "anomalies").alias("anomalies"))


@register("stream_messages")
def q_stream_messages(spark, sf):
    f = _flow(spark, sf)
    m = notify.messages(f.landing, f.directory, P.as_of, P.future_tolerance_s)
    return m.filter(F.col("type_message") == notify.KIND_MESSAGE)


@register("stream_alerts")
def q_stream_alerts(spark, sf):
    f = _flow(spark, sf)
    m = notify.messages(f.landing, f.directory, P.as_of, P.future_tolerance_s)
    return m.filter(F.col("type_message") == notify.KIND_ALERT)


# --- K. the 11 quality checks, one key each --------------------------------------------
# Bronze checks run on the landing table (planted faults), HR uniqueness on HR
# with planted repeats, the others on the referential and the gold table.

def _bronze_check(name):
    def q(spark, sf):
        return quality.check_bronze(_flow(spark, sf).landing, P, only=[name])
    return q


for _name in ["distance_non_negative", "date_debut_renseignee", "date_debut_pas_future",
              "date_fin_apres_debut", "sport_type_connu"]:
    register(_name)(_bronze_check(_name))


@register("id_salarie_unique")
def q_id_salarie_unique(spark, sf):
    return quality.check_referential(fixtures.hr_with_repeats(_flow(spark, sf).hr), P, only=["id_salarie_unique"])


@register("salaire_positif")
def q_salaire_positif(spark, sf):
    return quality.check_referential(_flow(spark, sf).referential, P, only=["salaire_positif"])


@register("distance_coherente")
def q_distance_coherente(spark, sf):
    return quality.check_referential(_flow(spark, sf).referential, P, only=["distance_coherente"])


@register("id_salarie_existe_dans_rh")
def q_id_salarie_existe_dans_rh(spark, sf):
    f = _flow(spark, sf)
    return quality.check_integrity(f.landing, f.hr, P)


@register("montant_prime_positif_ou_nul")
def q_montant_prime(spark, sf):
    return quality.check_gold(_flow(spark, sf).eligibility, P, only=["montant_prime_positif_ou_nul"])


@register("jours_bien_etre_valides")
def q_jours_bien_etre(spark, sf):
    return quality.check_gold(_flow(spark, sf).eligibility, P, only=["jours_bien_etre_valides"])
