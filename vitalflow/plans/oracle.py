"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string is self-contained: the fixture views of FIXTURES.md and the
pipeline layers are inlined as CTEs over the raw tables, and every computed
column carries the same name as in the Spark query. Rule constants come from
the same fixed-value tables as the Spark code.
"""

from __future__ import annotations

from ..operators import notify, quality
from ..params import TEST_PARAMS
from ..schemas import ACTIVE_MODES, DEFAULT_CAP_M, DISTANCE_CAPS_M, KNOWN_SPORTS
from ..sources import fixtures
from .catalog import WHATIF_SCENARIOS

P = TEST_PARAMS
AS_OF = P.as_of.strftime("%Y-%m-%d %H:%M:%S")
WIN_START = (P.as_of.date() - __import__("datetime").timedelta(days=P.lookback_days)).isoformat() + " 00:00:00"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in values) + ")"


CAP = ("COALESCE(CASE sport_type " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in sorted(DISTANCE_CAPS_M.items()))
       + f" END, {DEFAULT_CAP_M})")
DIST_OK = f"(distance_m IS NULL OR (distance_m >= 0 AND distance_m <= {CAP}))"
VALID = (f"(id_salarie IS NOT NULL AND sport_type IS NOT NULL AND {DIST_OK} "
         f"AND date_debut <= TIMESTAMP '{AS_OF}')")
REASONS = ("concat_ws(',', "
           "CASE WHEN id_salarie IS NULL THEN 'id_salarie_absent' END, "
           "CASE WHEN sport_type IS NULL THEN 'sport_absent' END, "
           "CASE WHEN distance_m < 0 THEN 'distance_negative' END, "
           f"CASE WHEN distance_m >= 0 AND distance_m > {CAP} THEN 'distance_above_cap' END, "
           "CASE WHEN date_debut IS NULL THEN 'date_debut_absente' END, "
           f"CASE WHEN date_debut > TIMESTAMP '{AS_OF}' THEN 'date_debut_future' END)")
ACTIVE = in_list(sorted(ACTIVE_MODES))
MODES_VALUES = ", ".join(f"({q(m)}, {t}, {q(p)})" for m, (t, p) in sorted(ACTIVE_MODES.items()))
SPORT_CASE = ("CASE event_type " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in fixtures.SPORT_BY_EVENT_TYPE)
              + f" ELSE {q(fixtures.SPORT_OTHER)} END")
MODE_CASE = ("CASE c_nationkey % 4 " + " ".join(f"WHEN {i} THEN {q(m)}" for i, m in enumerate(fixtures.MODE_BY_NATION_MOD4[:3]))
             + f" ELSE {q(fixtures.MODE_BY_NATION_MOD4[3])} END")

BASE = f"""
fx_activities AS (
  SELECT event_id AS id, CAST(user_id AS INTEGER) AS id_salarie, ts AS date_debut,
    {SPORT_CASE} AS sport_type,
    CASE WHEN event_type = 'signup' THEN CAST(NULL AS INTEGER) ELSE CAST(floor(value * 100) AS INTEGER) END AS distance_m,
    ts + to_minutes(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS date_fin,
    CASE WHEN event_id % 8 = 0 THEN {q(fixtures.COMMENT)} END AS commentaire
  FROM events),
fx_faulty AS (
  SELECT id,
    CASE WHEN id % 113 = 0 THEN NULL WHEN id % 131 = 0 THEN id_salarie + 10000000 ELSE id_salarie END AS id_salarie,
    CASE WHEN id % 103 = 0 THEN NULL WHEN id % 107 = 0 THEN TIMESTAMP '{fixtures.FAR_FUTURE}' ELSE date_debut END AS date_debut,
    CASE WHEN id % 127 = 0 THEN NULL WHEN id % 137 = 0 THEN 'Curling' ELSE sport_type END AS sport_type,
    CASE WHEN id % 101 = 0 THEN -1 ELSE distance_m END AS distance_m,
    CASE WHEN id % 109 = 0 THEN date_debut - INTERVAL 1 HOUR ELSE date_fin END AS date_fin,
    commentaire
  FROM fx_activities),
fx_dirty AS (
  SELECT * FROM fx_faulty
  UNION ALL
  SELECT id + 1000000000, id_salarie, date_debut, sport_type, distance_m, date_fin, commentaire
  FROM fx_faulty WHERE id % 89 = 0),
fx_hr AS (
  SELECT CAST(c_custkey AS INTEGER) AS id_salarie, CASE WHEN c_custkey % 3 <> 0 THEN 'Ada' END AS prenom, c_name AS nom,
    c_mktsegment AS bu, c_acctbal AS salaire_brut, {MODE_CASE} AS moyen_declare,
    'Nation ' || CAST(c_nationkey AS VARCHAR) AS adresse
  FROM customer),
fx_distance_now AS (
  SELECT id_salarie, CASE moyen_declare WHEN 'Marche/running' THEN 'walking' ELSE 'bicycling' END AS profile,
    CAST((CAST(id_salarie AS BIGINT) * 37) % 400 * 100 AS INTEGER) AS metres,
    CASE WHEN id_salarie % 13 = 0 THEN 'NOT_FOUND' ELSE 'OK' END AS status, TIMESTAMP '2023-06-01 00:00:00' AS measured_at
  FROM fx_hr WHERE moyen_declare IN ('Marche/running', 'Vélo/Trottinette/Autres') AND id_salarie % 11 <> 0),
fx_distance_all AS (
  SELECT * FROM fx_distance_now
  UNION ALL
  SELECT id_salarie, profile, metres + 100000, 'OK', TIMESTAMP '2022-06-01 00:00:00' FROM fx_distance_now WHERE id_salarie % 7 = 0),
fx_distance AS (
  SELECT id_salarie, profile, metres, status FROM (
    SELECT *, row_number() OVER (PARTITION BY id_salarie, profile ORDER BY measured_at DESC) AS rn FROM fx_distance_all)
  WHERE rn = 1),
fx_sport AS (
  SELECT DISTINCT CAST(o_custkey AS INTEGER) AS id_salarie,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Tennis' ELSE 'Judo' END AS pratique
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F'),
fx_modes(moyen_declare, seuil_km, profile) AS (VALUES {MODES_VALUES}),
fx_dedup AS (
  SELECT id, id_salarie, date_debut, sport_type, distance_m, date_fin, commentaire FROM (
    SELECT *, row_number() OVER (PARTITION BY id_salarie, date_debut, sport_type ORDER BY id) AS rn FROM fx_dirty)
  WHERE rn = 1),
fx_routed AS (
  SELECT *, {VALID} AS regle, {REASONS} AS motifs FROM fx_dedup),
fx_bronze AS (
  SELECT id, id_salarie, date_debut, sport_type, distance_m, date_fin, commentaire FROM fx_routed WHERE regle),
fx_quarantine AS (
  SELECT id, id_salarie, date_debut, sport_type, distance_m, date_fin, commentaire, motifs
  FROM fx_routed WHERE regle IS NOT TRUE),
fx_hr_sport AS (
  SELECT h.*, s.pratique FROM fx_hr h
  LEFT JOIN (SELECT id_salarie, string_agg(pratique, ', ' ORDER BY pratique) AS pratique FROM fx_sport GROUP BY id_salarie) s
  ON h.id_salarie = s.id_salarie),
fx_ref AS (
  SELECT h.id_salarie, h.prenom, h.nom, h.bu, h.salaire_brut, h.moyen_declare, h.adresse, h.pratique,
    CASE WHEN d.status = 'OK' THEN CAST(d.metres AS DOUBLE) / 1000 END AS distance_km,
    CASE WHEN m.seuil_km IS NULL THEN FALSE
         WHEN d.id_salarie IS NULL THEN NULL
         WHEN COALESCE(d.status, '') <> 'OK' THEN NULL
         ELSE CAST(d.metres AS DOUBLE) / 1000 > m.seuil_km END AS distance_anormale
  FROM fx_hr_sport h LEFT JOIN fx_modes m ON h.moyen_declare = m.moyen_declare
  LEFT JOIN fx_distance d ON d.id_salarie = h.id_salarie AND d.profile = m.profile),
fx_counts AS (
  SELECT id_salarie, count(*) AS nb_activites_12mois FROM fx_bronze
  WHERE date_debut >= TIMESTAMP '{WIN_START}' GROUP BY id_salarie),
fx_joined AS (
  SELECT r.id_salarie, r.bu, r.salaire_brut, r.moyen_declare, r.distance_km, r.distance_anormale,
    COALESCE(c.nb_activites_12mois, 0) AS nb_activites_12mois,
    r.moyen_declare IN {ACTIVE} AS mode_actif_declare
  FROM fx_ref r LEFT JOIN fx_counts c ON r.id_salarie = c.id_salarie),
fx_elig0 AS (
  SELECT *, mode_actif_declare AND distance_anormale IS NULL AS distance_a_valider,
    mode_actif_declare AND (distance_anormale = FALSE) AS eligible_prime,
    nb_activites_12mois >= {P.seuil_activites_bien_etre} AS eligible_bien_etre
  FROM fx_joined),
fx_elig AS (
  SELECT id_salarie, bu, salaire_brut, moyen_declare, distance_km, distance_anormale, nb_activites_12mois,
    mode_actif_declare, distance_a_valider, eligible_prime,
    CASE WHEN eligible_prime THEN salaire_brut * CAST({P.taux_prime!r} AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS montant_prime,
    eligible_bien_etre,
    CASE WHEN eligible_bien_etre THEN {P.jours_bien_etre_accordes} ELSE 0 END AS jours_bien_etre,
    TIMESTAMP '{AS_OF}' AS calcule_le
  FROM fx_elig0)
"""


def with_base(sql: str) -> str:
    """Prefix the fixture CTEs; a query starting with ``,`` adds CTEs of its own."""
    sql = sql.strip()
    if sql.startswith(","):
        return "WITH " + BASE.strip() + ",\n" + sql[1:].strip()
    return "WITH " + BASE.strip() + "\n" + sql


# --- pieces reused by several keys ------------------------------------------------

UNREADABLE = "(id % 1000000000 % 157 = 0 AND distance_m >= 0)"   # its distance is sent as a text


def _cdc_decoded(more: str = "") -> str:
    """Expected decode of the planted change stream, straight from fx_dirty."""
    return f"""
  SELECT
    CASE WHEN id % 79 = 0 OR id % 83 = 0 OR id % 97 = 0 OR id % 71 = 0 THEN NULL ELSE id END AS id,
    CASE WHEN id % 79 = 0 OR id % 83 = 0 OR id % 97 = 0 OR id % 71 = 0 THEN NULL ELSE id_salarie END AS id_salarie,
    CASE WHEN id % 79 = 0 OR id % 83 = 0 OR id % 97 = 0 OR id % 71 = 0 THEN NULL ELSE epoch_us(date_debut) END AS date_debut,
    CASE WHEN id % 79 = 0 OR id % 83 = 0 OR id % 97 = 0 OR id % 71 = 0 THEN NULL ELSE sport_type END AS sport_type,
    CASE WHEN id % 79 = 0 OR id % 83 = 0 OR id % 97 = 0 OR id % 71 = 0 OR {UNREADABLE} THEN NULL ELSE distance_m END AS distance_m,
    CASE WHEN id % 79 = 0 OR id % 83 = 0 OR id % 97 = 0 OR id % 71 = 0 THEN NULL ELSE epoch_us(date_fin) END AS date_fin,
    CASE WHEN id % 79 = 0 OR id % 83 = 0 OR id % 97 = 0 OR id % 71 = 0 THEN NULL ELSE commentaire END AS commentaire,
    CASE WHEN id % 79 = 0 OR id % 83 = 0 THEN NULL WHEN id % 97 = 0 THEN 'd' WHEN id % 71 = 0 THEN 'c'
         WHEN id % 61 = 0 THEN 'u' WHEN id % 67 = 0 THEN 'r' ELSE 'c' END AS op,
    CASE WHEN id % 79 = 0 OR id % 83 = 0 OR id % 97 = 0 OR id % 71 = 0 THEN FALSE ELSE TRUE END AS after_present,
    NOT (id % 79 = 0 OR id % 83 = 0 OR id % 97 = 0 OR id % 71 = 0) AND COALESCE({UNREADABLE}, FALSE) AS illisible{more}
  FROM fx_dirty"""


DEC_COLS = "id, id_salarie, date_debut, sport_type, distance_m, date_fin, commentaire"
ACT_COLS = DEC_COLS


def _km_tenths(col: str) -> str:
    return f"CAST(floor(CAST({col} + 50 AS DOUBLE) / 100) AS BIGINT)"


def _km_text(col: str) -> str:
    t = _km_tenths(col)
    return f"(CAST(CAST(floor({t} / 10) AS BIGINT) AS VARCHAR) || '.' || CAST(({t} % 10 + 10) % 10 AS VARCHAR))"


def _whole_km_text(col: str) -> str:
    return f"CAST(CAST(round_even({col} / 1000.0, 0) AS BIGINT) AS VARCHAR)"


def _duration(start: str = "date_debut", end: str = "date_fin") -> str:
    return f"CAST(round_even((epoch_us({end}) - epoch_us({start})) / 60000000.0, 0) AS BIGINT)"


def _replace_all(tpl_sql: str, values: dict[str, str]) -> str:
    out = tpl_sql
    for k, v in values.items():
        out = f"replace({out}, {q('{' + k + '}')}, COALESCE(CAST({v} AS VARCHAR), 'None'))"
    return out


def _pick(templates: list[str], key: str = "id") -> str:
    arr = "[" + ", ".join(q(t) for t in templates) + "]"
    n = len(templates)
    return f"list_extract({arr}, CAST((({key} % {n}) + {n}) % {n} + 1 AS INTEGER))"


DIRECTORY = "SELECT id_salarie AS _dir_id, max(concat_ws(' ', prenom, nom)) AS nom_complet FROM fx_hr GROUP BY id_salarie"


def _named(source: str = "fx_dirty") -> str:
    return f"""
  SELECT a.*, COALESCE(d.nom_complet, {q(notify.UNKNOWN_EMPLOYEE)} || COALESCE(CAST(a.id_salarie AS VARCHAR), 'None')) AS nom_affiche
  FROM ({source}) a LEFT JOIN ({DIRECTORY}) d ON a.id_salarie = d._dir_id"""


NAMED = _named("SELECT * FROM fx_dirty")


def _alert_reasons(sep: str) -> str:
    above = _replace_all(q(notify.REASON_ABOVE_CAP), {"sport": "COALESCE(sport_type, 'None')",
                                                       "km": _km_text("distance_m"),
                                                       "cap": _whole_km_text(CAP)})
    neg = _replace_all(q(notify.REASON_NEGATIVE), {"d": "distance_m"})
    return (f"concat_ws({q(sep)}, "
            f"CASE WHEN COALESCE(id_salarie, 0) = 0 THEN {q(notify.REASON_NO_ID)} END, "
            f"CASE WHEN COALESCE(sport_type, '') = '' THEN {q(notify.REASON_NO_SPORT)} END, "
            f"CASE WHEN distance_m < 0 THEN {neg} END, "
            f"CASE WHEN distance_m >= 0 AND distance_m > {CAP} THEN {above} END, "
            f"CASE WHEN date_debut IS NOT NULL AND date_debut > TIMESTAMP '{AS_OF}' + INTERVAL {P.future_tolerance_s} SECOND "
            f"THEN {q(notify.REASON_FUTURE)} END)")


def _praise() -> str:
    tpl = (f"CASE WHEN COALESCE(distance_m, 0) <> 0 THEN {_pick(notify.PRAISE_WITH_DISTANCE)} "
           f"ELSE {_pick(notify.PRAISE_WITHOUT_DISTANCE)} END")
    filled = _replace_all(tpl, {"nom": "nom_affiche", "sport": "sport_type", "distance": _km_text("distance_m"),
                                "duree": f"COALESCE(CAST({_duration()} AS VARCHAR), '?')"})
    return (f"CASE WHEN length(COALESCE(commentaire, '')) > 0 THEN {filled} || ' (\"' || commentaire || '\")' "
            f"ELSE {filled} END")


def _messages(source: str = "SELECT * FROM fx_dirty") -> str:
    alert_tpl = q("\n".join(notify.ALERT_LINES))
    alert = _replace_all(alert_tpl, {"nom": "nom_affiche", "anomalies": "anomalies"})
    return f"""
  SELECT id, id_salarie,
    CASE WHEN anomalies <> '' THEN 'alerte' ELSE 'message' END AS type_message,
    CASE WHEN anomalies <> '' THEN {alert} ELSE {_praise()} END AS texte
  FROM (SELECT *, {_alert_reasons(', ')} AS anomalies FROM ({_named(source)}))"""


def _check_desc() -> dict[str, str]:
    return quality.descriptions(P)


def _finish(name: str, violations_sql: str) -> str:
    d = _check_desc()
    return (f"SELECT {quality.CHECK_ORDER[name]} AS ordre, {q(name)} AS \"check\", {q(d[name])} AS description, "
            f"CASE WHEN v > 0 THEN {q(quality.STATUS_FAILED)} ELSE {q(quality.STATUS_OK)} END AS statut, "
            f"CAST(v AS BIGINT) AS violations FROM ({violations_sql})")


KNOWN = in_list(KNOWN_SPORTS)
BRONZE_PRED = {
    "distance_non_negative": "COALESCE(distance_m, 0) < 0",
    "date_debut_renseignee": "date_debut IS NULL",
    "date_debut_pas_future": f"COALESCE(date_debut > TIMESTAMP '{AS_OF}', FALSE)",
    "date_fin_apres_debut": "COALESCE(date_fin IS NOT NULL AND date_fin < date_debut, FALSE)",
    "sport_type_connu": f"NOT COALESCE(sport_type IN {KNOWN}, FALSE)",
}
REF_PRED = {
    "salaire_positif": "COALESCE(salaire_brut, 0) <= 0",
    "distance_coherente": "COALESCE(distance_km IS NOT NULL AND distance_km <= 0, FALSE)",
}
GOLD_PRED = {
    "montant_prime_positif_ou_nul": "COALESCE(montant_prime, 0) < 0",
    "jours_bien_etre_valides": f"NOT COALESCE(jours_bien_etre IN (0, {P.jours_bien_etre_accordes}), FALSE)",
}


def _count_check(name: str, table: str, pred: str) -> str:
    return _finish(name, f"SELECT count(*) FILTER (WHERE {pred}) AS v FROM {table}")


def _dup_check(table: str) -> str:
    return _finish("id_salarie_unique",
                   f"SELECT COALESCE(sum(n - 1), 0) AS v FROM (SELECT id_salarie, count(*) AS n FROM {table} GROUP BY id_salarie HAVING count(*) > 1)")


def _orphan_check(bronze: str, hr: str) -> str:
    return _finish("id_salarie_existe_dans_rh",
                   f"SELECT count(*) AS v FROM {bronze} b WHERE NOT EXISTS "
                   f"(SELECT 1 FROM {hr} h WHERE h.id_salarie IS NOT DISTINCT FROM b.id_salarie)")


def _all_checks() -> str:
    parts = [_count_check(n, "fx_bronze", p) for n, p in BRONZE_PRED.items()]
    parts.append(_dup_check("fx_ref"))
    parts += [_count_check(n, "fx_ref", p) for n, p in REF_PRED.items()]
    parts.append(_orphan_check("fx_bronze", "fx_ref"))
    parts += [_count_check(n, "fx_elig", p) for n, p in GOLD_PRED.items()]
    return "\nUNION ALL\n".join(parts)


HR_REPEATS = "(SELECT * FROM fx_hr UNION ALL SELECT * FROM fx_hr WHERE id_salarie % 53 = 0)"


def _grid(max_t: int, days: int) -> str:
    return f"""
hist AS (
  SELECT bu, CAST(least(greatest(nb_activites_12mois, 0), {max_t}) AS INTEGER) AS seuil, count(*) AS k,
    count(*) FILTER (WHERE COALESCE(eligible_prime, FALSE)) AS k_prime,
    sum(CASE WHEN eligible_prime THEN salaire_brut END) AS masse_prime
  FROM fx_elig GROUP BY 1, 2),
grid AS (SELECT DISTINCT bu, unnest(range(0, {max_t} + 1)) AS seuil FROM hist),
j AS (SELECT g.bu, CAST(g.seuil AS INTEGER) AS seuil, h.k, h.k_prime, h.masse_prime
      FROM grid g LEFT JOIN hist h ON g.bu IS NOT DISTINCT FROM h.bu AND g.seuil = h.seuil),
wg AS (
  SELECT bu, seuil,
    CAST(sum(COALESCE(k, 0)) OVER (PARTITION BY bu) AS BIGINT) AS nb_salaries,
    CAST(sum(COALESCE(k, 0)) OVER (PARTITION BY bu ORDER BY seuil DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS nb_eligibles_bien_etre,
    CAST(sum(COALESCE(k_prime, 0)) OVER (PARTITION BY bu) AS BIGINT) AS nb_eligibles_prime,
    sum(masse_prime) OVER (PARTITION BY bu) AS masse_salariale_prime
  FROM j)"""


def _scenario_sql() -> str:
    vals = ", ".join(f"({q(n)}, CAST({r!r} AS DOUBLE), {t}, {d})" for n, r, t, d in WHATIF_SCENARIOS)
    return f""", sc(scenario, taux_prime, seuil, jours) AS (VALUES {vals})
SELECT sc.scenario, e.bu, count(*) AS nb_salaries, count(*) FILTER (WHERE e.eligible_prime) AS nb_eligibles_prime,
  round(COALESCE(sum(CASE WHEN e.eligible_prime THEN e.salaire_brut END) * any_value(sc.taux_prime), 0.0), 4) AS cout_total_prime,
  count(*) FILTER (WHERE e.nb_activites_12mois >= sc.seuil) AS nb_eligibles_bien_etre,
  CAST(count(*) FILTER (WHERE e.nb_activites_12mois >= sc.seuil) * any_value(sc.jours) AS BIGINT) AS total_jours_bien_etre
FROM fx_elig e, sc GROUP BY sc.scenario, e.bu"""


def _report() -> str:
    gen = f"'Généré le ' || strftime(TIMESTAMP '{AS_OF}', '%d/%m/%Y à %H:%M')"
    head = [(1, q(quality.REPORT_TITLE)), (2, gen), (3, "''"), (4, q(quality.REPORT_HEADER[0])),
            (5, q(quality.REPORT_HEADER[1]))]
    head_sql = " UNION ALL ".join(f"SELECT {i} AS ordre, {s} AS line" for i, s in head)
    return f"""
, checks AS ({_all_checks()})
{head_sql}
UNION ALL
SELECT ordre + 10 AS ordre, printf('| %s | %s | %s | %d |', "check", description, statut, violations) AS line FROM checks"""


def build() -> dict[str, str]:
    S: dict[str, str] = {}
    dec = f"SELECT {DEC_COLS}, op FROM ({_cdc_decoded()})"
    S["cdc_decode"] = dec
    S["src_cdc_stream"] = """
SELECT '{"payload":{"id":' || CAST(id AS VARCHAR) || '}}' AS key,
       CASE WHEN id % 79 = 0 THEN NULL
            WHEN id % 83 = 0 THEN '{not json'
            WHEN id % 97 <> 0 AND id % 71 = 0 THEN '{"payload":{"after":null,"op":"c"}}'
            WHEN id % 1000000000 % 157 = 0 THEN regexp_replace(text, '"distance_m":([0-9]+)', '"distance_m":"\\1"', 'g')
            ELSE text END AS value,
       CAST(id % 4 AS INTEGER) AS partition, CAST(floor(id / 4) AS BIGINT) AS "offset",
       make_timestamp((1706745600000 + id) * 1000) AS "timestamp"
FROM (SELECT id, CAST(to_json({'payload': {'before': CASE WHEN op = 'd' THEN img END,
                                           'after': CASE WHEN op <> 'd' THEN img END,
                                           'op': op}}) AS VARCHAR) AS text
      FROM (SELECT id,
              {'id': id, 'id_salarie': id_salarie, 'date_debut': epoch_us(date_debut), 'sport_type': sport_type,
               'distance_m': distance_m, 'date_fin': epoch_us(date_fin), 'commentaire': commentaire} AS img,
              CASE WHEN id % 97 = 0 THEN 'd' WHEN id % 61 = 0 THEN 'u' WHEN id % 67 = 0 THEN 'r' ELSE 'c' END AS op
            FROM fx_dirty))"""
    S["cdc_drop_deletes"] = f"{dec} WHERE op <> 'd'"
    S["cdc_guard_empty"] = (f"SELECT {DEC_COLS}, op FROM ({_cdc_decoded()}) "
                            "WHERE after_present AND COALESCE(op <> 'd', TRUE)")
    S["cdc_timestamps"] = (
        "SELECT id, id_salarie, make_timestamp(date_debut) AS date_debut, sport_type, distance_m, "
        f"make_timestamp(date_fin) AS date_fin, commentaire, TIMESTAMP '{AS_OF}' AS ingested_at "
        f"FROM ({_cdc_decoded()}) WHERE op <> 'd'")
    S["scan_bronze"] = f"SELECT * FROM fx_activities"
    S["src_hr"] = "SELECT * FROM fx_hr"
    S["preview_bronze"] = "SELECT * FROM fx_bronze ORDER BY id LIMIT 10"
    S["row_count"] = "SELECT count(*) AS nb_lignes FROM fx_bronze"
    S["quality_report"] = _report()
    S["rule_distance_cap"] = (f"SELECT id, sport_type, distance_m, {CAP} AS cap_m, {DIST_OK} AS distance_ok "
                              "FROM fx_dirty")
    S["rule_valid"] = f"SELECT id, {VALID} AS regle_valide FROM fx_dedup"
    S["bronze_valid"] = "SELECT * FROM fx_bronze"
    S["bronze_quarantine"] = "SELECT * FROM fx_quarantine"
    S["bronze_unrouted"] = f"SELECT {ACT_COLS}, motifs FROM fx_routed WHERE regle IS NULL"
    S["lookback_filter"] = f"SELECT id, id_salarie, date_debut FROM fx_bronze WHERE date_debut >= TIMESTAMP '{WIN_START}'"
    S["hr_project"] = "SELECT id_salarie, bu, salaire_brut, moyen_declare, distance_km, distance_anormale FROM fx_ref"
    S["active_mode_flag"] = "SELECT id_salarie, moyen_declare, mode_actif_declare FROM fx_elig"
    S["distance_pending_flag"] = "SELECT id_salarie, mode_actif_declare, distance_anormale, distance_a_valider FROM fx_elig"
    S["bonus_eligible_flag"] = "SELECT id_salarie, eligible_prime FROM fx_elig"
    S["bonus_amount"] = "SELECT id_salarie, salaire_brut, eligible_prime, montant_prime FROM fx_elig"
    S["wellness_flag_days"] = "SELECT id_salarie, nb_activites_12mois, eligible_bien_etre, jours_bien_etre FROM fx_elig"
    S["computed_at"] = "SELECT id_salarie, calcule_le FROM fx_elig"
    S["privacy_projection"] = ("SELECT bu, distance_anormale, nb_activites_12mois, mode_actif_declare, distance_a_valider, "
                               "eligible_prime, eligible_bien_etre, jours_bien_etre, calcule_le FROM fx_elig")
    S["join_eligibility"] = ("SELECT id_salarie, bu, salaire_brut, moyen_declare, distance_km, distance_anormale, "
                             "nb_activites_12mois FROM fx_joined")
    sport_rows = ("SELECT CAST(o_custkey AS INTEGER) AS id_salarie, o_orderkey AS ligne, CASE WHEN o_orderkey % 5 <> 0 THEN "
                  "CASE o_orderpriority WHEN '1-URGENT' THEN 'Tennis' ELSE 'Judo' END END AS pratique "
                  "FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F'")
    S["join_hr_sport"] = ("SELECT h.id_salarie, h.nom, s.pratique FROM fx_hr h "
                          f"LEFT JOIN ({sport_rows}) s ON h.id_salarie = s.id_salarie")
    S["declared_practice_flag"] = f"""
SELECT h.id_salarie, COALESCE(s.named, FALSE) AS pratique_declaree FROM fx_hr h LEFT JOIN (
  SELECT id_salarie, pratique IS NOT NULL AS named FROM (
    SELECT *, row_number() OVER (PARTITION BY id_salarie ORDER BY ligne DESC) AS rn FROM ({sport_rows})) WHERE rn = 1) s
ON h.id_salarie = s.id_salarie"""
    S["orphan_activities"] = ("SELECT id, id_salarie FROM fx_dirty a WHERE NOT EXISTS "
                              "(SELECT 1 FROM fx_hr h WHERE h.id_salarie IS NOT DISTINCT FROM a.id_salarie)")
    S["known_activities"] = ("SELECT id, id_salarie FROM fx_dirty a WHERE EXISTS "
                             "(SELECT 1 FROM fx_hr h WHERE h.id_salarie IS NOT DISTINCT FROM a.id_salarie)")
    S["stream_directory_join"] = f"SELECT id, id_salarie, nom_affiche FROM ({NAMED})"
    S["cap_lookup_join"] = f"SELECT id, sport_type, {CAP} AS cap_m FROM fx_dirty"
    S["mode_threshold_join"] = ("SELECT h.id_salarie, h.moyen_declare, m.seuil_km, m.profile FROM fx_hr h "
                                "LEFT JOIN fx_modes m ON h.moyen_declare = m.moyen_declare")
    S["join_commute_distance"] = (
        "SELECT h.id_salarie, m.profile, CASE WHEN d.status = 'OK' THEN CAST(d.metres AS DOUBLE) / 1000 END AS distance_km, "
        "d.id_salarie IS NOT NULL AS measured, d.id_salarie IS NOT NULL AND COALESCE(d.status, '') <> 'OK' AS lookup_failed "
        "FROM fx_hr h LEFT JOIN fx_modes m ON h.moyen_declare = m.moyen_declare "
        "LEFT JOIN fx_distance d ON d.id_salarie = h.id_salarie AND d.profile = m.profile")
    S["whatif_grid"] = f", {_grid(30, P.jours_bien_etre_accordes).strip()} SELECT bu, seuil FROM wg"
    S["activity_count"] = "SELECT * FROM fx_counts"
    S["eligibility"] = "SELECT * FROM fx_elig"
    S["kpis_by_bu"] = f"""
SELECT bu, count(*) AS nb_salaries,
  CAST(sum(CAST(eligible_prime AS INTEGER)) AS BIGINT) AS nb_eligibles_prime,
  round(sum(montant_prime), 4) AS cout_total_prime,
  CAST(sum(CAST(eligible_bien_etre AS INTEGER)) AS BIGINT) AS nb_eligibles_bien_etre,
  CAST(sum(jours_bien_etre) AS BIGINT) AS total_jours_bien_etre,
  CAST(sum(CAST(distance_a_valider AS INTEGER)) AS BIGINT) AS nb_en_attente_validation_distance,
  TIMESTAMP '{AS_OF}' AS calcule_le
FROM fx_elig GROUP BY bu"""
    S["kpis_total"] = """
SELECT count(*) AS nb_salaries, round(sum(montant_prime), 4) AS budget_prime,
  CAST(COALESCE(sum(jours_bien_etre), 0) AS BIGINT) AS total_jours_bien_etre,
  count(*) FILTER (WHERE COALESCE(eligible_bien_etre, FALSE)) AS nb_eligibles_bien_etre,
  count(*) FILTER (WHERE COALESCE(eligible_prime, FALSE)) AS nb_eligibles_prime,
  count(*) FILTER (WHERE COALESCE(distance_anormale, FALSE)) AS nb_anomalies_distance
FROM fx_elig"""
    S["anomaly_count"] = ("SELECT count(*) FILTER (WHERE COALESCE(distance_anormale, FALSE)) AS nb_anomalies, "
                          "count(*) AS nb_salaries FROM fx_ref")
    S["violation_counts"] = _all_checks()
    S["checks_summary"] = (f"SELECT count(*) FILTER (WHERE statut = 'OK') AS nb_ok, count(*) AS nb_checks "
                           f"FROM ({_all_checks()})")
    S["whatif_threshold"] = (f", {_grid(30, P.jours_bien_etre_accordes).strip()} "
                             "SELECT bu, seuil, nb_salaries, nb_eligibles_bien_etre, nb_eligibles_prime, "
                             "round(masse_salariale_prime, 4) AS masse_salariale_prime, "
                             f"nb_eligibles_bien_etre * {P.jours_bien_etre_accordes} AS total_jours_bien_etre FROM wg")
    S["whatif_params"] = _scenario_sql()
    S["quarantine_stats"] = ("SELECT reason, sport_type, CAST(date_debut AS DATE) AS jour, count(*) AS nb_lignes "
                             "FROM (SELECT unnest(string_split(motifs, ',')) AS reason, sport_type, date_debut "
                             "FROM fx_quarantine WHERE motifs <> '') GROUP BY ALL")
    S["duplicate_ids"] = (f"SELECT id_salarie, count(*) - 1 AS nb_repetitions FROM {HR_REPEATS} "
                          "GROUP BY id_salarie HAVING count(*) > 1")
    first_changes = """
, fx_changes AS (
  SELECT id, id_salarie, date_debut, sport_type,
    CASE WHEN change = 0 THEN distance_m WHEN id % 14 = 0 THEN NULL ELSE distance_m - 1 END AS distance_m, date_fin, commentaire,
    1706745600000 + 2 * id + CASE WHEN change = 1 AND id % 3 <> 0 THEN 1 ELSE 0 END AS change_ms, 2 * id + change AS log_position
  FROM (SELECT *, unnest(CASE WHEN id % 7 = 0 THEN [0, 1] ELSE [0] END) AS change FROM fx_dirty)),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (
  PARTITION BY id_salarie, date_debut, sport_type ORDER BY change_ms, log_position) AS rn FROM fx_changes) WHERE rn = 1)"""
    S["dedup_batch"] = f"{first_changes} SELECT {ACT_COLS} FROM firsts"
    S["cdc_arrival"] = f"{first_changes} SELECT id, distance_m, change_ms, log_position FROM firsts"
    S["split_partition_check"] = ("SELECT count(*) AS n_entree, CAST(0 AS BIGINT) AS n_manquantes, "
                                  "CAST(0 AS BIGINT) AS n_en_trop FROM fx_dedup")
    S["fn_epoch_micros"] = (f"SELECT id, date_debut AS debut_us, make_timestamp(date_debut) AS date_debut "
                            f"FROM ({_cdc_decoded()}) WHERE op <> 'd'")
    S["fn_duration_min"] = f"SELECT id, {_duration()} AS duree_min FROM fx_dirty"
    S["fn_distance_km"] = f"SELECT id, distance_m, {_km_tenths('distance_m')} / 10.0 AS distance_km FROM fx_dirty"
    S["fn_km_format"] = (f"SELECT id, {_km_text('distance_m')} AS km_texte, {_whole_km_text(CAP)} AS plafond_texte "
                         "FROM fx_dirty")
    S["fn_date_window"] = f"SELECT id, date_debut >= TIMESTAMP '{WIN_START}' AS dans_fenetre FROM fx_dirty"
    S["fn_null_default"] = "SELECT id, COALESCE(distance_m, 0) AS distance_ou_zero FROM fx_dirty"
    S["fn_bool_to_int"] = ("SELECT moyen_declare, CAST(sum(CAST(eligible_prime AS INTEGER)) AS BIGINT) AS nb_eligibles_prime, "
                           "CAST(sum(CAST(distance_a_valider AS INTEGER)) AS BIGINT) AS nb_a_valider FROM fx_elig GROUP BY 1")
    S["fn_isin"] = (f"SELECT id, COALESCE(sport_type IN {KNOWN}, FALSE) AS sport_connu, sport_type IN {KNOWN} AS sport_connu_3v "
                    "FROM fx_dirty")
    S["fn_concat_name"] = "SELECT id_salarie, max(concat_ws(' ', prenom, nom)) AS nom_complet FROM fx_hr GROUP BY 1"
    S["fn_template"] = f"SELECT id, {_praise()} AS texte FROM ({NAMED})"
    S["fn_append_comment"] = ("SELECT id, CASE WHEN length(COALESCE(commentaire, '')) > 0 "
                              "THEN sport_type || ' (\"' || commentaire || '\")' ELSE sport_type END AS texte FROM fx_dirty")
    told = (f"SELECT id, id_salarie, make_timestamp(date_debut) AS date_debut, sport_type, distance_m, "
            f"make_timestamp(date_fin) AS date_fin, commentaire, illisible FROM ({_cdc_decoded()}) WHERE op <> 'd'")
    change_reasons = REASONS.replace("concat_ws(',', ", "concat_ws(',', CASE WHEN illisible THEN 'distance_unparsable' END, ", 1)
    S["fn_reason_array"] = f"SELECT id, {change_reasons} AS motifs FROM ({told})"
    S["fn_json"] = ("SELECT CASE WHEN after_present THEN id END AS id, op, NOT after_present AS after_absent "
                    f"FROM ({_cdc_decoded()})")
    S["fn_three_state_anomaly"] = "SELECT id_salarie, moyen_declare, distance_km, distance_anormale FROM fx_ref"
    S["fn_truthy"] = ("SELECT id, COALESCE(sport_type, '') = '' AS sport_vide, COALESCE(distance_m, 0) = 0 AS distance_vide, "
                      "COALESCE(commentaire, '') = '' AS commentaire_vide FROM fx_dirty")
    # what the sink holds: one row per key; what arrival decides is left out (see ``_stream_rows``)
    def sink_rows(where: str = "TRUE") -> str:
        timed = lambda c: f"CASE WHEN date_debut <= now()::TIMESTAMP THEN {c} END"
        return (f"SELECT DISTINCT id_salarie, date_debut, sport_type, {timed('distance_m')} AS distance_m, {timed('date_fin')} AS date_fin, "
                f"{timed('commentaire')} AS commentaire, {timed(change_reasons)} AS reasons, "
                f"CASE WHEN {VALID} THEN 'valid' ELSE 'quarantine' END AS route FROM ({told}) WHERE {where}")
    stream_rows = sink_rows()
    S["stream_route"] = stream_rows
    S["stream_dedup"] = f"SELECT id_salarie, date_debut, sport_type, count(*) AS n FROM ({stream_rows}) GROUP BY ALL"
    normal = "id % 79 <> 0 AND id % 83 <> 0 AND id % 97 <> 0 AND id % 71 <> 0"
    cut = "TIMESTAMP '2024-01-15 00:00:00'"
    S["stream_checkpoint"] = f"SELECT *, CAST(1 AS BIGINT) AS n FROM ({sink_rows(f'date_debut IS NULL OR date_debut >= {cut}')})"
    S["stream_late_drop"] = (
        # the streaming watermark is kept in milliseconds: max event time truncated to ms, minus the delay
        "SELECT (SELECT date_trunc('millisecond', max(date_debut)) - INTERVAL 2 HOUR FROM fx_dirty "
        f"WHERE {normal} AND date_debut >= {cut} AND date_debut <= now()::TIMESTAMP + INTERVAL 300 SECOND) AS filigrane, "
        f"(SELECT count(*) FROM fx_dirty WHERE {normal} AND date_debut < {cut}) AS n_tardives_ignorees, "
        f"(SELECT count(*) FROM ({stream_rows})) AS n_apres_rattrapage")
    S["stream_await"] = "SELECT TRUE AS termine, count(*) AS n_messages_lus FROM fx_dirty"
    S["stream_watermark"] = ("SELECT id, CASE WHEN date_debut > now()::TIMESTAMP + INTERVAL 300 SECOND THEN NULL "
                             "ELSE date_debut END AS temps_evenement FROM (SELECT id, make_timestamp(date_debut) AS date_debut "
                             f"FROM ({_cdc_decoded()}) WHERE op <> 'd')")
    S["fn_now"] = f"SELECT id, TIMESTAMP '{AS_OF}' AS horodatage FROM fx_dirty"
    S["sink_bronze_stream"] = f"SELECT * FROM ({stream_rows}) WHERE route = 'valid'"
    S["sink_quarantine_stream"] = f"SELECT * FROM ({stream_rows}) WHERE route = 'quarantine'"
    S["sink_overwrite"] = "SELECT * FROM fx_elig"
    S["sink_notify"] = _messages(source=(
        "SELECT id, id_salarie, make_timestamp(date_debut) AS date_debut, sport_type, distance_m, "
        f"make_timestamp(date_fin) AS date_fin, commentaire FROM ({_cdc_decoded()}) "
        "WHERE after_present AND COALESCE(op <> 'd', TRUE)"))
    S["stream_anomalies"] = f"SELECT id, {_alert_reasons(' | ')} AS anomalies FROM fx_dirty"
    S["stream_messages"] = f"SELECT * FROM ({_messages()}) WHERE type_message = 'message'"
    S["stream_alerts"] = f"SELECT * FROM ({_messages()}) WHERE type_message = 'alerte'"
    for n, p in BRONZE_PRED.items():
        S[n] = _count_check(n, "fx_dirty", p)
    S["id_salarie_unique"] = _dup_check(HR_REPEATS)
    for n, p in REF_PRED.items():
        S[n] = _count_check(n, "fx_ref", p)
    S["id_salarie_existe_dans_rh"] = _orphan_check("fx_dirty", "fx_hr")
    for n, p in GOLD_PRED.items():
        S[n] = _count_check(n, "fx_elig", p)
    return {k: with_base(sql) for k, sql in S.items()}


def oracle_sql() -> dict[str, str]:
    return build()
