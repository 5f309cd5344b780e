"""Test inputs derived from the given tables (see FIXTURES.md).

The reference ships no input data, so the activity log, the HR sheet, the
measured distances and the declared-sport sheet are derived from the
``events``, ``customer`` and ``orders`` tables by fixed formulas. Every
derivation is a plain projection/filter, so its cost grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SOURCE_SCHEMAS
from .cdc import JSON_OPTIONS, envelope_json


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the ones the fixtures use are read with their declared schema."""
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- Fixed values of the fixture formulas ------------------------------------
SPORT_BY_EVENT_TYPE = [("click", "Course à pied"), ("view", "Marche"), ("purchase", "Vélo"), ("error", "Randonnée")]
SPORT_OTHER = "Tennis"
COMMENT = "Reprise du sport :)"
MODE_BY_NATION_MOD4 = ["Marche/running", "Vélo/Trottinette/Autres", "Transports en commun",
                       "véhicule thermique/électrique"]
FIRST_NAME = "Ada"
SPORT_BY_PRIORITY = [("1-URGENT", "Tennis"), ("2-HIGH", "Judo")]
FAR_FUTURE = "2999-01-01 00:00:00"
CHANGES_FROM_MS = 1_706_745_600_000   # 2024-02-01, when the change records begin
# --- end of fixed values ------------------------------------------------------


def sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def sql_case(expr: str, pairs, other) -> str:
    """``CASE expr WHEN k THEN v ... ELSE other END`` as SQL text (a NULL ``expr`` takes ELSE)."""
    whens = " ".join(f"WHEN {sql_str(k) if isinstance(k, str) else k} THEN {sql_str(v)}" for k, v in pairs)
    return f"CASE {expr} {whens} ELSE {sql_str(other)} END"


# The formulas are SQL expressions (as FIXTURES.md states them): one analysed
# projection per step instead of hundreds of Column objects built in Python.

def activities(events: DataFrame) -> DataFrame:
    """fx_activities: one clean activity per event."""
    return events.selectExpr(
        "event_id AS id",
        "CAST(user_id AS INT) AS id_salarie",
        "ts AS date_debut",
        f"{sql_case('event_type', SPORT_BY_EVENT_TYPE, SPORT_OTHER)} AS sport_type",
        "CASE WHEN event_type = 'signup' THEN CAST(NULL AS INT) ELSE CAST(floor(value * 100) AS INT) END AS distance_m",
        "timestampadd(MINUTE, CAST(get_json_object(props, '$.k') AS INT), ts) AS date_fin",
        f"CASE WHEN event_id % 8 = 0 THEN {sql_str(COMMENT)} END AS commentaire",
    )


def faulty(act: DataFrame) -> DataFrame:
    """fx_faulty: planted faults, chosen by id residues."""
    return act.selectExpr(
        "id",
        "CASE WHEN id % 113 = 0 THEN NULL WHEN id % 131 = 0 THEN id_salarie + 10000000 ELSE id_salarie END AS id_salarie",
        f"CASE WHEN id % 103 = 0 THEN NULL WHEN id % 107 = 0 THEN TIMESTAMP_NTZ '{FAR_FUTURE}' "
        "ELSE date_debut END AS date_debut",
        "CASE WHEN id % 127 = 0 THEN NULL WHEN id % 137 = 0 THEN 'Curling' ELSE sport_type END AS sport_type",
        "CASE WHEN id % 101 = 0 THEN -1 ELSE distance_m END AS distance_m",
        "CASE WHEN id % 109 = 0 THEN timestampadd(HOUR, -1, date_debut) ELSE date_fin END AS date_fin",
        "commentaire",
    )


def dirty(flt: DataFrame) -> DataFrame:
    """fx_dirty: faults plus exact repeats of some rows under a new id.

    One scan: each row is emitted once, or twice (second copy under id + 10^9)
    when planted as a repeat, by exploding its id offsets; same rows as a
    UNION ALL of the table with its repeats, without reading the source twice.
    """
    offsets = "explode(CASE WHEN id % 89 = 0 THEN array(0L, 1000000000L) ELSE array(0L) END) AS _off"
    return (flt.selectExpr("*", offsets)
            .selectExpr("id + _off AS id", *flt.columns[1:]))


def hr_sheet(customer: DataFrame) -> DataFrame:
    """HR sheet with its delivered headers, derived from ``customer``."""
    mode = sql_case("pmod(c_nationkey, 4)", list(enumerate(MODE_BY_NATION_MOD4[:3])), MODE_BY_NATION_MOD4[3])
    return customer.selectExpr(
        "CAST(c_custkey AS INT) AS `ID salarié`",
        f"CASE WHEN c_custkey % 3 <> 0 THEN {sql_str(FIRST_NAME)} END AS `Prénom`",
        "c_name AS `Nom`",
        "c_mktsegment AS `BU`",
        "c_acctbal AS `Salaire brut`",
        f"{mode} AS `Moyen de déplacement`",
        "concat('Nation ', CAST(c_nationkey AS STRING)) AS `Adresse du domicile`",
    )


def hr(customer: DataFrame) -> DataFrame:
    """fx_hr: the HR sheet under snake_case names."""
    from .tables import rename_hr
    return rename_hr(hr_sheet(customer))


def hr_with_repeats(hr_df: DataFrame) -> DataFrame:
    """HR with planted repeated ids (every id divisible by 53 twice)."""
    return hr_df.unionByName(hr_df.filter(F.col("id_salarie") % 53 == 0))


def distances(hr_df: DataFrame) -> DataFrame:
    """fx_distance: measured commutes; no row = not measured, NOT_FOUND = failed look-up.

    Every id divisible by 7 has an older measurement too, 100 km farther.
    """
    now = (hr_df.filter("moyen_declare IN ('Marche/running', 'Vélo/Trottinette/Autres') AND id_salarie % 11 <> 0")
            .selectExpr("id_salarie",
                        "CASE WHEN moyen_declare = 'Marche/running' THEN 'walking' ELSE 'bicycling' END AS profile",
                        "CAST(pmod(CAST(id_salarie AS BIGINT) * 37, 400) * 100 AS INT) AS metres",
                        "CASE WHEN id_salarie % 13 = 0 THEN 'NOT_FOUND' ELSE 'OK' END AS status"))
    years = "explode(CASE WHEN id_salarie % 7 = 0 THEN array(2023, 2022) ELSE array(2023) END) AS _year"
    return now.selectExpr("*", years).selectExpr(
        "id_salarie", "profile", "CASE _year WHEN 2022 THEN metres + 100000 ELSE metres END AS metres",
        "CASE _year WHEN 2022 THEN 'OK' ELSE status END AS status",
        "make_timestamp_ntz(_year, 6, 1, 0, 0, 0) AS measured_at")


def sport_sheet(orders: DataFrame) -> DataFrame:
    """fx_sport: declared practices, one row per customer and priority of an urgent or high fulfilled order."""
    sport = sql_case("o_orderpriority", SPORT_BY_PRIORITY[:1], SPORT_BY_PRIORITY[1][1])
    return (orders.filter("o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F'")
            .selectExpr("CAST(o_custkey AS INT) AS id_salarie", f"{sport} AS pratique")
            .distinct())


def sport_rows(orders: DataFrame) -> DataFrame:
    """fx_sport_rows: the sheet with its row order, a row per urgent or high fulfilled order, blank for every fifth order."""
    sport = sql_case("o_orderpriority", SPORT_BY_PRIORITY[:1], SPORT_BY_PRIORITY[1][1])
    return (orders.filter("o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F'")
            .selectExpr("CAST(o_custkey AS INT) AS id_salarie",
                        f"CASE WHEN o_orderkey % 5 <> 0 THEN {sport} END AS pratique", "o_orderkey AS ligne"))


TWINS_APART = 1_000_000_000                      # a planted repeat's id is that much higher
UNREADABLE_DISTANCE = r'"distance_m":([0-9]+)'   # planted: the number as a text


def _envelopes(op: Column) -> Column:
    """The envelope text with its planted faults by id residue (see ``cdc_records``)."""
    i = F.col("id")
    null_after = F.to_json(F.struct(F.struct(F.lit(None).cast("string").alias("after"),
                                             F.lit("c").alias("op")).alias("payload")), JSON_OPTIONS)
    text = envelope_json(op)
    return (F.when(i % 79 == 0, F.lit(None).cast("string"))
            .when(i % 83 == 0, F.lit("{not json"))
            .when((i % 97 != 0) & (i % 71 == 0), null_after)
            .when(i % TWINS_APART % 157 == 0, F.regexp_replace(text, UNREADABLE_DISTANCE, '"distance_m":"$1"'))
            .otherwise(text))


def cdc_records(dirty_df: DataFrame) -> DataFrame:
    """The change stream as keyed records, with planted envelope faults by id residue.

    id%79 tombstone (no value) | id%83 garbage text | id%97 delete |
    id%71 create with NULL ``after`` | id%10^9%157 distance as text (a row and its twin alike) | else update (id%61), snapshot (id%67) or create.
    Four partitions by id; the offset and the record's time grow with the id.
    """
    i = F.col("id")
    op = (F.when(i % 97 == 0, F.lit("d")).when(i % 61 == 0, F.lit("u"))
          .when(i % 67 == 0, F.lit("r")).otherwise(F.lit("c")))
    return dirty_df.select(
        F.to_json(F.struct(F.struct(i.alias("id")).alias("payload"))).alias("key"),
        _envelopes(op).alias("value"),
        (i % 4).cast("int").alias("partition"), F.floor(i / 4).cast("bigint").alias("offset"),
        F.timestamp_millis(F.lit(CHANGES_FROM_MS) + i).alias("timestamp"))


def changes(dirty_df: DataFrame) -> DataFrame:
    """fx_changes: the activity images with their change's kind, time and place; every id divisible by 7 is changed once.

    The later image of such an id has another distance (NULL for id%14, else 1 m less), so only the order tells which came
    first. Every third change shares its time with the one before, and the place in the log decides.
    """
    numbers = F.explode(F.when(F.col("id") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_change")
    later = F.col("_change") == 1
    i = F.col("id")
    metres = F.when(later, F.when(i % 14 == 0, F.lit(None)).otherwise(F.col("distance_m") - 1)).otherwise(F.col("distance_m"))
    return dirty_df.select("*", numbers).select(
        *[metres.cast("int").alias(c) if c == "distance_m" else F.col(c) for c in dirty_df.columns],
        F.when(later, F.lit("u")).otherwise(F.lit("c")).alias("op"),
        (F.lit(CHANGES_FROM_MS) + i * 2 + F.when(later & (i % 3 != 0), 1).otherwise(0)).alias("change_ms"),
        (i * 2 + F.col("_change")).alias("log_position"))


def change_envelopes(changed: DataFrame) -> DataFrame:
    """``changes`` as envelopes that tell time and place."""
    return changed.select(envelope_json(F.col("op"), ts_ms=F.col("change_ms"), lsn=F.col("log_position")).alias("value"))


class Fixtures:
    """Lazily built fixture DataFrames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._hr: DataFrame | None = None
        self._dirty: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        """One scan definition per table (the file listing is done once per Fixtures)."""
        if name not in self._tables:
            self._tables[name] = table(self.spark, self.sf_dir, name)
        return self._tables[name]

    def activities(self) -> DataFrame:
        return activities(self.table("events"))

    def faulty(self) -> DataFrame:
        return faulty(self.activities())

    def dirty(self) -> DataFrame:
        if self._dirty is None:
            self._dirty = dirty(self.faulty())
        return self._dirty

    def hr_sheet(self) -> DataFrame:
        return hr_sheet(self.table("customer"))

    def hr(self) -> DataFrame:
        if self._hr is None:
            self._hr = hr(self.table("customer"))
        return self._hr

    def distances(self) -> DataFrame:
        return distances(self.hr())

    def sport(self) -> DataFrame:
        return sport_sheet(self.table("orders"))

    def sport_rows(self) -> DataFrame:
        return sport_rows(self.table("orders"))

    def cdc(self) -> DataFrame:
        return cdc_records(self.dirty())

    def changes(self) -> DataFrame:
        return changes(self.dirty())
