"""Rule edge rows (FIXTURES.md §4) on literal frames."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitalflow.operators.dedup import dedup_batch, duplicate_count, duplicate_keys
from vitalflow.operators.routing import route, with_route
from vitalflow.params import Params

AS_OF = dt.datetime(2024, 1, 31)
PAST = dt.datetime(2024, 1, 10, 8, 0)
FUTURE = dt.datetime(2999, 1, 1)
SCHEMA = ("id long, id_salarie int, date_debut timestamp_ntz, sport_type string, distance_m int, "
          "date_fin timestamp_ntz, commentaire string")


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


CASES = [
    # (id_salarie, start, sport, distance) -> route with null_policy="drop"
    ((1, PAST, "Course à pied", None), "valid"),
    ((1, PAST, "Course à pied", 42000), "valid"),
    ((1, PAST, "Course à pied", 42001), "quarantine"),
    ((1, PAST, "Course à pied", -1), "quarantine"),
    ((1, PAST, "Randonnée", 15000), "quarantine"),
    ((1, PAST, "Triathlon", 20000), "quarantine"),
    ((1, PAST, "Marche", 25000), "valid"),
    ((1, PAST, "Vélo", 150000), "valid"),
    ((1, PAST, "Vélo", 150001), "quarantine"),
    ((1, PAST, "Tennis", 10000), "valid"),
    ((None, PAST, "Tennis", None), "quarantine"),
    ((1, PAST, None, None), "quarantine"),
    ((1, PAST, "", None), "valid"),
    ((1, FUTURE, "Tennis", None), "quarantine"),
    ((1, None, "Tennis", None), "unrouted"),
    ((None, None, "Tennis", None), "quarantine"),
    ((1, AS_OF, "Tennis", None), "valid"),
]


@pytest.mark.parametrize("case,expected", CASES)
def test_route_edges(spark, case, expected):
    emp, start, sport, dist = case
    df = rows(spark, [(7, emp, start, sport, dist, None, None)])
    got = with_route(df, Params(as_of=AS_OF), null_policy="drop").select("route").first()[0]
    assert got == expected
    default = with_route(df, Params(as_of=AS_OF)).select("route").first()[0]
    assert default == ("quarantine" if expected == "unrouted" else expected)


def test_reasons_agree_with_route(spark):
    data = [(i, c[0][0], c[0][1], c[0][2], c[0][3], None, None) for i, c in enumerate(CASES)]
    out = with_route(rows(spark, data), Params(as_of=AS_OF), "drop").collect()
    for r in out:
        assert (r["route"] == "valid") == (len(r["reasons"]) == 0)


def test_route_split_is_a_partition(spark):
    data = [(i, c[0][0], c[0][1], c[0][2], c[0][3], None, None) for i, c in enumerate(CASES)]
    df = rows(spark, data)
    r = route(df, Params(as_of=AS_OF), "drop")
    assert r.valid.count() + r.quarantine.count() + r.unrouted.count() == len(CASES)
    r2 = route(df, Params(as_of=AS_OF))
    assert r2.unrouted.count() == 0
    assert r2.valid.count() + r2.quarantine.count() == len(CASES)


def test_dedup_lowest_id_wins_and_null_keys_group(spark):
    data = [
        (5, 1, PAST, "Tennis", 100, None, "b"),
        (3, 1, PAST, "Tennis", 200, None, "a"),
        (9, 1, None, "Tennis", 1, None, None),
        (8, 1, None, "Tennis", 2, None, None),
        (4, 2, PAST, "Tennis", 300, None, None),
    ]
    out = {r["id"]: r for r in dedup_batch(rows(spark, data)).collect()}
    assert set(out) == {3, 8, 4}
    assert out[3]["distance_m"] == 200 and out[3]["commentaire"] == "a"


def test_dedup_hot_key(spark):
    """A key holding most rows collapses to one row (partial aggregation, no window)."""
    hot = [(i, 1, PAST, "Tennis", i, None, None) for i in range(5000, 2000, -1)]
    cold = [(i, 2, PAST, "Vélo", i, None, None) for i in range(10)]
    df = rows(spark, hot + cold).repartition(8)
    out = dedup_batch(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    got = sorted((r["id_salarie"], r["id"]) for r in out.collect())
    assert got == [(1, 2001), (2, 0)]


def test_pandas_duplicated_semantics(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (2,), (None,), (None,)], "id_salarie int")
    assert duplicate_count(df).first()["violations"] == 3
    assert sorted((r[0], r[1]) for r in duplicate_keys(df).collect() if r[0] is not None) == [(2, 2)]


def test_lookback_boundary(spark):
    from vitalflow.operators.gold import count_activities
    p = Params(as_of=AS_OF, lookback_days=7)
    data = [(1, 1, dt.datetime(2024, 1, 24, 0, 0), "Tennis", None, None, None),
            (2, 1, dt.datetime(2024, 1, 23, 23, 59, 59), "Tennis", None, None, None),
            (3, 2, dt.datetime(2024, 1, 30), "Tennis", None, None, None)]
    got = dict(count_activities(rows(spark, data), p).collect())
    assert got == {1: 1, 2: 1}


def test_time_types_ltz(spark):
    """The same rule on TIMESTAMP (instant) columns, as produced by the CDC decoder."""
    df = rows(spark, [(1, 1, PAST, "Tennis", None, None, None), (2, 1, FUTURE, "Tennis", None, None, None)])
    df = df.withColumn("date_debut", F.col("date_debut").cast("timestamp"))
    got = dict(with_route(df, Params(as_of=AS_OF)).select("id", "route").collect())
    assert got == {1: "valid", 2: "quarantine"}


def test_clock_instant_ignores_session_zone(spark):
    from vitalflow.functions.time import clock
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        micros = spark.range(1).select(F.unix_micros(clock(AS_OF, "timestamp"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert micros == 1706659200000000  # 2024-01-31T00:00:00Z
