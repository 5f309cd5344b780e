"""Property tests (hypothesis, few examples: each one runs Spark jobs)."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vitalflow.operators.dedup import dedup_batch
from vitalflow.operators.routing import route, split_check
from vitalflow.params import Params

SCHEMA = ("id long, id_salarie int, date_debut timestamp_ntz, sport_type string, distance_m int, "
          "date_fin timestamp_ntz, commentaire string")
AS_OF = dt.datetime(2024, 1, 31)
starts = st.sampled_from([None, dt.datetime(2024, 1, 10, 8), dt.datetime(2024, 1, 10, 9), dt.datetime(2999, 1, 1)])
row = st.tuples(st.sampled_from([None, 1, 2, 3]), starts,
                st.sampled_from([None, "", "Vélo", "Marche", "Tennis", "Course à pied"]),
                st.one_of(st.none(), st.integers(-5, 200_000)))
frames = st.lists(row, min_size=1, max_size=40)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def to_df(spark, rows):
    data = [(i, e, s, sp, d, None, None) for i, (e, s, sp, d) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


@SETTINGS
@given(frames)
def test_routes_partition_the_input(spark, rows):
    df = dedup_batch(to_df(spark, rows))
    r = route(df, Params(as_of=AS_OF), null_policy="drop")
    c = split_check(df, r).first()
    assert (c["n_manquantes"], c["n_en_trop"]) == (0, 0)
    assert c["n_entree"] == r.valid.count() + r.quarantine.count() + r.unrouted.count()


@SETTINGS
@given(frames)
def test_dedup_matches_pandas(spark, rows):
    data = [(i, e, s, sp, d) for i, (e, s, sp, d) in enumerate(rows)]
    pdf = pd.DataFrame(data, columns=["id", "id_salarie", "date_debut", "sport_type", "distance_m"])
    keys = ["id_salarie", "date_debut", "sport_type"]
    expected = set(pdf.sort_values("id").drop_duplicates(keys, keep="first")["id"])
    got = {r["id"] for r in dedup_batch(to_df(spark, rows)).select("id").collect()}
    assert got == expected
