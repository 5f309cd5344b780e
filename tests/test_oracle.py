"""Every registered query against its DuckDB twin on the smallest test tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from vitalflow.plans.catalog import QUERIES  # noqa: E402
from oracle_check import canon  # noqa: E402

from .conftest import SF_SMALL  # noqa: E402

SQL = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}
KEYS = sorted(QUERIES)  # the text operators have tests of their own
SPARK_TYPES = {"int": "int32", "bigint": "int64", "double": "double", "string": "string", "boolean": "bool",
               "timestamp_ntz": "ts", "timestamp": "ts", "date": "date"}
DUCK_TYPES = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "bool",
              "TIMESTAMP": "ts", "DATE": "date"}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    if key not in SQL:
        assert len(rows) > 0
        return
    rel = duck.sql(SQL[key])
    ocols = rel.columns
    assert sorted(cols) == sorted(ocols)
    types = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    otypes = {n: DUCK_TYPES.get(str(t), str(t)) for n, t in zip(ocols, rel.types)}
    assert types == otypes
    assert canon(cols, rows) == canon(ocols, rel.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert "cout_total_prime" in df.columns


def test_every_survey_key_has_sql_or_is_documented():
    # keys without SQL get the weaker rows-only check; keep that list explicit
    assert sorted(set(QUERIES) - set(SQL)) == []


def test_expected_figures_sf001(spark):
    """Published fixture figures (FIXTURES.md) at sf0.01."""
    from vitalflow.plans.medallion import Flow
    from vitalflow.operators.routing import with_route
    f = Flow(spark, "/root/testdata/sf0.01")
    assert f.landing.count() == 10113
    assert f.deduplicated.count() == 9992
    routes = dict(with_route(f.deduplicated, f.params, "drop").groupBy("route").count().collect())
    assert routes == {"valid": 9273, "quarantine": 628, "unrouted": 91}
    k = {r["bu"]: r for r in f.kpis.collect()}
    assert (k["AUTOMOBILE"]["nb_salaries"], k["AUTOMOBILE"]["nb_eligibles_prime"]) == (298, 50)
    assert round(k["AUTOMOBILE"]["cout_total_prime"], 2) == 12625.62
    assert (k["BUILDING"]["nb_eligibles_bien_etre"], k["BUILDING"]["total_jours_bien_etre"]) == (21, 105)
    assert k["MACHINERY"]["nb_en_attente_validation_distance"] == 30
