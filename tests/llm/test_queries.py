"""Each query on the smallest tables: against its SQL, and that plans of native ones have no Python."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from vitalflow.llm.registry import ORACLE, QUERIES

from .conftest import SF

NATIVE = ("op1_", "op4_", "op6_", "op8_", "op10_", "op13_")


def test_all_are_registered():
    assert [k.split("_")[0] for k in sorted(QUERIES, key=lambda k: int(k[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, llm_duck, key):
    df = QUERIES[key](spark, SF)
    rel = llm_duck.sql(ORACLE[key])
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in order)) for r in df.collect())
    at = [rel.columns.index(c) for c in order]
    assert got == sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k.startswith(NATIVE)))
def test_native_plans_have_no_python(spark, key):
    plan = QUERIES[key](spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
