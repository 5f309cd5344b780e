"""Physical-plan properties: no Python in any plan, pushdown into the scan, one exchange per group-by."""

from __future__ import annotations

import contextlib
import datetime as dt
import io

import pytest

import __spark_entry__ as E
from vitalflow.operators import gold
from vitalflow.params import Params
from vitalflow.plans.catalog import QUERIES
from vitalflow.plans.medallion import Flow
from vitalflow.sources.tables import read_table, write_table

SF = "/root/testdata/sf0.001"
PY_NODES = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"]


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k != "stream_route"))
def test_no_python_in_plans(spark, key):
    text = plan(E.queries()[key](spark, SF), "extended")
    assert not any(n in text for n in PY_NODES), key


def test_bronze_scan_prunes_and_pushes(spark, tmp_dir):
    f = Flow(spark, SF)
    write_table(f.bronze, f"{tmp_dir}/bronze")
    counts = gold.count_activities(read_table(spark, f"{tmp_dir}/bronze"), Params(as_of=dt.datetime(2024, 1, 31),
                                                                                   lookback_days=7))
    text = plan(counts)
    assert "PushedFilters: [IsNotNull(date_debut), GreaterThanOrEqual(date_debut," in text
    assert "ReadSchema: struct<id_salarie:int,date_debut:timestamp_ntz>" in text


def test_kpis_from_written_table_one_exchange(spark, tmp_dir):
    f = Flow(spark, SF)
    write_table(f.eligibility, f"{tmp_dir}/elig")
    k = gold.kpis(read_table(spark, f"{tmp_dir}/elig"), f.params)
    text = plan(k)
    assert text.count("Exchange (") == 1 or text.count("Exchange") == 1
    assert "partial_sum" in text
    assert "salaire_brut" not in k.columns


def test_dedup_is_an_aggregate_not_a_window(spark):
    text = plan(E.queries()["dedup_batch"](spark, SF))
    assert "Window" not in text and "partial_min" in text


def test_split_check_deduplicates_once(spark):
    """The four uses of the deduplicated rows read a written table, and no part of the union aggregates whole rows."""
    text = plan(E.queries()["split_partition_check"](spark, SF), "simple")
    assert "partial_min" not in text
    assert text.rindex("partial_sum(_w") < text.index("Exchange hashpartitioning") < text.index("Union")


def test_gold_plan_skips_unused_sport_sheet(spark):
    """The sport sheet is unique per employee, so the gold plan never scans orders."""
    text = plan(E.queries()["kpis_by_bu"](spark, SF))
    assert "orders.parquet" not in text
    assert "orders.parquet" in plan(E.queries()["join_hr_sport"](spark, SF))


def test_lookback_prunes_day_partitions(spark, tmp_dir):
    """Bronze written by route and day: the look-back reads only the valid route and its days."""
    from vitalflow.plans.medallion import read_route, run_bronze_batch
    f = Flow(spark, SF)
    run_bronze_batch(f.landing, f.params, tmp_dir)
    bronze = read_route(spark, tmp_dir, "valid")
    counts = gold.count_activities(bronze, f.params)
    text = plan(counts)
    assert "PartitionFilters: [isnotnull(route" in text and "(jour" in text and "2024-01-24" in text
    expected = {r[0]: r[1] for r in gold.count_activities(f.bronze, f.params).collect()}
    assert {r[0]: r[1] for r in counts.collect()} == expected
    days = {r[0] for r in bronze.select("jour").distinct().collect()}
    assert len(days) >= 30


def test_orphan_join_reuses_employee_partitioning(spark):
    """The NULL-safe orphan join is keyed by one column, so it adds no exchange of its own."""
    from vitalflow.operators import quality
    f = Flow(spark, SF)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(quality.bronze_and_integrity(f.bronze, f.hr, f.params), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin [_k" in text
    assert "coalesce(id_salarie" not in text.split("SortMergeJoin")[1].split("\n")[0]
    assert text.count("Exchange hashpartitioning(_k") <= 1


SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "8"}


@pytest.mark.parametrize("name", ["with_name", "orphans", "known"])
def test_hot_employee_is_split(spark, name):
    """70 % of the activities belong to one employee: the join's hot partition is split."""
    from pyspark.sql import functions as F
    from vitalflow.operators import notify, quality
    from vitalflow.sources.tables import stored
    old = {k: spark.conf.get(k) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    try:
        hr = spark.range(3000).select(F.col("id").cast("int").alias("id_salarie"), F.lit("Ada").alias("prenom"), F.lit("L").alias("nom"))
        ev = spark.range(0, 60000, 1, 8).select("id", F.when(F.col("id") % 10 < 7, 5).otherwise(F.col("id") % 4000).cast("int").alias("id_salarie"))
        if name == "with_name":
            out = notify.with_name(ev, stored(notify.directory(hr), "directory"))
        else:
            out = getattr(quality, name)(ev, hr)
        rows = len(out.collect())
        assert rows == {"with_name": 60000, "orphans": 4500, "known": 55500}[name]
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_checks_scan_the_activities_once(spark):
    """The eleven checks and the look-back count read one written bronze table."""
    text = plan(QUERIES["violation_counts"](spark, SF), "simple")
    assert "events.parquet" not in text
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert sum("/bronze-" in line for line in scans) == 1
