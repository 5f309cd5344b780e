"""The medallion flow as composable DataFrames, plus the table-writing batch jobs.

``Flow`` wires fixtures -> bronze -> referential -> gold lazily; nothing is
collected. The ``run_*`` jobs write each layer and read it back, so a later
stage starts from a durable table (lineage cut, survives executor loss) and a
table used twice is computed once.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, gold, notify, quality, referential, routing
from ..params import TEST_PARAMS, Params
from ..schemas import modes_table
from ..session import scratch_path
from ..sources.cdc import write_records
from ..sources.fixtures import Fixtures
from ..sources.tables import read_table, stored, write_table


class Flow:
    """Lazy DataFrames of every layer over one scale-factor folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = TEST_PARAMS,
                 null_policy: str = "quarantine", failed_policy: str = "pending"):
        self.spark, self.params = spark, params
        self.fx = Fixtures(spark, sf_dir)
        self.null_policy, self.failed_policy = null_policy, failed_policy

    @cached_property
    def landing(self) -> DataFrame:
        """Decoded activity rows before deduplication (fx_dirty)."""
        return self.fx.dirty()

    @cached_property
    def deduplicated(self) -> DataFrame:
        return dedup.dedup_batch(self.landing)

    @cached_property
    def routed(self) -> routing.Routed:
        return routing.route(self.deduplicated, self.params, self.null_policy)

    @property
    def bronze(self) -> DataFrame:
        return self.routed.valid

    @property
    def quarantine(self) -> DataFrame:
        return self.routed.quarantine

    @cached_property
    def hr(self) -> DataFrame:
        return self.fx.hr()

    @cached_property
    def referential(self) -> DataFrame:
        return referential.build_referential(self.spark, self.hr, self.fx.distances(), sport=self.fx.sport(),
                                             modes=modes_table(self.spark), failed_policy=self.failed_policy)

    @cached_property
    def eligibility(self) -> DataFrame:
        return gold.eligibility(self.bronze, self.referential, self.params)

    # layers as written tables: used twice without computing them twice

    @cached_property
    def stored_bronze(self) -> DataFrame:
        return stored(self.bronze, "bronze")

    @cached_property
    def stored_referential(self) -> DataFrame:
        return stored(self.referential, "referential")

    @cached_property
    def stored_eligibility(self) -> DataFrame:
        return stored(gold.eligibility(self.stored_bronze, self.stored_referential, self.params), "eligibility")

    @cached_property
    def directory(self) -> DataFrame:
        """One row per employee, as a table (see ``notify.with_name``)."""
        return stored(notify.directory(self.hr), "directory")

    @cached_property
    def kpis(self) -> DataFrame:
        return gold.kpis(self.eligibility, self.params)


# --- batch jobs writing tables ------------------------------------------------

def run_bronze_batch(landing: DataFrame, params: Params, out_dir: str, null_policy: str = "quarantine") -> None:
    """Deduplicate and route in one pass; one write partitioned by route and day.

    Rows are clustered by (route, day) before the write so each task writes few
    files (``rebalance``: AQE splits a day that holds too many rows instead of
    giving it to one task); the day partitions let a look-back read only its days.
    """
    routed = routing.with_day(routing.with_route(dedup.dedup_batch(landing), params, null_policy))
    routed = routed.hint("rebalance", "route", routing.DAY)
    write_table(routed, f"{out_dir}/activities_routed", partition_by=["route", routing.DAY])


def read_route(spark: SparkSession, out_dir: str, route: str) -> DataFrame:
    """One route of the written table; the route filter prunes partitions."""
    return read_table(spark, f"{out_dir}/activities_routed").filter(F.col("route") == route).drop("route")


def _stream_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, under the shared checkpoint folder of the session."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def run_stream_ingest_once(spark: SparkSession, records: DataFrame, params: Params,
                           null_policy: str = "quarantine", progress: list | None = None) -> DataFrame:
    """Land change records, run the streaming ingest to completion (availableNow), and return the
    routed sink table."""
    sink, stats = run_stream_restarts(spark, [records], params, null_policy)
    if progress is not None:
        progress += stats
    return sink


def run_stream_restarts(spark: SparkSession, phases: list[DataFrame], params: Params,
                        null_policy: str = "quarantine", reconciled: bool = False) -> tuple[DataFrame, list[dict]]:
    """Run the streaming ingest once per phase on ONE checkpoint (a restart between phases).

    Each phase appends its change records to the landing folder and runs to
    completion (availableNow). Returns the sink table and, per run, the rows read, the
    watermark reached and the rows dropped as late. ``reconciled`` adds those afterwards.
    """
    from ..streaming.ingest import Totals, await_end, read_routes, reconcile, start_ingest
    root = _stream_folder(spark, "stream-ingest")
    stats = []
    for records in phases:
        write_records(records, f"{root}/landing", mode="append")
        with Totals(spark) as totals:
            q = start_ingest(spark, f"{root}/landing", f"{root}/routed", f"{root}/checkpoint", fmt="records",
                             params=params, null_policy=null_policy, available_now=True)
            await_end(q)
            stats.append({"active": q.isActive, **totals.of(q)})
    if reconciled:
        reconcile(spark, f"{root}/landing", f"{root}/routed", params=params, fmt="records", null_policy=null_policy)
    return read_routes(spark, f"{root}/routed"), stats


def run_stream_notifier_once(spark: SparkSession, records: DataFrame, directory: DataFrame | None,
                             tolerance_s: int = 300) -> DataFrame:
    """Land change records, run the streaming notifier to completion, return the messages table."""
    from ..streaming.ingest import await_end
    from ..streaming.notifier import read_messages, start_notifications
    root = _stream_folder(spark, "stream-notify")
    write_records(records, f"{root}/landing")
    q = start_notifications(spark, f"{root}/landing", directory, f"{root}/checkpoint", fmt="records",
                            out_root=f"{root}/messages", available_now=True, tolerance_s=tolerance_s)
    await_end(q)
    return read_messages(spark, f"{root}/messages")


def run_gold(spark: SparkSession, bronze: DataFrame | None, ref: DataFrame, params: Params, out_dir: str,
             counts: DataFrame | None = None) -> DataFrame:
    """Write the eligibility table, then KPIs from the written table (computed once).

    With ``counts`` (the look-back's activities per employee) bronze is not read.
    """
    write_table(gold.eligibility(bronze, ref, params, counts), f"{out_dir}/eligibilite")
    elig = read_table(spark, f"{out_dir}/eligibilite")
    write_table(gold.kpis(elig, params), f"{out_dir}/kpis_par_bu")
    return read_table(spark, f"{out_dir}/kpis_par_bu")


def run_quality(spark: SparkSession, bronze: DataFrame, ref: DataFrame, elig: DataFrame,
                params: Params, out_dir: str) -> DataFrame:
    """Run the 11 checks, write the result table and the markdown report."""
    checks = quality.run_checks(bronze, ref, elig, params)
    write_table(checks, f"{out_dir}/quality_checks")
    written = read_table(spark, f"{out_dir}/quality_checks")
    quality.write_report(quality.report_lines(written, params), f"{out_dir}/rapport_qualite")
    return written
