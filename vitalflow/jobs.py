"""Command-line jobs: the pipeline's runs as ``spark-submit`` / ``python -m vitalflow.jobs <job>``.

    ingest       CDC change stream -> bronze / quarantine sink (one streaming query)
    compact      a sink's batch folders -> one folder per route and day, in place
    reconcile    landed change events -> appends to the sink what the watermark dropped as late
    referential  HR sheet (+ sport sheet) + measured distances -> referential table
    gold         bronze + referential + parameters -> eligibility and KPI tables
    whatif       eligibility -> threshold grid table (dashboard sliders)
    quality      bronze + referential + eligibility -> 11 checks table + markdown report
    notify       CDC change stream -> messages table (streaming, latest offsets for Kafka)
    preview      first rows and row count of a table

Every job reads and writes lake tables (parquet by default); the session comes
from ``spark-submit`` (or a local one when run directly). Paths may be on any
file system the cluster can reach.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import gold, quality, referential, whatif
from .params import Params, load_params
from .schemas import modes_table
from .sources.tables import LAKE_FORMAT, preview, read_distances, read_hr, read_table, write_table
from .streaming.ingest import SINK_KEYS, await_end, compact, read_day_counts, read_routes, reconcile, start_ingest
from .streaming.notifier import start_notifications


def _session(args) -> SparkSession:
    from .session import build_session
    return build_session(args.master, app=f"vitalflow-{args.job}")


def _params(spark: SparkSession, args) -> Params:
    as_of = dt.datetime.fromisoformat(args.as_of) if getattr(args, "as_of", None) else None
    extra = {"as_of": as_of}
    if getattr(args, "lookback_days", None):
        extra["lookback_days"] = args.lookback_days
    if getattr(args, "params", None):
        return load_params(spark, args.params, **extra)
    return Params(**extra)


def _bronze(spark: SparkSession, path: str) -> DataFrame:
    """The valid route of the ingest sink (drops the sink's bookkeeping columns)."""
    return read_routes(spark, path, "valid").drop("route", *SINK_KEYS, "reasons", "ingested_at")  # keeps ``jour``


def job_ingest(spark, args) -> None:
    q = start_ingest(spark, args.source, args.out, args.checkpoint, params=_params(spark, args), fmt=args.format,
                     topic=args.topic, bootstrap=args.bootstrap, delay=args.watermark,
                     gate_future=not args.no_future_gate, null_policy=args.null_policy, unreadable_policy=args.unreadable_policy,
                     max_files_per_trigger=args.max_files_per_trigger,
                     max_offsets_per_trigger=args.max_offsets_per_trigger, available_now=args.available_now)
    await_end(q)


def job_compact(spark, args) -> None:
    compact(spark, args.sink)


def job_reconcile(spark, args) -> None:
    n = reconcile(spark, args.source, args.sink, params=_params(spark, args), fmt=args.format, null_policy=args.null_policy,
                  unreadable_policy=args.unreadable_policy)
    print(f"{n} late row(s) added")


def job_referential(spark, args) -> None:
    hr, sport = read_hr(spark, args.hr, args.sport, args.sheet_format)
    distances = read_distances(spark, args.distances) if args.distances else None
    ref = referential.build_referential(spark, hr, distances, sport=sport,
                                        modes=modes_table(spark), failed_policy=args.failed_policy)
    write_table(ref, args.out)
    written = read_table(spark, args.out)
    n = referential.anomaly_count(written).first()
    print(f"{n['nb_salaries']} employees, {n['nb_anomalies']} inconsistent declaration(s)")


def job_gold(spark, args) -> None:
    from .plans.medallion import run_gold
    p = _params(spark, args)
    # the sink keeps its activities counted per day: the look-back is a sum over these, not a scan of the rows
    counts = gold.count_from_days(read_day_counts(spark, args.bronze), p)
    kpis = run_gold(spark, None, read_table(spark, args.referential), p, args.out, counts)
    kpis.show(truncate=False)


def job_whatif(spark, args) -> None:
    """Threshold grid; with ``--scenarios`` also KPIs per named (rate, threshold, days) scenario."""
    elig = read_table(spark, f"{args.gold}/eligibilite")
    write_table(whatif.threshold_grid(elig, args.max_threshold, params=_params(spark, args)), f"{args.out}/seuils")
    if args.scenarios:
        scen = (spark.read.schema("scenario string, taux_prime double, seuil int, jours int")
                .option("multiLine", True).json(args.scenarios))
        write_table(whatif.scenario_kpis(elig, scen), f"{args.out}/scenarios")


def job_quality(spark, args) -> None:
    from .plans.medallion import run_quality
    p = _params(spark, args)
    checks = run_quality(spark, _bronze(spark, args.bronze), read_table(spark, args.referential),
                         read_table(spark, f"{args.gold}/eligibilite"), p, args.out)
    s = quality.summary(checks).first()
    print(f"{s['nb_ok']}/{s['nb_checks']} checks passed")


def job_notify(spark, args) -> None:
    q = start_notifications(spark, args.source, args.referential, args.checkpoint, out_root=args.out, fmt=args.format,
                            topic=args.topic, bootstrap=args.bootstrap, available_now=args.available_now,
                            max_offsets_per_trigger=args.max_offsets_per_trigger)
    await_end(q)


def job_preview(spark, args) -> None:
    df = read_table(spark, args.table, fmt=args.format)
    preview(df, args.n, order_by="id" if "id" in df.columns else None).show(truncate=False)
    print(f"total rows: {df.agg(F.count(F.lit(1))).first()[0]}")


JOBS = {"ingest": job_ingest, "compact": job_compact, "reconcile": job_reconcile,
        "referential": job_referential, "gold": job_gold, "whatif": job_whatif,
        "quality": job_quality, "notify": job_notify, "preview": job_preview}


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="vitalflow.jobs", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--master", default=None, help="only when not launched by spark-submit")
    sub = ap.add_subparsers(dest="job", required=True)

    def stream_args(p):
        p.add_argument("--source", required=True, help="folder of JSON lines or of records, or ignored with --format kafka")
        p.add_argument("--format", default="text", choices=["text", "records", "kafka"])
        p.add_argument("--topic")
        p.add_argument("--bootstrap")
        p.add_argument("--out", required=True)
        p.add_argument("--checkpoint", required=True)
        p.add_argument("--max-offsets-per-trigger", type=int, help="Kafka: bound of a micro-batch")
        p.add_argument("--available-now", action="store_true", help="process what is there, then stop")

    def param_args(p):
        p.add_argument("--params", help="JSON document with taux_prime, seuil_activites_bien_etre, ...")
        p.add_argument("--as-of", help="clock for reproducible runs, e.g. 2024-01-31T00:00:00")
        p.add_argument("--lookback-days", type=int)

    def policy_args(p):
        p.add_argument("--null-policy", default="quarantine", choices=["quarantine", "drop"])
        p.add_argument("--unreadable-policy", default="flag", choices=["flag", "quarantine"],
                       help="a distance that is no integer: a reason only, or quarantine")

    p = sub.add_parser("ingest")
    stream_args(p)
    param_args(p)
    p.add_argument("--watermark", default="2 hours")
    p.add_argument("--no-future-gate", action="store_true")
    policy_args(p)
    p.add_argument("--max-files-per-trigger", type=int)

    p = sub.add_parser("compact")
    p.add_argument("--sink", required=True, help="ingest sink folder")

    p = sub.add_parser("reconcile")
    p.add_argument("--source", required=True, help="the folder that the ingest reads")
    p.add_argument("--format", default="text", choices=["text", "records"])
    p.add_argument("--sink", required=True, help="ingest sink folder")
    param_args(p)
    policy_args(p)

    p = sub.add_parser("referential")
    p.add_argument("--hr", required=True)
    p.add_argument("--sport")
    p.add_argument("--sheet-format", choices=["csv", "parquet"], help="default: by extension, else csv")
    p.add_argument("--distances", help="measured distances table (parquet); without it active modes are pending")
    p.add_argument("--failed-policy", default="pending", choices=["pending", "accept"])
    p.add_argument("--out", required=True)

    p = sub.add_parser("gold")
    p.add_argument("--bronze", required=True, help="ingest sink folder")
    p.add_argument("--referential", required=True)
    p.add_argument("--out", required=True)
    param_args(p)

    p = sub.add_parser("whatif")
    p.add_argument("--gold", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--max-threshold", type=int, default=30)
    p.add_argument("--scenarios", help="JSON list of {scenario, taux_prime, seuil, jours}")
    param_args(p)

    p = sub.add_parser("quality")
    p.add_argument("--bronze", required=True)
    p.add_argument("--referential", required=True)
    p.add_argument("--gold", required=True)
    p.add_argument("--out", required=True)
    param_args(p)

    p = sub.add_parser("notify")
    stream_args(p)
    p.add_argument("--referential")

    p = sub.add_parser("preview")
    p.add_argument("--table", required=True)
    p.add_argument("--format", default=LAKE_FORMAT)
    p.add_argument("-n", type=int, default=10)
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or _session(args)
    JOBS[args.job](spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
