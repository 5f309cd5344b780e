"""CDC ingestion as ONE streaming query over one read of the source.

decode -> event time (the start; none if it is missing or far in the future) -> watermark -> dedup by
key -> foreachBatch that routes every row and writes the micro-batch once, into a folder named
after the query and the batch, and then lists it in the sink's log. Readers see listed folders only,
so a half-written batch is invisible, and a retry of a listed one changes nothing. A new checkpoint
is a new query with folders of its own. Every row has exactly one route (two queries, one per
route, would have two clocks and two states).
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators import gold
from ..operators.cdc import decode_changes
from ..operators.dedup import DEDUP_KEYS, dedup_batch
from ..operators.routing import DAY, VALID, with_day, with_route
from ..params import Params
from ..sources import versions
from ..sources.cdc import ARRIVAL, read_cdc_stream
from ..sources.files import remove

EVENT_TIME = "_event_time"
SINK_FORMAT = "parquet"
SINK_SCHEMA = ("id bigint, id_salarie int, date_debut timestamp, sport_type string, distance_m int, date_fin timestamp, "
               "commentaire string, ingested_at timestamp, reasons string, query string, batch_id bigint, "
               f"route string, {DAY} date")
SINK_KEYS = ("query", "batch_id")   # where a row was written, not part of the activity
COUNTS_SCHEMA = "id_salarie int, jour date, nb bigint, query string, batch_id bigint"
COUNTS_PER_FILE = 1_000_000   # day counts in a file at most, about
REMEMBER = "30 days"   # how long the key of a row without event time is remembered after its arrival


def with_watermark(df: DataFrame, delay: str = "2 hours", col: str = "date_debut",
                   gate_future_s: int | None = None) -> DataFrame:
    """Add the event-time column and its watermark.

    The watermark needs a TIMESTAMP column, so a TIMESTAMP_NTZ start is cast.
    With ``gate_future_s`` a start later than now + that many seconds gets a
    NULL event time: it cannot push the watermark (a year-3000 row would
    otherwise make every later row "late"); the rule then sends it to quarantine.
    """
    t = F.col(col).cast("timestamp")
    if gate_future_s is not None:
        limit = F.current_timestamp() + F.make_dt_interval(secs=F.lit(int(gate_future_s)))
        t = F.when(t > limit, F.lit(None).cast("timestamp")).otherwise(t)
    return df.withColumn(EVENT_TIME, t).withWatermark(EVENT_TIME, delay)


def dedup_stream(df: DataFrame, keys: list[str] | None = None, watermark: str | None = "2 hours",
                 gate_future_s: int | None = None, remember: str = REMEMBER) -> DataFrame:
    """Drop repeats of (employee, start, sport), each key kept until the watermark passes it.

    A row without event time is kept by its arrival plus ``remember`` instead: repeats of it are
    dropped for that long at least, and then the watermark evicts it, too. Its arrival does not count
    for the watermark, which is taken before (the column keeps its mark as event time). A
    repeat of a dated row that comes after its key was evicted is late, and dropped for that. Of several rows of one
    key the first to arrive stays. On a batch DataFrame (``watermark=None``) this is plain
    ``dropDuplicates``.
    """
    keys = keys or DEDUP_KEYS
    if watermark is None:
        return df.dropDuplicates(keys)
    timed = with_watermark(df, watermark, gate_future_s=gate_future_s)
    mark = timed.schema[EVENT_TIME].metadata
    held = F.coalesce(F.col(EVENT_TIME), F.current_timestamp() + F.expr(f"INTERVAL {remember}"))
    held = timed.select(*df.columns, held.alias(EVENT_TIME, metadata=mark))
    return held.dropDuplicatesWithinWatermark(keys).drop(EVENT_TIME)


def _deal(routed: DataFrame, files: int) -> DataFrame:
    """Rows dealt by (route, day) and ``files`` parts of a day: a stateful micro-batch has no adaptive
    execution, so this alone bounds a day's files, and a hot day is shared by so many tasks."""
    return routed.repartition("route", DAY, F.pmod(F.xxhash64("id"), F.lit(files)))


def route_batch_writer(out_root: str, params: Params, null_policy: str = "quarantine",
                       fmt: str = SINK_FORMAT, files: int = 4, unreadable_policy: str = "flag"):
    """foreachBatch function: route and write the micro-batch in one pass, then list it.

    Output layout ``data/query=Q/batch_id=N/route=R/jour=D``: the route and day partitions let readers
    prune (bronze = route valid; a look-back reads only its days). Q is the query's id, which its
    checkpoint keeps. A batch that is listed already is a retry and is left alone. Beside the rows go
    their counts per employee and day (``read_day_counts``), from the folder just written. With
    ``delta`` all batches go to one table, and its transaction ids make a retry a no-op.
    """
    settled = False   # only the first batch of a run can have been written before

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal settled
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        routed = with_route(batch, params, null_policy, unreadable_policy=unreadable_policy)
        rows = Observation()
        routed = with_day(routed.withColumn("reasons", F.concat_ws(",", "reasons"))).observe(rows, F.count(F.lit(1)).alias("n"))
        writer = _deal(routed, files).write.format(fmt)
        if fmt == "delta":
            writer = writer.mode("append").option("txnAppId", query).option("txnVersion", str(batch_id))
            writer.partitionBy("route", DAY).save(out_root)
            return
        folder = f"query={query}/batch_id={batch_id}"
        if settled or query == "direct" or not versions.is_settled(spark, out_root, folder):
            _write_listed(spark, writer, out_root, folder, fmt, written=rows)
        settled = True
    return write


def _write_listed(spark: SparkSession, writer, out_root: str, folder: str, fmt: str, removes: list[str] = (),
                  written: Observation | None = None) -> None:
    """Rows, then their day counts, then the entry that makes both visible. A batch without rows, which the
    stream runs to move its watermark, needs no entry."""
    path = f"{out_root}/data/{folder}"
    writer.mode("overwrite").partitionBy("route", DAY).save(path)
    if written is not None and not written.get["n"]:
        remove(spark, path)
        return
    rows = spark.read.format(fmt).schema(f"id_salarie int, route string, {DAY} date").load(path)
    counts = gold.day_counts(rows.where(F.col("route") == VALID), DAY)
    # dealt after the aggregation, which keeps tasks of its own: a coalesce would draw all of them into one
    files = 1 + (rows.count() if written is None else written.get["n"]) // COUNTS_PER_FILE
    counts = counts.repartition(files, "id_salarie", DAY)
    counts.write.format(fmt).mode("overwrite").save(f"{out_root}/counts/{folder}")
    versions.record(spark, out_root, [folder], removes)


def start_ingest(spark: SparkSession, source: str, out_root: str, checkpoint: str, *,
                 params: Params | None = None, fmt: str = "text", topic: str | None = None,
                 bootstrap: str | None = None, delay: str = "2 hours", gate_future: bool = True,
                 null_policy: str = "quarantine", unreadable_policy: str = "flag", remember: str = REMEMBER,
                 max_files_per_trigger: int | None = None,
                 max_offsets_per_trigger: int | None = None, sink_format: str = SINK_FORMAT, files: int = 4,
                 available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Start the bronze ingestion query (earliest offsets, one checkpoint)."""
    params = params or Params()
    raw = read_cdc_stream(spark, source, fmt=fmt, topic=topic, bootstrap=bootstrap, starting="earliest",
                          max_files_per_trigger=max_files_per_trigger, max_offsets_per_trigger=max_offsets_per_trigger)
    gate = params.future_tolerance_s if gate_future else None
    rows = decode_changes(raw, as_of=None, ntz=False, unreadable=True)
    deduped = dedup_stream(rows, watermark=delay, gate_future_s=gate, remember=remember)
    sink = route_batch_writer(out_root, params, null_policy, sink_format, files, unreadable_policy)
    w = deduped.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_routes(spark: SparkSession, out_root: str, route: str | None = None, fmt: str = SINK_FORMAT) -> DataFrame:
    """The listed batches read as one table, with its declared schema: a sink without rows is an empty table."""
    if fmt == "delta":
        df = spark.read.format(fmt).load(out_root)
    else:
        df = versions.read_live(spark, out_root, SINK_SCHEMA, fmt)
    return df if route is None else df.filter(F.col("route") == route)


def read_day_counts(spark: SparkSession, out_root: str, fmt: str = SINK_FORMAT) -> DataFrame:
    """Valid activities per employee and day, a row per batch that wrote some; a look-back is a sum over its days."""
    folders = versions.live(spark, out_root)
    if not folders:
        return spark.createDataFrame([], COUNTS_SCHEMA)
    reader = spark.read.format(fmt).schema(COUNTS_SCHEMA).option("basePath", f"{out_root}/counts")
    return reader.load([f"{out_root}/counts/{f}" for f in folders])


def compact(spark: SparkSession, out_root: str, fmt: str = SINK_FORMAT, keep: int = versions.KEEP) -> None:
    """Replace a sink's batch folders by one folder per route and day, in place.

    A batch job, so adaptive execution shapes the files: few per day, and a hot day is split. One log
    entry swaps the folders, so readers see the one state or the other; batches that
    the stream lists meanwhile stay as they are. The old folders are deleted by a later compaction.
    """
    old = versions.live(spark, out_root)
    if not old:
        return
    rows = read_routes(spark, out_root, fmt=fmt).drop(*SINK_KEYS)
    writer = rows.hint("rebalance", "route", DAY).write.format(fmt)
    _write_listed(spark, writer, out_root, f"query=compact-{uuid.uuid4().hex}/batch_id=0", fmt, removes=old)
    versions.vacuum(spark, out_root, keep, also=("counts",))


def reconcile(spark: SparkSession, source: str, out_root: str, *, params: Params | None = None, fmt: str = "text",
              null_policy: str = "quarantine", unreadable_policy: str = "flag") -> int:
    """Append the landed rows whose keys the sink does not hold: what the watermark dropped as late.

    A batch job over everything that landed: one row per key (the first arrival), without the keys of the
    sink. Stream and reconciliation together hold the keys that one batch run over the
    same messages gives, however the stream's batches were cut; a second run adds nothing. Returns how many rows were added.
    """
    params = params or Params()
    raw = read_cdc_stream(spark, source, fmt=fmt, stream=False)
    landed = dedup_batch(decode_changes(raw, as_of=None, ntz=False, arrival=True, unreadable=True)).drop(*ARRIVAL)
    held = read_routes(spark, out_root).select(*[F.col(c).alias(f"_s_{c}") for c in DEDUP_KEYS]).distinct()
    same = None
    for c in DEDUP_KEYS:
        one = F.col(c).eqNullSafe(F.col(f"_s_{c}"))
        same = one if same is None else same & one
    missing = landed.join(held, same, "left_anti")
    routed = with_day(with_route(missing, params, null_policy, unreadable_policy=unreadable_policy)
                      .withColumn("reasons", F.concat_ws(",", "reasons")))
    folder = f"query=reconcile-{uuid.uuid4().hex}/batch_id=0"
    _write_listed(spark, routed.hint("rebalance", "route", DAY).write.format(SINK_FORMAT), out_root, folder, SINK_FORMAT)
    return spark.read.schema(SINK_SCHEMA).parquet(f"{out_root}/data/{folder}").count()


class Totals(StreamingQueryListener):
    """Figures of all batches of the queries that ran while it listened (progress keeps only the last ones).

    Use as ``with Totals(spark) as t: q = start(...); await_end(q); t.of(q)``.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._ended, self._runs = spark, threading.Condition(), {}

    def __enter__(self) -> "Totals":
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self._spark.streams.removeListener(self)

    def _run(self, run_id) -> dict:
        return self._runs.setdefault(str(run_id), {"batches": 0, "input_rows": 0, "late": 0, "watermark": None, "ended": False})

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._ended:
            run = self._run(p.runId)
            run["batches"] += 1
            run["input_rows"] += p.numInputRows
            run["late"] += sum(s.numRowsDroppedByWatermark or 0 for s in p.stateOperators)
            run["watermark"] = (p.eventTime or {}).get("watermark") or run["watermark"]
            run["state_rows"] = sum(s.numRowsTotal or 0 for s in p.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._ended:
            self._run(event.runId)["ended"] = True
            self._ended.notify_all()

    def of(self, query: StreamingQuery, timeout_s: float = 120) -> dict:
        """The totals of a query that has ended; waits until its last event has arrived."""
        with self._ended:
            if not self._ended.wait_for(lambda: self._run(query.runId)["ended"], timeout_s):
                raise TimeoutError("the query's last progress has not arrived")
            return dict(self._run(query.runId))


def await_end(query: StreamingQuery, timeout_s: float | None = None) -> bool:
    """Block until the query ends (``availableNow``) or the timeout passes.

    Returns whether it ended; a failed query raises instead of returning.
    """
    ended = query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"streaming query failed: {query.exception()}")
    return True if ended is None else bool(ended)
