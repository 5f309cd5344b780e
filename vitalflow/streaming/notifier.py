"""The notifier as a streaming query: each new change event becomes a message or an alert.

Source at the latest offsets with its own checkpoint (replaces the consumer
group). Each micro-batch is joined with the employee directory as it is then, so a directory that
is replaced while the query runs is taken up by the next batch; without a directory
the ids stand in for the names. Delivery is a user callback per micro-batch (``writer(df,
batch_id)``), by default an idempotent write of the messages table.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.cdc import cast_times, decode_with_guard_flag, guard_empty
from ..operators.notify import directory, messages
from ..sources import versions
from ..sources.cdc import read_cdc_stream
from ..sources.files import remove
from ..sources.tables import read_table, stored_at

LOG = logging.getLogger(__name__)
MESSAGES_SCHEMA = "id bigint, id_salarie int, type_message string, texte string, query string, batch_id bigint"


def notification_stream(raw: DataFrame, dir_df: DataFrame | None, tolerance_s: int = 300) -> DataFrame:
    """value -> (id, id_salarie, type_message, texte), stateless."""
    events = cast_times(guard_empty(decode_with_guard_flag(raw)), as_of=None, ntz=False).drop("ingested_at")
    return messages(events, dir_df, as_of=None, tolerance_s=tolerance_s)


class Directory:
    """The employee directory of a referential, kept as one written table with one row per id.

    Written because a join with a plain table can split a hot employee. It is written anew only when the
    referential was replaced (its log tells), and the copy before it is deleted then: at most one is
    kept. A referential without a log may change unseen, so it is read anew for every batch.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path, self._seen, self._df, self._at = spark, path, None, None, None

    def now(self) -> DataFrame | None:
        """The directory as it is now, or None (with a warning) if there is none."""
        seen = versions.live(self._spark, self._path) or None
        if seen is not None and seen == self._seen:
            return self._df
        old = self._at
        try:
            self._df, self._at = stored_at(directory(read_table(self._spark, self._path)), "directory")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            LOG.warning("no employee directory at %s: names are replaced by ids", self._path)
            self._df = self._at = None
        self._seen = seen
        if old:
            remove(self._spark, old)
        return self._df

    def close(self) -> None:
        if self._at:
            remove(self._spark, self._at)
        self._df = self._at = self._seen = None


def table_writer(out_root: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Writes each batch to ``query=Q/batch_id=N``; a retry rewrites the folder, another query has its own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        batch.write.format(fmt).mode("overwrite").save(f"{out_root}/query={query}/batch_id={batch_id}")
    return write


def read_messages(spark: SparkSession, out_root: str) -> DataFrame:
    return spark.read.schema(MESSAGES_SCHEMA).parquet(out_root)


def start_notifications(spark: SparkSession, source: str, dir_or_path: DataFrame | str | None, checkpoint: str, *,
                        writer: Callable[[DataFrame, int], None] | None = None, out_root: str | None = None,
                        fmt: str = "text", topic: str | None = None, bootstrap: str | None = None,
                        max_offsets_per_trigger: int | None = None, max_files_per_trigger: int | None = None,
                        available_now: bool = False, tolerance_s: int = 300) -> StreamingQuery:
    """``dir_or_path``: a directory table, or the path of a referential that is read anew for every batch."""
    raw = read_cdc_stream(spark, source, fmt=fmt, topic=topic, bootstrap=bootstrap, starting="latest",
                          max_files_per_trigger=max_files_per_trigger, max_offsets_per_trigger=max_offsets_per_trigger)
    sink = writer or table_writer(out_root)
    source_of_names: Directory | None = None

    def deliver(batch: DataFrame, batch_id: int) -> None:
        nonlocal source_of_names
        names = dir_or_path
        if isinstance(dir_or_path, str):
            source_of_names = source_of_names or Directory(batch.sparkSession, dir_or_path)
            names = source_of_names.now()
        sink(notification_stream(batch, names, tolerance_s), batch_id)

    w = raw.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
