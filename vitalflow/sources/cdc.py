"""The CDC change stream: source, envelope encoding (for fixtures and the JDBC-less path) and decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import to_micros
from ..schemas import ACTIVITY_COLUMNS, ENVELOPE_SCHEMA, IMAGE_SCHEMA


# What a change stream's source gives, in every format: the columns of a topic's records.
RECORD_SCHEMA = "key string, value string, partition int, offset bigint, timestamp timestamp"
RECORD_COLUMNS = ("key", "value", "partition", "offset", "timestamp")


def read_cdc_stream(spark: SparkSession, source: str, *, fmt: str = "text", topic: str | None = None,
                    bootstrap: str | None = None, starting: str = "earliest",
                    max_files_per_trigger: int | None = None, max_offsets_per_trigger: int | None = None,
                    stream: bool = True) -> DataFrame:
    """Change events as keyed records: key, value (NULL: a tombstone), partition, offset, timestamp.

    ``fmt="kafka"`` subscribes to ``topic`` (``starting`` = earliest for the
    bronze ingest, latest for the notifier); ``fmt="records"`` reads a folder of records with the same
    columns (parquet with the declared schema, the offline stand-in for the topic);
    ``fmt="text"`` reads bare envelopes, one per line, which have neither key nor position.
    ``stream=False`` reads the same source as a batch table. A file folder has
    no "latest" offset: a new checkpoint reads the files already there. The
    ``max_*_per_trigger`` settings bound a micro-batch, also the first one.
    """
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        options = kafka_options(topic, bootstrap, starting, max_offsets_per_trigger, stream)
        return reader.format("kafka").options(**options).load().select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
            "partition", "offset", "timestamp")
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "records":
        return reader.schema(RECORD_SCHEMA).parquet(source)
    nothing = {c: F.lit(None).cast(t) for c, t in (x.strip().split(" ") for x in RECORD_SCHEMA.split(",")) if c != "value"}
    return reader.format("text").load(source).select(F.col("value")).withColumns(nothing).select(*RECORD_COLUMNS)


def write_records(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Records as the ``records`` source reads them; a tombstone is a record without value."""
    records.select(*RECORD_COLUMNS).write.mode(mode).parquet(path)


def kafka_options(topic: str | None, bootstrap: str | None, starting: str,
                  max_offsets_per_trigger: int | None, stream: bool = True) -> dict[str, str]:
    """Reader options; ``starting="latest"`` makes a new checkpoint skip the topic's history."""
    out = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic}
    if stream:
        out["startingOffsets"] = starting
        if max_offsets_per_trigger:
            out["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return out


def envelope_json(op="c", ntz: bool = True, ts_ms: Column | None = None, lsn: Column | None = None) -> Column:
    """The CDC envelope ``{"payload": {"before", "after", "op"}}`` of the current activity row, as JSON text.

    A delete carries the row in ``before`` and a NULL ``after``. With ``ts_ms`` and ``lsn`` the
    envelope also tells the change's time and its place in the source's log.
    """
    op_col = F.lit(op) if isinstance(op, str) else op
    image = F.struct(
        F.col("id").cast("long").alias("id"),
        F.col("id_salarie").cast("int").alias("id_salarie"),
        to_micros("date_debut", ntz).alias("date_debut"),
        F.col("sport_type"),
        F.col("distance_m").cast("int").alias("distance_m"),
        to_micros("date_fin", ntz).alias("date_fin"),
        F.col("commentaire"),
    )
    null_image = F.lit(None).cast(IMAGE_SCHEMA)
    place = [] if ts_ms is None else [F.struct(ts_ms.alias("ts_ms"), lsn.alias("lsn")).alias("source")]
    payload = F.struct(
        F.when(op_col == "d", image).otherwise(null_image).alias("before"),
        F.when(op_col == "d", null_image).otherwise(image).alias("after"),
        *place,
        op_col.alias("op"),
        *([] if ts_ms is None else [ts_ms.alias("ts_ms")]),
    )
    return F.to_json(F.struct(payload.alias("payload")), JSON_OPTIONS)


JSON_OPTIONS = {"ignoreNullFields": "false"}  # explicit nulls, as on the CDC wire ("before": null)


def encode_envelopes(df: DataFrame, op="c", ntz: bool = True) -> DataFrame:
    """Activity rows -> one ``value`` column of CDC envelopes."""
    return df.select(envelope_json(op, ntz).alias("value"))


ARRIVAL = ["change_ms", "log_position", "source_offset"]   # the order of changes, first to last
UNREADABLE = "distance_illisible"


def image_columns() -> list[Column]:
    """The ``after.*`` columns of a parsed envelope ``e``; a distance that is no integer is NULL."""
    raw = F.col("e.payload.after.distance_m")
    metres = F.when(F.schema_of_variant(raw) == "BIGINT", F.try_variant_get(raw, "$", "int"))
    return [(metres if c == "distance_m" else F.col(f"e.payload.after.{c}")).alias(c) for c in ACTIVITY_COLUMNS]


def unreadable_distance() -> Column:
    """TRUE where the envelope gives a distance that is not an integer of its range (text, fraction, too large)."""
    raw = F.col("e.payload.after.distance_m")
    kind = F.schema_of_variant(raw)
    return F.coalesce((kind != "VOID") & ((kind != "BIGINT") | F.try_variant_get(raw, "$", "int").isNull()), F.lit(False))


def decode_envelope(df: DataFrame, value: str = "value", arrival: bool = False, unreadable: bool = False) -> DataFrame:
    """JSON envelope -> flat ``after.*`` columns plus ``op``.

    Parsing is permissive with the declared schema: garbage, tombstones and
    envelopes without ``payload`` decode to all-NULL rows (op NULL); a field of
    the wrong type decodes to NULL alone. ``arrival`` adds the order of changes: the change's time,
    its place in the source's log, and the record's offset (NULL where the message does not tell).
    ``unreadable`` adds the flag that tells a distance of the wrong type from a missing one.
    """
    order = []
    if arrival:
        offset = F.col("offset") if "offset" in df.columns else F.lit(None).cast("bigint")
        order = [F.coalesce(F.col("e.payload.source.ts_ms"), F.col("e.payload.ts_ms")).alias(ARRIVAL[0]),
                 F.col("e.payload.source.lsn").alias(ARRIVAL[1]), offset.alias(ARRIVAL[2])]
    flag = [unreadable_distance().alias(UNREADABLE)] if unreadable else []
    return parse_envelope(df, value).select(*image_columns(), F.col("e.payload.op").alias("op"), *order, *flag)


def parse_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """The columns beside ``value``, and ``e``: the parsed envelope struct, parsed exactly once per message.

    The one-element ``explode`` is a barrier for predicate pushdown: without it
    a later filter on ``op`` is pushed below the projection and ``from_json``
    runs twice per message (once in the filter, once in the projection),
    which measured twice as slow.
    """
    beside = [c for c in df.columns if c != value]
    return df.select(*beside, F.explode(F.array(F.from_json(F.col(value), ENVELOPE_SCHEMA))).alias("e"))
