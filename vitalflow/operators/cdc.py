"""Change-event handling after decoding. Stateless: valid on batch and streaming DataFrames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import clock, from_micros
from ..sources.cdc import decode_envelope, image_columns, parse_envelope


def drop_deletes(df: DataFrame) -> DataFrame:
    """Keep changes with ``op <> 'd'``; a NULL op (tombstone, garbage, no payload) is dropped too."""
    return df.filter(F.col("op") != "d")


def decode_with_guard_flag(df: DataFrame, value: str = "value") -> DataFrame:
    """Decoded envelope plus ``after_present`` (the change carries a row image)."""
    return (parse_envelope(df, value)
            .select(*image_columns(), F.col("e.payload.op").alias("op"),
                    F.col("e.payload.after").isNotNull().alias("after_present")))


def guard_empty(df: DataFrame) -> DataFrame:
    """Notifier guard: skip tombstones, envelopes without payload, deletes and NULL ``after``.

    Unlike ``drop_deletes`` a change without ``op`` but with a row image is kept.
    Expects ``after_present`` from :func:`decode_with_guard_flag`.
    """
    return (df.filter(F.col("after_present") & F.coalesce(F.col("op") != "d", F.lit(True)))
            .drop("after_present"))


def cast_times(df: DataFrame, as_of: dt.datetime | None = None, ntz: bool = False) -> DataFrame:
    """µs epoch -> timestamps for start and end, stamp ``ingested_at``, drop ``op``.

    ``ntz=True`` gives UTC wall-clock TIMESTAMP_NTZ values (batch tables);
    the default TIMESTAMP instants are what a watermark needs.
    """
    def conv(c):
        t = from_micros(c)
        return F.convert_timezone(None, F.lit("UTC"), t.cast("timestamp_ntz")) if ntz else t
    kind = "timestamp_ntz" if ntz else "timestamp"
    out = (df.withColumn("date_debut", conv("date_debut"))
           .withColumn("date_fin", conv("date_fin"))
           .withColumn("ingested_at", clock(as_of, kind)))
    return out.drop("op") if "op" in df.columns else out


def decode_changes(raw: DataFrame, as_of: dt.datetime | None = None, ntz: bool = False, arrival: bool = False,
                   unreadable: bool = False) -> DataFrame:
    """value -> typed activity rows of the bronze job: decode, drop deletes, cast times.

    ``arrival`` and ``unreadable`` add the columns of the same name from :func:`decode_envelope`.
    """
    return cast_times(drop_deletes(decode_envelope(raw, arrival=arrival, unreadable=unreadable)), as_of, ntz)
