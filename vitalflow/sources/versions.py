"""Tables made of folders that a log lists: what is not listed is not there.

``root/data`` holds folders, and ``root/log`` one small JSON file per change with the folders that it
adds and removes. A change takes effect when its file is there, as a whole: a job that fails before
leaves the table as it was, and folders without an entry are never read. Folders that are removed
stay on disk for readers that are under way, until later changes drop them (``KEEP`` changes, or
``vacuum``). A folder that was removed does not come back, so a late retry of its writer adds nothing.

One writer at a time may replace a table; several may add folders of their own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .files import exists, remove

LOG_SCHEMA = "version bigint, adds array<string>, removes array<string>"
KEEP = 1  # replaced states whose folders stay for readers under way


def is_versioned(spark: SparkSession, root: str) -> bool:
    return exists(spark, f"{root}/log")


def _entries(spark: SparkSession, root: str) -> list[Row]:
    """The log on the driver: a few names for each change, as any table's file listing."""
    return spark.read.schema(LOG_SCHEMA).json(f"{root}/log").collect() if is_versioned(spark, root) else []


def _folders(entries: list[Row], column: str) -> set[str]:
    return {folder for e in entries for folder in e[column] or []}


def live(spark: SparkSession, root: str) -> list[str]:
    """The folders of the table, below ``root/data``."""
    entries = _entries(spark, root)
    return sorted(_folders(entries, "adds") - _folders(entries, "removes"))


def is_settled(spark: SparkSession, root: str, folder: str) -> bool:
    """Whether the folder was ever added: its rows are in the table, there or in a folder that took its place."""
    return folder in _folders(_entries(spark, root), "adds")


def record(spark: SparkSession, root: str, adds: list[str], removes: list[str] = ()) -> int:
    """Append one change to the log; returns its version. The entry is one file, so it is there or not."""
    version = max((e["version"] for e in _entries(spark, root)), default=-1) + 1
    entry = spark.createDataFrame([(version, list(adds), list(removes))], LOG_SCHEMA)
    entry.coalesce(1).write.mode("append").json(f"{root}/log")
    return version


def publish(df: DataFrame, root: str, partition_by: list[str] | None = None, fmt: str = "parquet", keep: int = KEEP) -> None:
    """Replace the table by ``df``: written beside it first, and listed only when complete.

    A reader that began before goes on reading the folder it resolved; it is deleted ``keep``
    replacements later.
    """
    spark = df.sparkSession
    folder = f"v-{uuid.uuid4().hex}"
    writer = df.write.format(fmt)
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).save(f"{root}/data/{folder}")
    except Exception:
        remove(spark, f"{root}/data/{folder}")   # what a killed driver leaves behind is never listed
        raise
    record(spark, root, [folder], live(spark, root))
    vacuum(spark, root, keep)


def read_live(spark: SparkSession, root: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """The table as it is listed now. ``schema`` is needed if it may have no folder yet."""
    folders = live(spark, root)
    if not folders:
        if schema is None:
            raise ValueError(f"{root}: nothing published yet")
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in _fields(spark, schema)])
    reader = spark.read.format(fmt) if schema is None else spark.read.format(fmt).schema(schema)
    if len(folders) > 1 or "/" in folders[0]:   # folders in partition style share the table's root
        reader = reader.option("basePath", f"{root}/data")
    return reader.load([f"{root}/data/{f}" for f in folders])


def _fields(spark: SparkSession, schema):
    from pyspark.sql import types as T
    return (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).fields


def vacuum(spark: SparkSession, root: str, keep: int = KEEP, also: tuple[str, ...] = ()) -> None:
    """Delete the removed folders of all but the last ``keep`` changes that removed any.

    ``also`` names further folders beside ``data`` that hold parts of the same name.
    """
    changes = sorted((e for e in _entries(spark, root) if e["removes"]), key=lambda e: e["version"])
    for folder in sorted(_folders(changes[: max(0, len(changes) - keep)], "removes")):
        for part in ("data", *also):
            remove(spark, f"{root}/{part}/{folder}")
