"""Batch lake tables, HR sheets and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..schemas import DISTANCE_SCHEMA, HR_RENAMES, HR_SHEET_SCHEMA, SPORT_SHEET_SCHEMA
from ..session import scratch_path
from . import versions

LAKE_FORMAT = "parquet"  # "delta" when the Delta jars are on the classpath


def read_table(spark: SparkSession, path: str, fmt: str = LAKE_FORMAT, schema=None) -> DataFrame:
    """Scan a lake table; filters and projections applied later are pushed into the scan.

    A table that ``write_table`` replaced is read through its log: the folder that is listed now.
    """
    if fmt != "delta" and versions.is_versioned(spark, path):
        return versions.read_live(spark, path, schema, fmt)
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = LAKE_FORMAT,
                partition_by: list[str] | None = None) -> None:
    """Replace a whole table, or append to a plain folder.

    ``overwrite`` publishes: the rows are written beside the old ones and take their place by one log
    entry, so a failed job leaves the old table, and readers never find half of one (``read_table``
    resolves the log). A Delta table does that itself.
    """
    if mode == "overwrite" and fmt != "delta":
        versions.publish(df, path, partition_by, fmt)
        return
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back as a plain table scan."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``stored``, with the folder, for a caller that deletes it (``files.remove``) when the table is no longer used."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


ROW_ORDER = "_row_order"


def read_sheet(spark: SparkSession, path: str, schema, fmt: str | None = None, numbered: bool = False) -> DataFrame:
    """Read an exported sheet (CSV with header, or parquet): columns by header name, declared types.

    Column order does not matter and further columns are ignored; a missing column is an error, a
    value that does not fit its type is NULL. Without ``fmt`` a path ending in ``.parquet`` is
    parquet, anything else CSV. ``numbered`` adds ``_row_order``, which grows with the sheet's rows: the
    file, where its piece begins, and the row inside the piece, as the reader tells them.
    """
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    raw = spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.format(fmt).load(path)
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    columns = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    if numbered:
        place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row"))
        columns.append(place.alias(ROW_ORDER))
    return raw.select(*columns)


def rename_hr(df: DataFrame) -> DataFrame:
    """Sheet headers -> snake_case names (columns not in the map are kept)."""
    return df.select(*[F.col(f"`{c}`").alias(HR_RENAMES.get(c, c)) for c in df.columns])


def read_hr(spark: SparkSession, hr_path: str, sport_path: str | None = None,
            fmt: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """HR sheet, and the optional declared-sport sheet with its row order (None when the path is missing)."""
    hr = rename_hr(read_sheet(spark, hr_path, HR_SHEET_SCHEMA, fmt))
    sport = None
    if sport_path:
        try:
            sport = rename_hr(read_sheet(spark, sport_path, SPORT_SHEET_SCHEMA, fmt, numbered=True))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # only a sheet that is not there is optional
                raise
    return hr, sport


def read_distances(spark: SparkSession, path: str, fmt: str | None = LAKE_FORMAT) -> DataFrame:
    """Measured commute distances: (id_salarie, profile, metres, status, measured_at), a lake table by default."""
    return read_sheet(spark, path, DISTANCE_SCHEMA, fmt)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Append rows to the relational source table (needs a JDBC driver on the classpath)."""
    df.write.jdbc(url=url, table=table, mode="append", properties=properties or {})


def preview(df: DataFrame, n: int = 10, order_by: str | None = "id") -> DataFrame:
    """First ``n`` rows (ordered for a stable result); the limit is the feature here."""
    if order_by:
        df = df.orderBy(order_by)
    return df.limit(n)

