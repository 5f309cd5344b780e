"""Duplicate handling in batch.

Deduplication is a grouped aggregation, not a window: the partial
(map-side) aggregate collapses repeats before the shuffle, so a key that
holds a third of all rows costs one row per map task, not one giant task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.cdc import ARRIVAL

DEDUP_KEYS = ["id_salarie", "date_debut", "sport_type"]


def dedup_batch(df: DataFrame, keys: list[str] | None = None, order: str | list[str] | None = None) -> DataFrame:
    """One row per key: the first in ``order`` wins (deterministic).

    Without ``order`` the first arrival wins where the changes' order was decoded
    (``sources.cdc.ARRIVAL``), else the lowest id. ``min(struct(order, ...))`` compares the struct
    field by field, and the remaining columns settle ties; an unknown place comes last. NULL
    keys form their own group, as in the stream.
    """
    keys = keys or DEDUP_KEYS
    if order is None:
        order = [*[c for c in ARRIVAL if c in df.columns], "id"]
    order = [order] if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys and c not in order]
    by = [x for c in order for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    first = F.min(F.struct(*by, *[F.col(c) for c in rest])).alias("_first")
    return df.groupBy(*keys).agg(first).select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def duplicate_keys(df: DataFrame, key: str = "id_salarie") -> DataFrame:
    """Keys that appear more than once, with the number of rows after the first (NULL is a key)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("nb_lignes"))
            .filter(F.col("nb_lignes") > 1)
            .select(key, (F.col("nb_lignes") - 1).alias("nb_repetitions")))


def duplicate_count(df: DataFrame, key: str = "id_salarie") -> DataFrame:
    """Number of rows that repeat an earlier key (pandas ``duplicated().sum()``), one row."""
    return (duplicate_keys(df, key)
            .agg(F.coalesce(F.sum("nb_repetitions"), F.lit(0)).cast("long").alias("violations")))
