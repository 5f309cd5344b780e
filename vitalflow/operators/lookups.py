"""Small rule tables joined to the data: sport caps (also available as a map Column)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DEFAULT_CAP_M


def with_cap(df: DataFrame, caps: DataFrame, default: int = DEFAULT_CAP_M) -> DataFrame:
    """sport_type -> cap_m with a default; the cap table is a rule list of a few rows (broadcast)."""
    c = caps.select(F.col("sport_type").alias("_sport"), F.col("cap_m").alias("_cap"))
    j = df.join(F.broadcast(c), df["sport_type"] == c["_sport"], "left")
    return j.withColumn("cap_m", F.coalesce(F.col("_cap"), F.lit(int(default)))).drop("_sport", "_cap")
