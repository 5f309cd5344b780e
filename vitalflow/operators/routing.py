"""Rule-based routing of activities to bronze (valid) or quarantine."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import is_valid, reasons
from ..params import Params
from ..sources.cdc import UNREADABLE

VALID, QUARANTINE, UNROUTED = "valid", "quarantine", "unrouted"


class Routed:
    """The three routes of one routed DataFrame, each built on first use."""

    def __init__(self, routed: DataFrame, cols: list[str]):
        self._routed, self._cols = routed, cols

    @functools.cached_property
    def valid(self) -> DataFrame:
        return self._routed.filter(F.col("route") == VALID).select(*self._cols)

    @functools.cached_property
    def quarantine(self) -> DataFrame:
        return self._routed.filter(F.col("route") == QUARANTINE).select(*self._cols, "reasons")

    @functools.cached_property
    def unrouted(self) -> DataFrame:
        return self._routed.filter(F.col("route") == UNROUTED).select(*self._cols, "reasons")


def time_type(df: DataFrame, col: str = "date_debut") -> str:
    return "timestamp_ntz" if isinstance(df.schema[col].dataType, T.TimestampNTZType) else "timestamp"


def with_route(df: DataFrame, params: Params, null_policy: str = "quarantine",
               caps: dict[str, int] | None = None, with_reasons: bool = True,
               unreadable_policy: str = "flag") -> DataFrame:
    """Add ``route`` (valid / quarantine / unrouted) and ``reasons`` in one projection.

    The rule is three-valued: NULL (start date missing, all else fine) is
    ``unrouted``; ``null_policy="quarantine"`` (default) sends it to
    quarantine, ``"drop"`` keeps the reference behaviour where it is lost.
    If the rows carry the flag of an unreadable distance, it is taken off and becomes the reason
    ``distance_unparsable``; with ``unreadable_policy="quarantine"`` it decides the route as well.
    """
    unreadable = UNREADABLE if UNREADABLE in df.columns else None
    tt = time_type(df)
    rule = is_valid(params.as_of, caps, time_type=tt)
    if unreadable and unreadable_policy == "quarantine":
        rule = rule & ~F.col(unreadable)
    null_route = QUARANTINE if null_policy == "quarantine" else UNROUTED
    cols = [F.when(rule, F.lit(VALID)).when(~rule, F.lit(QUARANTINE)).otherwise(F.lit(null_route)).alias("route")]
    if with_reasons:
        cols.append(reasons(params.as_of, caps, time_type=tt, unreadable=unreadable).alias("reasons"))
    return df.select(*[c for c in df.columns if c != unreadable], *cols)


DAY = "jour"


def with_day(df: DataFrame, col: str = "date_debut") -> DataFrame:
    """Add the day partition column of the bronze layout (NULL start -> default partition)."""
    return df.withColumn(DAY, F.to_date(F.col(col)))


def route(df: DataFrame, params: Params, null_policy: str = "quarantine",
          caps: dict[str, int] | None = None) -> Routed:
    """Split into the three routes; valid rows keep the input columns only."""
    return Routed(with_route(df, params, null_policy, caps, with_reasons=True), df.columns)


def split_check(dedup: DataFrame, routed: Routed) -> DataFrame:
    """valid ⊎ quarantine ⊎ unrouted must equal the deduplicated input, as multisets.

    One grouped aggregation over whole rows (weight +1 input, -1 output)
    replaces two ``exceptAll``; the result is one row of counts.
    """
    cols = dedup.columns
    parts = (routed.valid.select(*cols).unionByName(routed.quarantine.select(*cols))
             .unionByName(routed.unrouted.select(*cols)))
    tagged = (dedup.select(*cols, F.lit(1).alias("_w"))
              .unionByName(parts.select(*cols, F.lit(-1).alias("_w"))))
    # dealt before the aggregation: nothing cancels inside a part of the union, so tables of whole rows built
    # there would only grow with the scans' splits
    diff = tagged.repartition(*cols).groupBy(*cols).agg(F.sum("_w").alias("d"),
                                     F.count_if(F.col("_w") > 0).alias("n_in"))
    return diff.agg(
        F.coalesce(F.sum("n_in"), F.lit(0)).cast("long").alias("n_entree"),
        F.coalesce(F.sum(F.when(F.col("d") > 0, F.col("d"))), F.lit(0)).cast("long").alias("n_manquantes"),
        F.coalesce(F.sum(F.when(F.col("d") < 0, -F.col("d"))), F.lit(0)).cast("long").alias("n_en_trop"),
    )


def reject_stats(quarantine: DataFrame) -> DataFrame:
    """Quarantined rows per reason, sport and day."""
    return (quarantine.select(F.explode("reasons").alias("reason"), "sport_type",
                              F.to_date("date_debut").alias("jour"))
            .groupBy("reason", "sport_type", "jour").agg(F.count(F.lit(1)).alias("nb_lignes")))
