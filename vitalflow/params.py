"""Business parameters and run settings."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import SparkSession

from .schemas import DEFAULT_PARAMS, PARAMS_SCHEMA


@dataclasses.dataclass(frozen=True)
class Params:
    """Business rules (rate, threshold, days) plus the run clock.

    ``as_of`` replaces ``current_date()`` / ``now()`` so that every result is
    reproducible; ``None`` means "use the processing time".
    """

    taux_prime: float = DEFAULT_PARAMS["taux_prime"]
    seuil_activites_bien_etre: int = DEFAULT_PARAMS["seuil_activites_bien_etre"]
    jours_bien_etre_accordes: int = DEFAULT_PARAMS["jours_bien_etre_accordes"]
    as_of: dt.datetime | None = None
    lookback_days: int = 365
    future_tolerance_s: int = 300

    def replace(self, **kw) -> "Params":
        return dataclasses.replace(self, **kw)


# Settings used by the registered queries over the test tables: events span
# January 2024, so a 7-day look-back makes the threshold of 15 discriminating.
TEST_PARAMS = Params(as_of=dt.datetime(2024, 1, 31), lookback_days=7)


def load_params(spark: SparkSession, path: str, **overrides) -> Params:
    """Read the 3-scalar parameter document (one small JSON object)."""
    row = spark.read.schema(PARAMS_SCHEMA).option("multiLine", True).json(path).first()
    values = {k: row[k] for k in PARAMS_SCHEMA.fieldNames() if row is not None and row[k] is not None}
    return Params(**values, **overrides)
