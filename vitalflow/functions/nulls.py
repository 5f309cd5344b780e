"""NULL handling helpers matching the pandas semantics of the quality checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def default(col, value) -> Column:
    """``fillna(value)`` as an expression."""
    return F.coalesce(_c(col), F.lit(value))


def flag_sum(col) -> Column:
    """Number of TRUE values; NULL flags are skipped, all-NULL gives NULL (like ``sum(cast)``)."""
    return F.sum(_c(col).cast("int"))


def in_list(col, values: Iterable, null_as: bool = False) -> Column:
    """Membership where NULL is ``null_as`` instead of NULL (pandas ``isin`` gives False)."""
    return F.coalesce(_c(col).isin(list(values)), F.lit(null_as))


def is_blank(col, kind: str = "string") -> Column:
    """Python truthiness: NULL, '' (strings) or 0 (numbers) count as absent."""
    c = _c(col)
    if kind == "string":
        return F.coalesce(c, F.lit("")) == F.lit("")
    return F.coalesce(c, F.lit(0)) == F.lit(0)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col
