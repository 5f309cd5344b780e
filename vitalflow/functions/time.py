"""Time helpers (all built-in expressions, no Python per row)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T



def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def from_micros(col) -> Column:
    """Microseconds since the epoch -> TIMESTAMP instant (exact)."""
    return F.timestamp_micros(_c(col))


def to_micros(col, ntz: bool = True) -> Column:
    """TIMESTAMP_NTZ (read as UTC wall clock) or TIMESTAMP -> microseconds since the epoch."""
    if ntz:
        return F.timestamp_diff("MICROSECOND", epoch_ntz(), _c(col))
    return F.unix_micros(_c(col))


def utc_wall(col) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ wall clock in UTC, whatever the session zone."""
    return F.convert_timezone(None, F.lit("UTC"), _c(col).cast("timestamp_ntz"))


def clock(as_of: dt.datetime | None = None, dtype: T.DataType | str = "timestamp_ntz") -> Column:
    """The run clock: an injected literal, or the processing time when ``as_of`` is None."""
    if as_of is None:
        c = F.current_timestamp()
        return c.cast("timestamp_ntz") if _is_ntz(dtype) else c
    if _is_ntz(dtype):
        return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    # an instant: ``as_of`` read as UTC, independent of the session time zone
    return F.timestamp_micros(F.lit(_utc_micros(as_of)))


def window_start(as_of: dt.datetime | None, days: int, dtype: T.DataType | str = "timestamp_ntz") -> Column:
    """Midnight of ``as_of`` minus ``days`` days (the reference compares a timestamp with a date)."""
    day = F.current_date() if as_of is None else F.lit(as_of.date().isoformat()).cast("date")
    return F.date_sub(day, days).cast(dtype)


def duration_min(start, end) -> Column:
    """Whole minutes between start and end, rounded half to even; NULL without an end."""
    micros = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return F.bround(micros / F.lit(60_000_000.0), 0).cast("long")


def _utc_micros(t: dt.datetime) -> int:
    if t.tzinfo is not None:
        t = t.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _is_ntz(dtype) -> bool:
    return isinstance(dtype, T.TimestampNTZType) or str(dtype).lower() in ("timestamp_ntz", "timestampntztype()")
