"""Text formatting for notification and alert messages (built-in string functions only)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def km_tenths(metres) -> Column:
    """Metres -> tenths of km, half-up on integer metres: ``floor((m + 50) / 100)``."""
    return F.floor((_c(metres).cast("bigint") + F.lit(50)) / F.lit(100))


def km(metres) -> Column:
    """Metres -> km with one decimal (half-up on integer metres)."""
    return km_tenths(metres) / F.lit(10.0)


def km_text(metres) -> Column:
    """Metres -> ``"12.3"`` built from integers, so the text is exact in every engine."""
    t = km_tenths(metres)
    return F.concat(F.floor(t / F.lit(10)).cast("string"), F.lit("."), F.pmod(t, F.lit(10)).cast("string"))


def whole_km_text(metres) -> Column:
    """Metres -> whole km text (``{m/1000:.0f}``), half to even."""
    return F.bround(_c(metres) / F.lit(1000.0), 0).cast("long").cast("string")


def full_name(first, last) -> Column:
    """``"First Last"``; a NULL part is skipped."""
    return F.concat_ws(" ", _c(first), _c(last))


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """The template with each ``{key}`` replaced by its value: one ``concat``, split here and not per row.

    A brace inside a value stays as it is, and an unknown placeholder too. A NULL value prints as
    ``None``, as Python's ``str.format`` would.
    """
    parts = [p for p in re.split(r"(\{[a-z]+\})", template) if p]
    filled = [F.coalesce(values[p[1:-1]].cast("string"), F.lit("None")) if p[0] == "{" and p[1:-1] in values else F.lit(p)
              for p in parts]
    return F.concat(F.lit(""), *filled)


def pick_filled(templates: list[str], key, values: dict[str, Column]) -> Column:
    """One of the templates, filled: chosen by ``pmod(key, n)`` (stands in for a random pick); NULL for a NULL key."""
    at = F.pmod(_c(key), F.lit(len(templates)))
    out = F.when(at == 0, fill_template(templates[0], values))
    for i, t in enumerate(templates[1:], 1):
        out = out.when(at == i, fill_template(t, values))
    return out


def with_comment(text, comment) -> Column:
    """Append `` ("comment")`` when the comment is not empty."""
    c = _c(comment)
    return F.when(F.coalesce(F.length(c), F.lit(0)) > 0,
                  F.concat(_c(text), F.lit(' ("'), c, F.lit('")'))).otherwise(_c(text))


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col
