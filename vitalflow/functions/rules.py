"""Validation rules of the ingestion stage as Columns.

One rule list drives both the routing predicate and the reject reasons, so a
row's route and its reasons can never disagree.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ACTIVE_MODES, DEFAULT_CAP_M, DISTANCE_CAPS_M
from .time import clock


def caps_map(caps: dict[str, int] | None = None) -> Column:
    """The cap table as a literal map Column (evaluated inside codegen, no join)."""
    caps = DISTANCE_CAPS_M if caps is None else caps
    entries = ", ".join(f"'{k.replace(chr(39), chr(39) * 2)}', {int(v)}" for k, v in sorted(caps.items()))
    return F.expr(f"map({entries})")


def cap_for(sport="sport_type", caps: dict[str, int] | None = None, default: int = DEFAULT_CAP_M) -> Column:
    """Cap in metres for a sport label; unknown or NULL label -> ``default``."""
    return F.coalesce(F.element_at(caps_map(caps), _c(sport)), F.lit(int(default)))


def distance_ok(caps: dict[str, int] | None = None, default: int = DEFAULT_CAP_M,
                distance="distance_m", sport="sport_type") -> Column:
    """NULL distance passes; otherwise ``0 <= distance <= cap(sport)``."""
    d = _c(distance)
    return d.isNull() | ((d >= 0) & (d <= cap_for(sport, caps, default)))


def is_valid(as_of: dt.datetime | None = None, caps: dict[str, int] | None = None,
             default: int = DEFAULT_CAP_M, time_type: str = "timestamp_ntz") -> Column:
    """Three-valued validity: TRUE valid, FALSE rejected, NULL undecidable (NULL start only)."""
    return (F.col("id_salarie").isNotNull()
            & F.col("sport_type").isNotNull()
            & distance_ok(caps, default)
            & (F.col("date_debut") <= clock(as_of, time_type)))


def reject_rules(as_of: dt.datetime | None = None, caps: dict[str, int] | None = None,
                 default: int = DEFAULT_CAP_M, time_type: str = "timestamp_ntz",
                 unreadable: str | None = None) -> list[tuple[str, Column]]:
    """(reason code, violation predicate) for every rule behind ``is_valid``.

    ``unreadable`` names the flag of a distance that is no integer. It gives a reason but does not
    decide the route: the distance is NULL, which passes.
    """
    d = F.col("distance_m")
    return [
        *([("distance_unparsable", F.col(unreadable))] if unreadable else []),
        ("id_salarie_absent", F.col("id_salarie").isNull()),
        ("sport_absent", F.col("sport_type").isNull()),
        ("distance_negative", d < 0),
        ("distance_above_cap", (d >= 0) & (d > cap_for("sport_type", caps, default))),
        ("date_debut_absente", F.col("date_debut").isNull()),
        ("date_debut_future", F.col("date_debut") > clock(as_of, time_type)),
    ]


def reasons(as_of: dt.datetime | None = None, caps: dict[str, int] | None = None,
            default: int = DEFAULT_CAP_M, time_type: str = "timestamp_ntz", unreadable: str | None = None) -> Column:
    """array<string> of the violated rules (empty for a valid row)."""
    return F.array_compact(F.array(*[F.when(p, F.lit(code)) for code, p in
                                     reject_rules(as_of, caps, default, time_type, unreadable)]))


# --- HR / gold flags --------------------------------------------------------

def active_mode(modes: dict | None = None, col="moyen_declare") -> Column:
    """Declared commute mode is an active one; NULL mode gives NULL."""
    modes = ACTIVE_MODES if modes is None else modes
    return _c(col).isin(sorted(modes))


def distance_pending(mode_flag="mode_actif_declare", anomaly="distance_anormale") -> Column:
    """Active mode whose distance has not been checked yet (anomaly flag NULL)."""
    return _c(mode_flag) & _c(anomaly).isNull()


def bonus_eligible(mode_flag="mode_actif_declare", anomaly="distance_anormale") -> Column:
    """Active mode and distance checked as consistent; NULL flag -> NULL (not eligible)."""
    return _c(mode_flag) & (_c(anomaly) == F.lit(False))


def bonus_amount(rate: float, eligible="eligible_prime", salary="salaire_brut") -> Column:
    """salary x rate when eligible, else 0.0 (NULL salary of an eligible employee -> NULL)."""
    return F.when(_c(eligible), _c(salary) * F.lit(float(rate))).otherwise(F.lit(0.0))


def wellness(threshold: int, count="nb_activites_12mois") -> Column:
    return _c(count) >= F.lit(int(threshold))


def wellness_days(days: int, flag="eligible_bien_etre") -> Column:
    return F.when(_c(flag), F.lit(int(days))).otherwise(F.lit(0))


def three_state_anomaly(km="distance_km", threshold="seuil_km", measured="measured",
                        lookup_failed="lookup_failed", failed_policy: str = "pending") -> Column:
    """Commute-distance anomaly flag with three states.

    mode without threshold -> FALSE; not measured -> NULL (pending);
    failed look-up -> NULL with ``failed_policy="pending"``, FALSE with ``"accept"``
    (the reference's behaviour); otherwise ``km > threshold`` (strict).
    """
    failed_value = F.lit(None).cast("boolean") if failed_policy == "pending" else F.lit(False)
    return (F.when(_c(threshold).isNull(), F.lit(False))
            .when(~F.coalesce(_c(measured), F.lit(False)), F.lit(None).cast("boolean"))
            .when(F.coalesce(_c(lookup_failed), F.lit(False)), failed_value)
            .otherwise(_c(km) > _c(threshold)))


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col
