"""CDC envelope cases (FIXTURES.md §3)."""

from __future__ import annotations

import json

from vitalflow.operators.cdc import cast_times, decode_with_guard_flag, drop_deletes, guard_empty
from vitalflow.sources.cdc import decode_envelope

AFTER = {"id": 1, "id_salarie": 42, "date_debut": 1700000000000000, "sport_type": "Tennis",
         "distance_m": 1200, "date_fin": 1700003600000000, "commentaire": "ok"}


def env(after=AFTER, op="c", **payload_extra):
    return json.dumps({"schema": {"x": 1}, "payload": {"before": None, "after": after, "op": op, **payload_extra}})


def decode(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return decode_envelope(df)


def test_envelope_cases(spark):
    cases = {
        "create": env(),
        "update": env(op="u"),
        "snapshot": env(op="r"),
        "delete": env(after=None, op="d"),
        "tombstone": None,
        "garbage": "{not json",
        "no_payload": json.dumps({"x": 1}),
        "flat": json.dumps({"after": AFTER, "op": "c"}),
        "after_null_c": json.dumps({"payload": {"after": None, "op": "c"}}),
        "no_op": json.dumps({"payload": {"after": AFTER}}),
        "overflow": env(after={**AFTER, "id_salarie": 3000000000}),
        "str_int": env(after={**AFTER, "distance_m": "12"}),
        "float_int": env(after={**AFTER, "distance_m": 12.5}),
    }
    names = list(cases)
    rows = decode(spark, [cases[n] for n in names]).collect()
    got = dict(zip(names, rows))
    assert got["create"]["id_salarie"] == 42 and got["create"]["op"] == "c"
    assert got["update"]["op"] == "u" and got["snapshot"]["op"] == "r"
    assert got["delete"]["id"] is None and got["delete"]["op"] == "d"
    for n in ["tombstone", "garbage", "no_payload", "flat"]:
        assert all(v is None for v in got[n]), n
    assert got["after_null_c"]["id"] is None and got["after_null_c"]["op"] == "c"
    assert got["no_op"]["id"] == 1 and got["no_op"]["op"] is None
    assert got["overflow"]["id_salarie"] is None and got["overflow"]["id"] == 1
    assert got["str_int"]["distance_m"] is None and got["str_int"]["sport_type"] == "Tennis"
    assert got["float_int"]["distance_m"] is None
    flags = decode_envelope(spark.createDataFrame([(cases[n],) for n in names], "value string"), unreadable=True).collect()
    assert {n for n, r in zip(names, flags) if r["distance_illisible"]} == {"str_int", "float_int"}
    kept = {r["op"] for r in drop_deletes(decode(spark, [cases[n] for n in names])).collect()}
    assert kept == {"c", "u", "r"}
    assert drop_deletes(decode(spark, [cases[n] for n in names])).count() == 7


def test_guard_keeps_no_op_with_image(spark):
    vals = [env(), None, "{not json", env(after=None, op="d"), json.dumps({"payload": {"after": None, "op": "c"}}),
            json.dumps({"payload": {"after": AFTER}})]
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    out = guard_empty(decode_with_guard_flag(df)).collect()
    assert len(out) == 2
    assert {r["op"] for r in out} == {"c", None}


def test_cast_times_exact(spark):
    out = cast_times(drop_deletes(decode(spark, [env()])), ntz=True).first()
    assert str(out["date_debut"]) == "2023-11-14 22:13:20"
    assert str(out["date_fin"]) == "2023-11-14 23:13:20"
    assert "op" not in out.asDict() and out["ingested_at"] is not None


def test_distance_types(spark):
    """What a distance may look like on the wire, its value, and whether it is told as unreadable."""
    cases = {"12": (12, False), "-5": (-5, False), "null": (None, False), '"12"': (None, True), "12.5": (None, True), "12.0": (None, True),
             "1e2": (None, True), "3000000000": (None, True), "true": (None, True), "{}": (None, True), '""': (None, True)}
    values = [env().replace('"distance_m": 1200', f'"distance_m": {raw}') for raw in cases] + [env().replace('"distance_m": 1200, ', "")]
    out = decode_envelope(spark.createDataFrame([(v,) for v in values], "value string"), unreadable=True).collect()
    assert [(r["distance_m"], r["distance_illisible"]) for r in out] == [*cases.values(), (None, False)]
    assert all(r["id"] == 1 and r["sport_type"] == "Tennis" for r in out)


def test_first_arrival_wins(spark):
    """Of several images of one key the change that came first stays, by time, then by its place in the log."""
    from vitalflow.operators.cdc import decode_changes
    from vitalflow.operators.dedup import dedup_batch
    place = lambda ms, lsn: {"ts_ms": ms + 9, "source": {"ts_ms": ms, "lsn": lsn}}
    vals = [env(after={**AFTER, "distance_m": 1}, op="u", **place(5, 3)), env(after={**AFTER, "distance_m": 900}, **place(5, 2)),
            env(after={**AFTER, "distance_m": None}, op="u", **place(6, 1)), env(after={**AFTER, "distance_m": 0})]
    df = spark.createDataFrame([(v,) for v in vals], "value string").repartition(3)
    rows = dedup_batch(decode_changes(df, ntz=True, arrival=True)).collect()
    assert [(r["distance_m"], r["change_ms"], r["log_position"]) for r in rows] == [(900, 5, 2)]
