"""Structured Streaming behaviour: watermark dedup, future gate, restart, one-query routing, notifier."""

from __future__ import annotations

import datetime as dt
import json
import os
import shutil

from pyspark.sql import functions as F

from vitalflow.operators.cdc import decode_changes
from vitalflow.params import Params
from vitalflow.sources import versions
from vitalflow.sources.cdc import RECORD_SCHEMA, read_cdc_stream, write_records
from vitalflow.streaming.ingest import (Totals, await_end, compact, dedup_stream, read_day_counts, read_routes,
                                        reconcile, start_ingest)
from vitalflow.streaming.notifier import start_notifications

T = 1_700_000_000_000_000  # 2023-11-14 22:13:20 UTC
H = 3_600_000_000
Y3000 = 32_503_680_000_000_000  # 3000-01-01 UTC


def env(i, emp, start, sport="Tennis", dist=None, end=None, comment=None, op="c"):
    after = {"id": i, "id_salarie": emp, "date_debut": start, "sport_type": sport, "distance_m": dist,
             "date_fin": end, "commentaire": comment}
    return json.dumps({"payload": {"before": None, "after": after, "op": op}})


BATCHES = [
    [env(1, 1, T), env(2, 1, T), env(3, 1, T - 100 * H), env(20, 1, None), env(21, 1, None)],
    [env(4, 2, T - 100 * H), env(5, 1, T - H), env(6, 1, T), env(22, 1, None)],
    [env(7, 1, Y3000)],
    [env(8, 1, T + 10 * H)],
    [env(9, 1, T + 11 * H)],
]


def write_files(folder, batches, start=0):
    """One file per batch; increasing modification times fix the order the source reads them in."""
    import time
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 1000
    for n, lines in enumerate(batches, start=start):
        path = os.path.join(folder, f"part-{n:04d}.json")
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(path, (base + 10 * n, base + 10 * n))


def run_dedup(spark, tmp_dir, gate):
    src = os.path.join(tmp_dir, "src")
    write_files(src, BATCHES)
    raw = read_cdc_stream(spark, src, max_files_per_trigger=1)
    rows = decode_changes(raw)
    out = dedup_stream(rows, watermark="2 hours", gate_future_s=300 if gate else None)
    seen = []

    def collect(df, batch_id):
        seen.append((batch_id, sorted(r["id"] for r in df.select("id").collect())))

    with Totals(spark) as totals:
        q = (out.writeStream.foreachBatch(collect).option("checkpointLocation", os.path.join(tmp_dir, "ck"))
             .trigger(availableNow=True).start())
        await_end(q)
        return seen, totals.of(q)


def test_watermark_dedup_reference_form(spark, tmp_dir):
    seen, totals = run_dedup(spark, tmp_dir, gate=False)
    ids = [i for _, b in seen for i in b]
    by_batch = dict(seen)
    assert len([i for i in by_batch[0] if i in (1, 2)]) == 1 and 3 in by_batch[0]
    assert len({20, 21} & set(by_batch[0])) == 1   # undated rows are repeats by key, too
    assert sorted(by_batch[1]) == [4, 5]          # late filter lags one batch; 22 repeats 20
    assert by_batch[2] == [7] and by_batch[3] == [8]
    assert 9 not in ids                            # poisoned watermark: T+11h dropped as late
    assert totals["late"] >= 1


def test_future_gate_keeps_later_rows(spark, tmp_dir):
    seen, _ = run_dedup(spark, tmp_dir, gate=True)
    ids = [i for _, b in seen for i in b]
    assert 7 in ids and 8 in ids and 9 in ids


def test_ingest_routes_once_and_restarts(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, n) for n in ("src", "out", "ck"))
    first = [[env(1, 1, T, "Course à pied", 5000), env(2, 1, T, "Course à pied", 5000),
              env(3, None, T, "Tennis"), env(4, 1, T + H, "Triathlon", 20000), env(5, 1, None, "Tennis"),
              json.dumps({"payload": {"after": None, "op": "d"}}), "{not json"]]
    write_files(src, first)
    p = Params(as_of=dt.datetime(2030, 1, 1))
    q = start_ingest(spark, src, out, ck, params=p, available_now=True)
    q.awaitTermination(180)
    got = {r["id"]: r["route"] for r in read_routes(spark, out).collect()}
    assert set(got) in ({1, 3, 4, 5}, {2, 3, 4, 5})
    assert got.get(1, got.get(2)) == "valid"
    assert got[3] == "quarantine" and got[4] == "quarantine" and got[5] == "quarantine"
    reasons = {r["id"]: r["reasons"] for r in read_routes(spark, out, "quarantine").collect()}
    assert reasons[4] == "distance_above_cap" and reasons[5] == "date_debut_absente"
    # restart: a repeat of an already-ingested key is dropped, a new row goes through
    write_files(src, [[env(10, 1, T, "Course à pied", 5000), env(11, 7, T + 2 * H, "Vélo", 20000)]], start=1)
    q = start_ingest(spark, src, out, ck, params=p, available_now=True)
    q.awaitTermination(180)
    all_rows = read_routes(spark, out).collect()
    ids = sorted(r["id"] for r in all_rows)
    assert 10 not in ids and 11 in ids
    assert len(ids) == 5
    batches = {r["batch_id"] for r in all_rows}
    assert len(batches) == 2 and 0 in batches  # a no-data batch may advance the watermark in between


def test_ingest_batch_equals_batch_twin(spark, tmp_dir):
    """One availableNow batch over derived change events equals the batch routing of the same rows."""
    from vitalflow.operators.routing import with_route
    from vitalflow.sources.fixtures import Fixtures
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    src, out, ck = (os.path.join(tmp_dir, n) for n in ("src", "out", "ck"))
    write_records(fx.cdc(), src)
    p = Params(as_of=dt.datetime(2024, 1, 31))
    with Totals(spark) as totals:
        q = start_ingest(spark, src, out, ck, params=p, fmt="records", available_now=True)
        q.awaitTermination(300)
        assert totals.of(q)["input_rows"] == fx.cdc().count()   # one read, tombstones included
    keys = ["id_salarie", "date_debut", "sport_type", "route"]
    streamed = read_routes(spark, out).withColumn("date_debut", F.col("date_debut").cast("timestamp_ntz"))
    rows = decode_changes(read_cdc_stream(spark, src, fmt="records", stream=False), ntz=True)
    twin = with_route(rows.dropDuplicates(keys[:3]), p)
    a = sorted(tuple(map(str, r)) for r in streamed.select(keys).collect())
    b = sorted(tuple(map(str, r)) for r in twin.select(keys).collect())
    assert a == b and len(a) > 900


def test_notifier_stream(spark, tmp_dir):
    src, ck = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "ck")
    write_files(src, [[env(30, 5, T, "Course à pied", 12345, T + 30 * 60_000_000, "top"),
                       env(31, 5, T, "Course à pied", -5), json.dumps({"payload": {"after": None}})]])
    directory = spark.createDataFrame([(5, "Ada Lovelace")], "id_salarie int, nom_complet string")
    got = []
    q = start_notifications(spark, src, directory, ck, writer=lambda df, i: got.extend(df.collect()),
                            available_now=True)
    q.awaitTermination(180)
    msgs = {r["id"]: r for r in got}
    assert set(msgs) == {30, 31}
    assert msgs[30]["type_message"] == "message"
    assert "Ada Lovelace" in msgs[30]["texte"] and "12.3 km" in msgs[30]["texte"]
    assert msgs[30]["texte"].endswith(' ("top")')
    assert msgs[31]["type_message"] == "alerte" and "distance négative (-5 m)" in msgs[31]["texte"]


def test_batch_writer_is_idempotent_on_retry(spark, tmp_dir):
    """A micro-batch written twice (retry after a failure) replaces its folder instead of duplicating rows."""
    from vitalflow.streaming.ingest import route_batch_writer
    rows = decode_changes(spark.createDataFrame([(env(1, 1, T, "Tennis"),), (env(2, None, T, "Tennis"),)],
                                                "value string"))
    write = route_batch_writer(os.path.join(tmp_dir, "out"), Params(as_of=dt.datetime(2030, 1, 1)))
    write(rows, 7)
    write(rows, 7)
    out = read_routes(spark, os.path.join(tmp_dir, "out")).collect()
    assert sorted((r["id"], r["route"], r["batch_id"]) for r in out) == [(1, "valid", 7), (2, "quarantine", 7)]


def test_updates_are_appended_not_applied(spark, tmp_dir):
    """SURVEY 2.L-4: an update with the same (employee, start, sport) is a repeat; a changed sport is a new row."""
    src, out, ck = (os.path.join(tmp_dir, n) for n in ("src", "out", "ck"))
    write_files(src, [[env(1, 1, T, "Tennis", None)],
                      [env(1, 1, T, "Tennis", 500, op="u"), env(1, 1, T, "Vélo", 500, op="u"),
                       env(1, 1, T, "Tennis", None, op="d")]])
    q = start_ingest(spark, src, out, ck, params=Params(as_of=dt.datetime(2030, 1, 1)), available_now=True,
                     max_files_per_trigger=1)
    q.awaitTermination(180)
    got = sorted((r["sport_type"], r["distance_m"]) for r in read_routes(spark, out).collect())
    assert got == [("Tennis", None), ("Vélo", 500)]


def test_new_checkpoint_keeps_earlier_rows(spark, tmp_dir):
    """A second run with a checkpoint of its own adds to the sink; a restart on the first adds nothing."""
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    p = Params(as_of=dt.datetime(2030, 1, 1))
    write_files(src + "1", [[env(1, 1, T, "Tennis")]])
    write_files(src + "2", [[env(2, 2, T, "Tennis")]])
    for n in ("1", "2", "1"):
        await_end(start_ingest(spark, src + n, out, os.path.join(tmp_dir, "ck" + n), params=p, available_now=True))
    rows = read_routes(spark, out).collect()
    assert sorted(r["id"] for r in rows) == [1, 2] and len({r["query"] for r in rows}) == 2
    before = read_routes(spark, out)
    compact(spark, out)
    again = read_routes(spark, out)
    assert sorted(r["id"] for r in again.collect()) == [1, 2] and len(versions.live(spark, out)) == 1
    assert sorted(r["id"] for r in before.collect()) == [1, 2]   # a reader under way keeps its folders
    leaves = {d for d, _, names in os.walk(f"{out}/data/{versions.live(spark, out)[0]}") if any(n.endswith(".parquet") for n in names)}
    assert len(leaves) == 1                                      # one route, one day
    days = {(r["id_salarie"], r["nb"]) for r in read_day_counts(spark, out).collect()}
    assert days == {(1, 1), (2, 1)}
    await_end(start_ingest(spark, src + "1", out, os.path.join(tmp_dir, "ck1"), params=p, available_now=True))
    assert read_routes(spark, out).count() == 2
    compact(spark, out)                                          # now the first batches are deleted
    kept = [d for _, dirs, _ in os.walk(f"{out}/data") for d in dirs if d.startswith("batch_id=")]
    assert read_routes(spark, out).count() == 2 and len(kept) == 2


def test_sink_without_rows_is_an_empty_table(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    write_files(src, [["{not json"]])
    await_end(start_ingest(spark, src, out, os.path.join(tmp_dir, "ck"), available_now=True))
    empty = read_routes(spark, out, "valid")
    assert empty.count() == 0 and {"id", "jour", "route"} <= set(empty.columns)


def test_totals_count_every_batch(spark, tmp_dir):
    """More batches than the progress keeps: input and late rows of all of them are counted."""
    src = os.path.join(tmp_dir, "src")
    write_files(src, [[env(1, 1, T)]] + [[env(10 + n, 1, T - (100 + n) * H)] for n in range(8)])
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with Totals(spark) as totals:
            q = start_ingest(spark, src, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"),
                             available_now=True, max_files_per_trigger=1)
            await_end(q)
            got = totals.of(q)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert (got["input_rows"], got["batches"] >= 9) == (9, True)
    assert got["late"] == 7  # the first old row comes before the watermark has moved
    assert len(q.recentProgress) <= 2


def test_undated_rows_are_deduplicated_by_key(spark, tmp_dir):
    """In one batch, over batches, and after a restart that replays everything; the watermark evicts them in the end."""
    src, out, ck = (os.path.join(tmp_dir, n) for n in ("src", "out", "ck"))
    lines = [env(1, 1, None), env(2, 1, None, dist=5), env(3, 1, Y3000), env(4, 1, None, "Judo")]
    write_files(src, [lines, [env(5, 1, None), env(6, 1, Y3000)]])
    run = lambda: await_end(start_ingest(spark, src, out, ck, available_now=True, max_files_per_trigger=1))
    run()
    write_files(src, [lines], start=2)
    run()
    rows = read_routes(spark, out).collect()
    assert len(rows) == 3 and all(r["route"] == "quarantine" for r in rows)


def test_undated_keys_are_evicted(spark, tmp_dir):
    """State does not grow for ever: a key without event time goes when the watermark passes its arrival."""
    import time
    src = os.path.join(tmp_dir, "src")
    now = int(time.time() * 1e6)
    write_files(src, [[env(1, 1, None), env(2, 2, None)], [env(3, 1, now + 30 * H)], [env(4, 1, now + 30 * H + 1)], [env(5, 1, now + 30 * H + 2)]])
    rows = decode_changes(read_cdc_stream(spark, src, max_files_per_trigger=1))
    out = dedup_stream(rows, watermark="1 hour", gate_future_s=40 * 3600, remember="1 minute")
    with Totals(spark) as totals:
        q = (out.writeStream.foreachBatch(lambda df, i: df.count()).option("checkpointLocation", os.path.join(tmp_dir, "ck"))
             .trigger(availableNow=True).start())
        await_end(q)
        assert totals.of(q)["state_rows"] == 3   # the dated ones


def test_half_written_batch_is_invisible(spark, tmp_dir):
    """Rows without a log entry are not read; a retry of a listed batch changes nothing."""
    src, out, ck = (os.path.join(tmp_dir, n) for n in ("src", "out", "ck"))
    write_files(src, [[env(1, 1, T)]])
    p = Params(as_of=dt.datetime(2030, 1, 1))
    await_end(start_ingest(spark, src, out, ck, params=p, available_now=True))
    listed = versions.live(spark, out)
    shutil.copytree(f"{out}/data/{listed[0]}", f"{out}/data/query=other/batch_id=9")
    assert read_routes(spark, out).count() == 1 and "query=other/batch_id=9" not in versions.live(spark, out)
    assert versions.is_settled(spark, out, listed[0]) and not versions.is_settled(spark, out, "query=other/batch_id=9")


def test_unreadable_distance_is_told(spark, tmp_dir):
    src, p = os.path.join(tmp_dir, "src"), Params(as_of=dt.datetime(2030, 1, 1))
    lines = [env(1, 1, T, dist="12"), env(2, 2, T, dist=12.5), env(3, 3, T, dist=12), env(4, 4, T), env(5, None, T, dist=3_000_000_000)]
    write_files(src, [lines])
    for policy, routes in (("flag", {1: "valid", 2: "valid"}), ("quarantine", {1: "quarantine", 2: "quarantine"})):
        out = os.path.join(tmp_dir, policy)
        await_end(start_ingest(spark, src, out, out + "-ck", params=p, available_now=True, unreadable_policy=policy))
        got = {r["id"]: (r["route"], r["reasons"], r["distance_m"]) for r in read_routes(spark, out).collect()}
        assert got == {1: (routes[1], "distance_unparsable", None), 2: (routes[2], "distance_unparsable", None), 3: ("valid", "", 12),
                       4: ("valid", "", None), 5: ("quarantine", "distance_unparsable,id_salarie_absent", None)}


def test_stream_and_reconciliation_equal_one_batch_run(spark, tmp_dir):
    """However the rows are cut into batches, the late ones come back; a second reconciliation adds nothing."""
    import random
    p = Params(as_of=dt.datetime(2030, 1, 1))
    for seed in range(3):
        rng = random.Random(seed)
        lines = [env(i, rng.choice([1, 2, None]), rng.choice([None, Y3000] + [T + h * H for h in range(-40, 40, 4)]),
                     rng.choice(["Tennis", "Judo"]), rng.choice([None, 5])) for i in range(60)]
        src, out = os.path.join(tmp_dir, f"src{seed}"), os.path.join(tmp_dir, f"out{seed}")
        write_files(src, [lines[i:i + 12] for i in range(0, 60, 12)])
        with Totals(spark) as totals:
            q = start_ingest(spark, src, out, out + "-ck", params=p, available_now=True, max_files_per_trigger=1)
            await_end(q)
            assert totals.of(q)["late"] > 0
        added = reconcile(spark, src, out, params=p)
        keys = lambda df: sorted(repr((r["id_salarie"], r["date_debut"], r["sport_type"], r["route"])) for r in df.collect())
        rows = decode_changes(read_cdc_stream(spark, src, stream=False))
        from vitalflow.operators.routing import with_route
        assert added > 0 and keys(read_routes(spark, out)) == keys(with_route(rows.dropDuplicates(["id_salarie", "date_debut", "sport_type"]), p))
        assert reconcile(spark, src, out, params=p) == 0


def test_day_counts_give_any_lookback(spark, tmp_dir):
    from vitalflow.operators import gold
    from vitalflow.sources.fixtures import Fixtures
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    write_records(Fixtures(spark, "/root/testdata/sf0.001").cdc(), src)
    await_end(start_ingest(spark, src, out, out + "-ck", params=Params(as_of=dt.datetime(2024, 1, 31)), fmt="records", available_now=True))
    rows, days = read_routes(spark, out, "valid"), read_day_counts(spark, out)
    for as_of, back in ((dt.datetime(2024, 1, 31), 7), (dt.datetime(2024, 1, 20, 13), 3), (dt.datetime(2024, 2, 20), 365), (dt.datetime(2025, 1, 1), 1)):
        q = Params(as_of=as_of, lookback_days=back)
        assert sorted(map(tuple, gold.count_from_days(days, q).collect())) == sorted(map(tuple, gold.count_activities(rows, q).collect()))


def test_day_counts_grow_in_files_not_in_one_task(spark, tmp_dir, monkeypatch):
    """The counts of a large batch are aggregated and written by several tasks, a small one's give one file."""
    from pathlib import Path

    from vitalflow.sources.fixtures import Fixtures
    from vitalflow.streaming import ingest
    src, found = os.path.join(tmp_dir, "src"), {}
    write_records(Fixtures(spark, "/root/testdata/sf0.001").cdc(), src)
    for rows_a_file in (1_000_000, 100):
        monkeypatch.setattr(ingest, "COUNTS_PER_FILE", rows_a_file, raising=False)
        out = os.path.join(tmp_dir, f"out{rows_a_file}")
        await_end(start_ingest(spark, src, out, out + "-ck", params=Params(as_of=dt.datetime(2024, 1, 31)), fmt="records", available_now=True))
        files = len(list(Path(out, "counts").rglob("*.parquet")))
        found[rows_a_file] = sorted(read_day_counts(spark, out).select("id_salarie", "jour", "nb").collect())
        assert files == 1 if rows_a_file == 1_000_000 else files > 2
    assert found[100] == found[1_000_000]


def test_tombstones_reach_the_stream(spark, tmp_dir):
    """A record without value is read, decoded to nothing and dropped; key and offset come along."""
    src = os.path.join(tmp_dir, "src")
    when = dt.datetime(2024, 1, 1)
    rows = [("k1", None, 0, 1, when), ("k2", env(1, 1, T), 0, 2, when), (None, "{not json", 1, 3, when)]
    write_records(spark.createDataFrame(rows, RECORD_SCHEMA), src)
    got = read_cdc_stream(spark, src, fmt="records", stream=False)
    assert sorted((r["key"] or "", r["value"] is None, r["offset"]) for r in got.collect()) == [("", False, 3), ("k1", True, 1), ("k2", False, 2)]
    with Totals(spark) as totals:
        q = start_ingest(spark, src, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"), fmt="records", available_now=True)
        await_end(q)
        assert totals.of(q)["input_rows"] == 3
    assert [r["id"] for r in read_routes(spark, os.path.join(tmp_dir, "out")).collect()] == [1]


def test_notifier_keeps_one_directory(spark, tmp_dir):
    """A replaced referential is taken up by the next batch; one stored directory is kept, and none is written without need."""
    from vitalflow.sources.files import exists
    from vitalflow.sources.tables import write_table
    from vitalflow.streaming.notifier import Directory
    ref = os.path.join(tmp_dir, "ref")
    hr = lambda name: spark.createDataFrame([(5, "Ada", name)], "id_salarie int, prenom string, nom string")
    write_table(hr("Byron"), ref)
    d = Directory(spark, ref)
    first, at = d.now(), d._at
    assert first.first()["nom_complet"] == "Ada Byron" and d.now() is first
    write_table(hr("Lovelace"), ref)
    assert d.now().first()["nom_complet"] == "Ada Lovelace" and not exists(spark, at) and exists(spark, d._at)
    d.close()
    assert Directory(spark, os.path.join(tmp_dir, "none")).now() is None


def test_files_of_a_day_are_bounded(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    write_files(src, [[env(n, n, T, "Tennis") for n in range(200)]])
    await_end(start_ingest(spark, src, out, os.path.join(tmp_dir, "ck"), params=Params(as_of=dt.datetime(2030, 1, 1)),
                           available_now=True, files=2))
    files = [f for d, _, names in os.walk(f"{out}/data") for f in names if f.endswith(".parquet")]
    assert 1 <= len(files) <= 2 and read_routes(spark, out, "valid").count() == 200


def test_notifier_survives_huge_distance_and_directory_changes(spark, tmp_dir):
    """An absurd distance is an alert; the directory is read anew for each batch; none at all is a warning."""
    src, ref, out = (os.path.join(tmp_dir, n) for n in ("src", "ref", "out"))
    write_files(src, [[env(1, 5, T, "Tennis", 2147483640)], [env(2, 5, T, "Tennis", 1000)]])
    hr = lambda name: spark.createDataFrame([(5, "Ada", name)], "id_salarie int, prenom string, nom string")
    hr("Byron").write.mode("overwrite").parquet(ref)
    got = []

    def writer(df, batch_id):
        got.extend(df.collect())
        hr("Lovelace").write.mode("overwrite").parquet(ref)

    await_end(start_notifications(spark, src, ref, os.path.join(tmp_dir, "ck"), writer=writer,
                                  available_now=True, max_files_per_trigger=1))
    text = {r["id"]: r["texte"] for r in got}
    assert "Ada Byron" in text[1] and "2147483.6 km déclarés" in text[1] and "Ada Lovelace" in text[2]
    for n in ("a", "b"):  # a new checkpoint adds its messages
        await_end(start_notifications(spark, src, os.path.join(tmp_dir, "missing"), os.path.join(tmp_dir, "ck" + n),
                                      out_root=out, available_now=True))
    rows = spark.read.parquet(out).collect()
    assert sorted(r["id"] for r in rows) == [1, 1, 2, 2] and all("Salarié #5" in r["texte"] for r in rows)


def test_latest_offsets_skip_the_history():
    from vitalflow.sources.cdc import kafka_options
    got = kafka_options("t", "b:1", "latest", 500)
    assert got == {"kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "latest", "maxOffsetsPerTrigger": "500"}
    assert "startingOffsets" not in kafka_options("t", "b:1", "latest", None, stream=False)
