"""Conversation repair against a plain search over edits, row by row."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalflow.llm import repair
from vitalflow.llm.common import read

from .conftest import SF

TURNS = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
MOVES = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}


def search(rows):
    """(cost, audit, repaired turns) of (role, text, fault) rows: the least (cost, audit) per state, forwards."""
    def inserted(best):
        todo = list(best)
        while todo:
            s = todo.pop()
            cost, audit, out = best[s]
            t, role = MOVES[s]
            new = (cost + 2, audit + "I", out + [(role, "")])
            if t not in best or new[:2] < best[t][:2]:
                best[t] = new
                todo.append(t)
        return best

    best = {0: (0, "", [])}
    for role, text, fault in rows:
        after = {}

        def put(s, new):
            if s not in after or new[:2] < after[s][:2]:
                after[s] = new
        for s, (cost, audit, out) in inserted(best).items():
            put(s, (cost + 3, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((s, role[:1]))
            if keep is not None:
                put(keep, (cost + more, audit + "K", out + [(role, text)]))
            t, to = MOVES[s]
            put(t, (cost + 2 + more, audit + "R", out + [(to, text)]))
        best = after
    best = inserted(best)
    return min((best[s] for s in (0, 3) if s in best), key=lambda x: x[:2])


def expected(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, [])
        role, text = (" " if x is None else x for x in (role, text))
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if code == 1:
            text = ""
        if code == 2:
            text = "".join(x for x in text if x not in ".!?")
        if code == 4:
            role = "user"
        convs[c] += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, faulty, pairs = set(), [], 0
        for _, role, text in turns:
            bare = text.strip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faulty.append((role, text, fault))
        for x, y in zip(turns, turns[1:]):
            pairs += x[1][:1] + y[1][:1] not in ("su", "ua", "au")
        at = [t for t, _, _ in turns if t is not None]
        cost, audit, fixed = search(faulty)
        n = lambda f: sum(x == f for _, _, x in faulty)
        out[c] = (max(at) - min(at) + 1 - len(set(at)) if at else 0, n("blank"), n("duplicate"), n("truncated"), pairs, cost,
                  audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())
    return out


def got(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
           for r in rows}
    assert len(out) == len(rows)
    return out


def made(seed, convs=60, longest=40):
    rng = np.random.default_rng(seed)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "agent", "unknown"]
    texts = ["Yes.", "No!", "so it goes", "", None, " \t", "What?", "é ü. ", "Yes. \n", "...", "and"]
    return [(int(c), int(t) if t % 9 else None, roles[rng.integers(len(roles))], texts[rng.integers(len(texts))])
            for c in range(convs) for t in rng.permutation(rng.integers(1, longest) + 20)[: rng.integers(1, longest)]]


@pytest.mark.parametrize("chunk", [repair.CHUNK, 3])
def test_query_equals_search(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    rows = [r for r in made(5) if r[1] is not None]    # one row per turn, so the order is fixed
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())
    rows += [(-5, 0, "user", "Hi."), (None, 0, "user", "Hi."), (None, None, "assistant", "Yes."), (7000, None, None, None)]
    assert got(repair.query(spark.createDataFrame(rows, TURNS))) == expected(rows)


def test_query_equals_search_on_the_table(spark):
    df = read(spark, SF, "conversations")
    assert got(repair.query(df)) == expected([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_rows(seed):
    """Long runs of one symbol, unrolled by halves and from every state, equal the search row by row."""
    rng = np.random.default_rng(seed)
    of = {0: ("s", ""), 1: ("u", ""), 2: ("a", ""), 3: ("x", ""), 4: ("s", "truncated"), 5: ("u", "truncated"),
          6: ("a", "truncated"), 7: ("x", "truncated"), 8: ("u", "blank")}
    for _ in range(25):
        syms = rng.integers(0, 9, rng.integers(1, 8)).tolist()
        lens = (rng.integers(1, 30, len(syms)) ** rng.integers(1, 3, len(syms))).tolist()
        rows = [(of[s][0], "", of[s][1]) for s, n in zip(syms, lens) for _ in range(n)]
        cost, audit, _ = search(rows)
        letters, state = repair.unroll(syms, lens, repair.START, repair.AT_END)
        assert letters + repair.closing(state) == audit
        assert int(repair.times(repair.run_matrix(syms, lens), repair.AT_END)[repair.START]) == cost


def test_repeated_rows_and_hot_conversation(spark):
    """One conversation with most rows, cut into many chunks; equal rows are neighbours and duplicates."""
    rows = [(1, t, "user" if t % 2 else "assistant", f"Text {t}.") for t in range(1500)] + [(1, 3, "user", "Text 3.")] * 4
    assert got(repair.query(spark.createDataFrame(rows, TURNS).repartition(5))) == expected(rows)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")], TURNS)
    odd = df.select("*", F.lit(1), F.lit(2), F.lit("x")).toDF(*df.columns, "n", "AT", "Text")
    assert got(repair.query(odd)) == got(repair.query(df))
    none = repair.query(df.limit(0))
    assert none.count() == 0 and dict(none.dtypes)["cost"] == "bigint"


def test_real_output(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "Yes."), (1, 1, "user", "Why")], TURNS).withColumn("n", F.lit(1))
    light = repair.symbols(df)
    out = repair.repaired(df, repair.audits(light)).collect()
    assert [(r.edit, r.role, r.text) for r in out] == [(e, r, x) for e, r, x in zip(
        repair.audits(light).first()["audit"].replace("D", ""), *zip(*search([("assistant", "Yes.", ""), ("user", "Why", "truncated")])[2]))]
