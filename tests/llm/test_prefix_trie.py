"""The prefix trie against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from vitalflow.llm import ordering, prefix_trie
from vitalflow.llm.common import read

from .conftest import SF

TURNS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def expected(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(turns)] for c, turns in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        seqs[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []
    for p, convs in members.items():
        leaves = saved = 0
        todo = [p]
        while todo:
            q = todo.pop()
            words = len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) if q else 0
            saved += (len(members[q]) - 1) * words
            leaves += q not in children
            todo += children.get(q, [])
        ends = ",".join(str(c) for c in sorted(c for c in convs if seqs[c] == p))
        out.append((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), len(children.get(p, [])), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def got(df):
    assert tuple(df.columns) == COLUMNS and {t for _, t in df.dtypes[:-1]} == {"bigint"}
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1], r[0]))


def made(seed, convs, longest):
    rng = np.random.default_rng(seed)
    out = []
    for c in sorted(set(rng.integers(-50, 200, convs).tolist())):
        n = int(rng.integers(1, longest))
        for t in range(n):
            text = f"words {'x ' * int(rng.integers(1, 4))}{rng.integers(2) if t else 0}" if rng.random() < 0.9 else None
            out.append((c, t if t else None, "user" if t % 2 == 0 else "assistant", text))
    return out


def test_query_equals_dictionary(spark):
    rows = made(3, 120, 12) + [(None, 1, "user", "no id"), (199, 0, None, None), (41, 7, "user", "alone")]
    rows = list({r[:2]: r for r in rows}.values())
    assert got(prefix_trie.query(spark.createDataFrame(rows, TURNS).repartition(4))) == expected(rows)


def test_query_equals_dictionary_on_the_table(spark):
    df = read(spark, SF, "conversations")
    assert got(prefix_trie.query(df)) == expected([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_many_copies_and_long_sequences(spark):
    """Hundreds of equal conversations, and two long ones that part late; powers of two and their neighbours as lengths."""
    same = [(20 * c, t, "user", f"t{t} and more") for c in range(300) for t in range(4)]
    long = [(c, t, "user", f"w{t if t < 33 or c == 10000 else -t}") for c in (10000, 10020) for t in range(65)]
    edge = [(20 * (600 + n), t, "user", "e") for n in (1, 2, 3, 4, 7, 8, 9, 16, 17) for t in range(n)]
    rows = same + long + edge
    assert got(prefix_trie.query(spark.createDataFrame(rows, TURNS).repartition(3))) == expected(rows)


def test_repeated_rows_are_turns(spark):
    rows = [(20, 1, "user", "a b")] * 3 + [(40, 1, "user", "a b")] * 2
    assert got(prefix_trie.query(spark.createDataFrame(rows, TURNS))) == expected(rows)


def test_turnless_empty_and_clashing_columns(spark):
    lone = [(c, 0, "user", "Hi.") for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4]
    df = spark.createDataFrame(lone, TURNS)     # the family's first conversation is absent, so nothing is left
    assert got(prefix_trie.query(df)) == expected(lone) and prefix_trie.query(df).count() == 1
    assert prefix_trie.query(df.limit(0)).count() == 0
    rows = made(8, 20, 5)
    df = spark.createDataFrame(list({r[:2]: r for r in rows}.values()), TURNS)
    odd = df.select("*", *[F.lit("x")] * 6).toDF(*df.columns, "n", "pos", "rep", "B", "Text", "h")
    assert got(prefix_trie.query(odd)) == got(prefix_trie.query(df))


def test_pieces_of_a_digest(spark, monkeypatch):
    monkeypatch.setattr(ordering, "PIECE", 3)
    df = spark.range(25).selectExpr("id % 2 AS g", "id - 12 AS v").repartition(4)
    out = {r.g: r.sha256 for r in ordering.ascending_sha256(df, ["g"], "v", "test-digest").collect()}
    for g in (0, 1):
        text = ",".join(str(i - 12) for i in range(25) if i % 2 == g)
        assert out[g] == hashlib.sha256(text.encode()).hexdigest()
