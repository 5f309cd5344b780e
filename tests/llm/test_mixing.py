"""Apportionment against handing out blocks one by one; the mix's totals, limits and order."""

from __future__ import annotations

import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from vitalflow.llm import mixing


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12), st.integers(0, 300), st.data())
def test_highest_quotients(votes, seats, data):
    most = data.draw(st.lists(st.integers(0, 200), min_size=len(votes), max_size=len(votes)))
    given_ = [0] * len(votes)
    for _ in range(seats):
        q = [v / (2 * n + 1) if v and n < m else -1 for v, n, m in zip(votes, given_, most)]
        if max(q) > 0:
            given_[q.index(max(q))] += 1
    assert mixing.apportion(np.array(votes, float), seats, np.array(most)).tolist() == given_


def test_targets():
    assert mixing.targets(np.array([100.0, 100, 100]), np.array([1.0, 2, 3])).tolist() == [50, 100, 150]
    t = mixing.targets(np.array([10.0, 1000, 1000]), np.array([3.0, 1, 2]))  # the first stops at 30
    assert t[0] == 30 and abs(t.sum() - 2010) < 1e-9 and abs(t[2] / t[1] - 2) < 1e-9
    assert mixing.targets(np.zeros(2), np.ones(2)).tolist() == [0, 0]


def test_mix(docs_of):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(60))) + rng.choice(["", " ", "\t"]), "en",
             rng.choice(["a", "a", "a", "b", "é", None])) for i in range(400)]
    rows += [(900, None, "en", "a"), (901, "", "en", "zz"), (902, " \n ", "en", "b")]
    docs = docs_of(rows)
    got = {r["doc_id"]: r for r in mixing.query(docs).collect()}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows}
    assert {i: r["size"] for i, r in got.items()} == size
    names = sorted({s for *_, s in rows if s}) + [None]
    own = {s: sum(size[i] for i, _, _, x in rows if x == s) for s in names}
    target = dict(zip(names, mixing.targets(np.array([own[s] for s in names], float), np.array([1 + k % 3 for k in range(len(names))], float))))
    for i, _, _, s in rows:
        assert got[i]["source_size"] == own[s] and abs(got[i]["target"] - target[s]) < 1e-6
        assert 0 <= got[i]["taken"] <= 3 * size[i]
    for s in names:
        assert abs(sum(got[i]["taken"] for i, _, _, x in rows if x == s) - target[s]) <= mixing.BLOCK
    again = {r["doc_id"]: r["taken"] for r in mixing.query(docs.repartition(7)).collect()}
    assert again == {i: r["taken"] for i, r in got.items()}
    # the documents of the mix hold just the words taken
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = {}
    for r in mixed.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert words == {i: r["taken"] for i, r in got.items() if r["taken"]}


def test_odd_rows(odd):
    docs = odd()
    assert mixing.query(docs).count() == 11 and mixing.query(docs.limit(0)).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.first_words(" a  b c", 2) == " a  b" and mixing.first_words("a", 5) == "a" and mixing.first_words("a", 0) == ""
