"""The Jaccard join against all pairs, with families of near copies beyond a posting list's bound."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest

from vitalflow.llm import ngram_join
from vitalflow.llm.components import components
from vitalflow.session import scratch_path


def brute(rows, words, percent):
    sets, root = [], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for _, t in rows:
        w = (t or "").encode().lower().split()
        n = min(words, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set())
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


def family(rng, n, length, edits, tag):
    base = [f"{tag}{rng.randrange(500)}" for _ in range(length)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(length)] = f"{tag}new{rng.random()}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_components_equal_all_pairs(docs_of, words, percent):
    rng = random.Random(words)
    texts = family(rng, 90, 60, 5, "a") + family(rng, 8, 200, 30, "b") + family(rng, 40, 100, 12, "c")
    texts += [f"alone {i} " + " ".join(f"z{rng.randrange(10**6)}" for _ in range(rng.randrange(40))) for i in range(60)]
    texts += [texts[0]] * 5 + ["", None, " \t", "one", "ONE", "one two", "one  two", "é É"]
    rng.shuffle(texts)
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(docs_of(rows), words, percent).collect()}
    assert got == brute(rows, words, percent)


def test_prefixes_share_enough():
    """Any two sets that link share at least the lesser m of prefix shingles."""
    rng = np.random.default_rng(3)
    classes = rng.integers(0, 40, ngram_join.BUCKETS).astype(np.uint8)
    cost = 2.0 ** (np.arange(256) / 8)
    pool = rng.integers(0, 2**63, 400).astype(np.uint64)
    common = np.sort(ngram_join.order_keys(pool, classes, np.zeros(0, np.int64)))
    for _ in range(300):
        n = int(rng.integers(1, 200))
        a = np.unique(np.concatenate([rng.integers(0, 2**63, n).astype(np.uint64), pool[rng.random(400) < rng.random() / 2]]))
        keep = a[rng.random(len(a)) < rng.uniform(0.8, 1)]
        b = np.unique(np.concatenate([keep, rng.integers(0, 2**63, int(rng.integers(0, 1 + n // 10))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 80 * (len(a) + len(b) - both):
            (pa, ma), (pb, mb) = (ngram_join.prefix(ngram_join.order_keys(s, classes, common), cost, 80) for s in (a, b))
            least = -(-80 * (len(a) + len(b)) // 180)  # shared shingles that the similarity demands
            more = min(least - (-(-80 * len(s) // 100)) + m for s, m in ((a, ma), (b, mb)))
            assert len(np.intersect1d(pa, pb)) >= max(min(ma, mb), more)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 5000), (7, 3)]
    got = {r["u"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(101)} | {i: 1000 for i in range(1000, 1300)}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_keep_one(docs_of):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(5, long), (3, long + " end"), (9, long), (3, long + " end"), (4, "another text of some words here"), (6, ""), (7, None)]
    kept = ngram_join.keep_one(docs_of(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 6, 7]


def test_odd_rows(odd):
    got = ngram_join.join(odd()).collect()
    assert len(got) == 11 and sum(r["root"] is None for r in got) == 4
    assert ngram_join.join(odd().limit(0)).count() == 0
    assert len(ngram_join.keep_one(odd()).columns) == len(odd().columns)


def test_few_keys_make_few_files(spark, docs_of):
    """The files written follow the rows, not the number of shuffle partitions: each costs an executor some processes."""
    rng = random.Random(7)
    texts = family(rng, 90, 60, 5, "a") + family(rng, 60, 100, 5, "b") + family(rng, 20, 60, 3, "c") * 3
    rows = list(enumerate(texts))
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    top = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    old = set(top.iterdir())
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(docs_of(rows), 3, 90).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute(rows, 3, 90)
    files = {}
    for p in set(top.iterdir()) - old:
        name = p.name.rpartition("-")[0].removeprefix("llm-")
        files[name] = max(files.get(name, 0), len(list(p.glob("part-*"))))
    few = {"set-classes", "heavy-postings", "heavy-counts", "candidates", "homes", "home-tokens", "needed-texts", "links",
           "star-least", "large-star", "small-star", "set-roots", "component-ids"}
    assert few <= set(files) and {k: n for k, n in files.items() if k in few and n > 1} == {}


def test_hashing_works_in_little_space():
    """Word hashes of megabytes of text, in short texts or a long one, take a few megabytes beside the hashes themselves."""
    import tracemalloc

    from vitalflow.llm import hashing
    hashing.release()
    texts = [b"some words of a text " * 150] * 1000 + [b"one long text " * 100_000]
    tracemalloc.start()
    got = hashing.word_hashes(texts)
    now, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert [len(h) for h in got] == [750] * 1000 + [300_000]
    assert most - sum(h.nbytes for h in got) < 32 << 20
