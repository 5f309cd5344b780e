"""Spaced seeds: substitutions, short items, blocks of test hashes."""

from __future__ import annotations

import random
from itertools import combinations

from vitalflow.llm import decontaminate as d


def words(n, tag):
    return [f"{tag}{i}" for i in range(n)]


def run(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    return {r["doc_id"]: (r["contaminated"], r["items"], r["agree"]) for r in d.flag(docs, bench).collect()}


def test_substituted_passages_are_found(spark, docs_of):
    item = words(40, "q")
    sub = list(item)
    for i in range(3, 40, 9):
        sub[i] = "other"
    half = words(30, "x") + item[10:32] + words(30, "y")
    rows = [(1, " ".join(words(50, "c"))), (2, "Intro, " + " ".join(item).upper() + "!"), (3, " ".join(words(9, "z") + sub)),
            (4, " ".join(half)), (5, " ".join(words(20, "k") + item[:12])), (6, ""), (7, None)]
    got = run(spark, docs_of(rows), [(11, " ".join(item)), (12, "too short an item"), (13, None), (14, "")])
    assert got[1] == (False, "", 0) and got[6] == got[7] == (False, "", 0)
    assert got[2] == (True, "11", 20) and got[4] == (True, "11", 20)
    assert got[3][:2] == (True, "11") and 15 <= got[3][2] < 20
    assert got[5] == (False, "", 0)  # 12 words are less than three quarters of a window


def test_blocks_of_test_hashes_give_the_same(spark, docs_of, monkeypatch):
    items = [(i, " ".join(words(25, f"i{i}x"))) for i in range(12)]
    rows = [(100 + i, f"start {t} end") for i, t in items[::2]] + [(1, "clean words " * 20)]
    whole = run(spark, docs_of(rows), items)
    monkeypatch.setattr(d, "BLOCK", 100)
    assert run(spark, docs_of(rows), items) == whole and sum(x[0] for x in whole.values()) == 6


def test_removal_keeps_clean_rows_and_columns(spark, odd):
    bench = spark.createDataFrame([(1, "no words of these texts are in here at all so nothing can ever be found")], "item_id bigint, text string")
    kept = d.remove_contaminated(odd(), bench)
    assert kept.columns == odd().columns and kept.count() == 11
    assert len(d.flag(odd(), bench).collect()) == 11
    assert d.flag(odd().limit(0), bench).count() == 0
    assert d.flag(odd(), bench.limit(0)).where("contaminated").count() == 0


def test_short_items_match_whole(spark, docs_of):
    rows = [(1, "So what is the boiling point of lead, he asked"), (2, "what is the melting point of lead"), (3, "Bleischmelze"),
            (4, "are you sure? forty two, yes"), (5, "two forty"), (6, " ".join(words(30, "a")) + " Forty two")]
    items = [(11, "What is the boiling point of lead?"), (12, "Forty-two."), (13, "Bleischmelze"), (14, "..."), (15, None)]
    got = run(spark, docs_of(rows), items)
    assert got == {1: (True, "11", 7), 2: (False, "", 0), 3: (True, "13", 1), 4: (True, "12", 2), 5: (False, "", 0),
                   6: (True, "12", 2)}
    whole = d.BLOCK
    try:
        d.BLOCK = 1
        assert run(spark, docs_of(rows), items) == got
    finally:
        d.BLOCK = whole


def test_scripts_without_spaces(spark, docs_of):
    rows = [(1, "你知道吗？水的沸点是多少？很简单。"), (2, "水的熔点是多少"), (3, "彼は東京タワーの高さは何メートルですかと聞いた"),
            (4, "คำถาม เมืองหลวงของไทยคืออะไร ครับ"), (5, "水 de 水"), (6, "เมืองหลวงของไทยคืออะเร")]
    items = [(21, "水的沸点是多少"), (22, "東京タワーの高さは何メートルですか"), (23, "เมืองหลวงของไทยคืออะไร"), (24, "กี่"), (25, "水的")]
    got = run(spark, docs_of(rows), items)
    assert [got[i][1] for i in (1, 2, 3, 5)] == ["21,25", "25", "22", ""] and got[1][2] == 7
    assert got[4][:2] == (True, "23")


def test_items_without_an_id(spark, docs_of):
    text = " ".join(words(15, "n"))
    got = run(spark, docs_of([(1, text), (2, "short one"), (3, "clean")]), [(None, text), (None, "short one"), (None, None)])
    assert [got[i][0] for i in (1, 2, 3)] == [True, True, False] and got[1][1] != got[2][1]


def test_masks_hit_every_accepted_pattern():
    at = [[i for i, c in enumerate(m) if c == "1"] for m in d.MASKS]
    for n in range(d.LEAST, d.WINDOW + 1):
        for gone in map(set, combinations(range(n), n // 4)):
            assert any(not gone.intersection(p + i for i in a) for m, a in zip(d.MASKS, at) for p in range(n - len(m) + 1))


def aligned(item, text):
    """Most agreeing tokens in a window over all alignments, without seeds; 0 if below three quarters."""
    width, best = min(d.WINDOW, len(item)), 0
    for at in range(1 - len(item), len(text)):
        same = [0 <= at + i < len(text) and text[at + i] == w for i, w in enumerate(item)]
        best = max([best, *(sum(same[i:i + width]) for i in range(len(item) - width + 1))])
    return best if best * 4 >= width * 3 else 0


def test_recall_against_all_alignments(spark, docs_of):
    rng = random.Random(5)
    items = [(i, words(n, f"i{i}x")) for i, n in enumerate([11, 12, 13, 15, 16, 19, 20, 27, 60])]
    texts = []
    for _, item in items:
        for step in (4, 5, 9):  # periodic substitutions, at every phase
            texts += [["new" if i % step == phase else w for i, w in enumerate(item)] for phase in range(step)]
        for _ in range(12):
            gone = set(rng.sample(range(len(item)), len(item) // 4))
            texts.append(["new" if i in gone else w for i, w in enumerate(item)])
        texts += [item[len(item) // 5:], item[: -(len(item) // 5)]]
    texts = [words(rng.randrange(9), "a") + t + words(rng.randrange(9), "b") for t in texts]
    got = run(spark, docs_of([(i, " ".join(t)) for i, t in enumerate(texts)]), [(i, " ".join(t)) for i, t in items])
    want = [{i: s for i, item in items if (s := aligned(item, t))} for t in texts]
    assert sum(map(bool, want)) > 150
    assert [got[n] for n in range(len(texts))] == [
        (bool(w), ",".join(map(str, sorted(w))), max(w.values(), default=0)) for w in want]
