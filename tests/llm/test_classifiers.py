"""Language and toxicity: held-out accuracy, whole texts, and that only the text decides."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from vitalflow.llm import language, toxicity
from vitalflow.llm.common import read

MID = "/root/testdata/sf0.01"


def test_language_on_held_out_rows(spark):
    docs = read(spark, MID, "documents")
    got = {r["doc_id"]: r for r in language.query(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    out = [i for i, r in got.items() if r["held_out"]]
    assert len(got) == len(truth) and 100 < len(out) < 300
    assert np.mean([got[i]["lang_pred"] == truth[i] for i in out]) > 0.98


def test_language_needs_letters_and_reads_whole_texts():
    counts = np.zeros((language.BUCKETS, 2))
    rows = {0: "the of and that with which " * 20, 1: "der die das und nicht eine " * 20}
    for n, text in rows.items():
        for _, start, points in language.pieces([text]):
            for order in language.ORDERS:
                counts[:, n] += np.bincount(language.grams(points, np.array([len(points)]), order), minlength=language.BUCKETS + 1)[:-1]
    m = language.Model(["en", "de"], counts, np.array([1.0, 1.0]))
    names, scores = m.predict([None, "", "12 !?", "the and that", "nicht die und", "1 " * 300_000 + "der die das und nicht " * 40_000])
    assert names == ["und", "und", "und", "en", "de", "de"] and scores[0] == 0 and min(scores[3:]) > 0.5
    one, many = m.predict(["der und das"]), m.predict(["x y", "der und das", "the of"])
    assert abs(one[1][0] - many[1][1]) < 1e-6  # a text's score does not depend on its batch


def test_letters_are_those_of_unicode():
    m = language.Model(["en"], np.ones((language.BUCKETS, 1)), np.array([1.0]))
    texts = ["\u00bd", "\u2460", "\u00b2 12", "\u2167", "_", "\u00aa", "\u0915", "\u4e2d 1", "\U0001d400", "7 \u02b0"]
    assert m.predict(texts)[0] == ["und"] * 5 + ["en"] * 5


def test_scores_equal_plain_loops():
    """Label from the whole text's posterior, score from at most 100 n-grams of evidence, n-gram by n-gram."""
    rng = np.random.default_rng(4)
    m = language.Model(["a", "b", "c"], rng.integers(0, 50, (language.BUCKETS, 3)).astype(float), np.array([5.0, 90.0, 1.0]))
    texts = ["Short one", "\u00e9t\u00e9 et " * 40, "x", "Long " * 3000, "a b" * 7]
    names, scores = m.predict(texts)
    for text, name, score in zip(texts, names, scores):
        points = np.frombuffer(f" {text.lower()}  ".encode("utf-32-le"), "<u4")
        total, n = np.zeros(3), 0
        for order in language.ORDERS:
            for i in range(len(points) - order + 1):
                total += m.matrix[language.grams(points[i:i + order].copy(), np.array([order]), order)[0]]
            n += len(points)
        assert name == m.languages[int((total + m.prior).argmax())]
        z = np.exp(total * min(n, language.EVIDENCE) / n + m.prior)
        assert abs(score - z[m.languages.index(name)] / z.sum()) < 1e-3


def test_nothing_to_learn_keeps_every_row(spark, docs_of):
    docs = docs_of([(i, f"some words {i}", None, "s") for i in range(20)])
    model = language.train(language.learning_rows(docs))
    assert model.languages == [] and language.keep_identified(docs, model).count() == 20
    assert {r["lang_pred"] for r in language.query(docs).collect()} == {"und"}


def test_language_odd_rows(spark, odd):
    docs = odd()
    got = language.query(docs).collect()
    assert len(got) == 11 and all(r["lang_pred"] in ("und", "en") for r in got)
    assert language.query(docs.limit(0)).count() == 0
    model = language.train(language.learning_rows(docs))
    assert language.keep_identified(docs, model).columns == docs.columns


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = read(spark, sf, "labels")
    docs = read(spark, sf, "documents")
    got = {r["doc_id"]: r for r in toxicity.query(docs, labels).collect()}
    out = [(got[r["doc_id"]]["predicted"], r["toxic"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    hit = sum(p and y for p, y in out)
    assert len(got) == 10000
    assert hit / sum(p for p, _ in out) > 0.85 and hit / sum(y for _, y in out) > 0.7


def test_toxicity_odd_rows(spark, odd):
    docs = odd()
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 0), (5, 1), (None, 1), (6, None)], "doc_id bigint, toxic int")
    got = toxicity.query(docs, labels).collect()
    assert len(got) == 11 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.query(docs.limit(0), labels).count() == 0
    alone = toxicity.query(docs, labels.where(F.col("toxic") == 0)).collect()
    assert {r["predicted"] for r in alone} == {0}


def test_long_texts_are_scored_whole():
    rng = np.random.default_rng(1)
    plain = [" ".join(f"w{rng.integers(400)}" for _ in range(30)) for _ in range(120)]
    bad = [f"{t} vile {t}" for t in plain[:60]]
    texts = toxicity.words_of(plain + bad)
    m = toxicity.Model(texts, np.array([0.0] * 120 + [1.0] * 60), ["en"] * 180, np.array([1000.0, 500.0]))
    long = " ".join(plain[:40] * 120)
    s = m.score([plain[0], bad[0], long, long + " vile", "", None])
    assert s[0] < 0.5 < s[1] and s[2] < 0.5 < s[3] and s[4] == s[5]


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """Counts and thresholds equal those over all labelled rows outside the fold, which are more than were once sampled."""
    sf = "/root/testdata/sf0.1"
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels").where("toxic IS NOT NULL")
    monkeypatch.setattr(toxicity, "EPOCHS", 0)
    monkeypatch.setattr(toxicity, "LEARNER_ROWS", 500)
    model = toxicity.train(docs, labels)
    rows = docs.join(labels.select("doc_id", "toxic"), "doc_id").where(~language.held_out(F.col("doc_id"))).select(
        "text", "lang", "toxic", (F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(5)) == 0).alias("apart")).collect()
    assert sum(not r["toxic"] for r in rows) > 2600
    texts, label = toxicity.words_of([r["text"] for r in rows]), np.array([float(r["toxic"]) for r in rows])
    apart = np.array([r["apart"] for r in rows])
    plain = toxicity.Model([], np.zeros(0), [], np.zeros(2))
    plain._fit_languages(texts, [r["lang"] for r in rows])
    assert plain.names == model.names and np.array_equal(plain.words, model.words)
    learn = [t for t, x in zip(texts, apart) if not x]
    net = toxicity._open_net(toxicity._seen(learn, label[~apart]), np.bincount(label[~apart].astype(int)))
    assert np.allclose(net.table, model.net.table, atol=1e-6)
    check = [t for t, x in zip(texts, apart) if x]
    raw, named, ones = model._raw(check), model._languages(check), np.ones(len(check))
    plain._set_thresholds(raw, label[apart], named, ones, ones)
    assert np.abs(plain.thresholds - model.thresholds).max() < 0.01


def test_a_net_learns_in_partitions(spark):
    """Places go out and back unchanged, and one round moves the words of the rows alone."""
    texts, label = toxicity.words_of(["plain words here", "a vile word", "plain again", "vile it is"] * 40), np.array([0.0, 1, 0, 1] * 40)
    n = np.bincount(label.astype(int))
    a, b = (toxicity.Learner(toxicity._open_net(toxicity._seen(texts, label), n), n) for _ in range(2))
    before = a.places()
    a.learn(texts, label, np.random.default_rng(1))
    moved = np.flatnonzero((a.places() != before).any(1))
    used = set(np.unique(np.concatenate([x for h in texts for x in toxicity.buckets(h)])).tolist())
    assert set(moved[moved < toxicity.BUCKETS].tolist()) <= used and len(moved) > 100
    b.put(moved, a.places()[moved])
    assert np.array_equal(a.places(), b.places())
    b.learn(texts, label, np.random.default_rng(2))
    assert not np.array_equal(a.places(), b.places())
