"""Secrets and personal data against plain Python regular expressions."""

from __future__ import annotations

import hashlib
import random
import re

from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from vitalflow.llm import personal, secrets


def luhn(d):
    return sum((int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_secrets(t):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def base_personal(t):
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


def sha(found):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in found).encode()).hexdigest()


SECRETS = ["password = 'abcdef'", "Token:abc token=abcdefgh", "secret=token=abcdefgh", "api_key: \"k-1/2+3\"", "apikey=short",
           "AKIA" + "A1" * 8, "AKIAAKIA" + "B" * 15, "AKIA" + "C" * 15, "0123456789abcdef01234567", "0123456789abcdef0123456",
           "😀é passwd :  x_y.z-1", "ßecret=abcdefgh", "ſecret=abcdefgh", "toKen=abcdef", "SECRET" + " " * 30 + "=zzzzzz"]
PERSONAL = ["a@b.c_d@e.f", "x.y+z@host-1.example.org.", "a@b", "1.2.3.4.5.6.7.8", "1.2.3.256", "001.002.000255.9", "1.2.3", "a1.2.3.4b",
            "4539 1488 0343 6467", "4539-1488-0343-6467 12", "4111111111111112", "+1 (663) 555-6869", "+1 2", "+12345678901234567",
            "+1 (212) 555-0100 +1 (212) 555-0101", "é😀 mail: ü.n@x.io", "@@a@b.c@d.e", "12 34-56 78 90 12 34 5"]


def test_secret_spans(docs_of):
    rows = list(enumerate(SECRETS + [" ".join(SECRETS), "\n".join(reversed(SECRETS))]))
    got = {r["doc_id"]: r for r in secrets.report(secrets.scan(docs_of(rows))).collect()}
    for i, t in rows:
        assert got[i]["base_sha256"] == sha(base_secrets(t)), t
        assert got[i]["n_assign"] == sum(k == "assign" for _, _, k, _ in base_secrets(t))


def test_more_secret_kinds(docs_of):
    t = "-----BEGIN RSA PRIVATE KEY----- ghp_" + "zQ" * 18 + " AIza" + "x" * 35
    spans = secrets.report(secrets.scan(docs_of([(1, t)]))).first()["spans"]
    assert [s.split(":")[0] for s in spans.split(",")] == ["private_key", "github", "google"]


def test_trigram_queries():
    assert secrets.trigram_query(r"AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]
    assert secrets.trigram_query(r"(?<![0-9a-f])[0-9a-f]{24,}") == []
    assert secrets.trigram_query("(cat|dog)s?=x") == [[{"cat"}, {"dog"}]] or len(secrets.trigram_query("(cat|dog)s?=x")[0]) == 4
    (assign,) = [q for r in secrets.BASE if r.kind == "assign" for q in [secrets.trigram_query(r.pattern)]]
    words = ["password", "passwd", "secret", "token", "apikey", "api_key"]
    for w in words:  # every keyword satisfies the query
        grams = {w[i:i + 3] for i in range(len(w) - 2)}
        assert all(any(alt <= grams for alt in clause) for clause in assign)


def test_personal_spans(docs_of):
    rows = list(enumerate(PERSONAL + [" ".join(PERSONAL), "\n".join(reversed(PERSONAL))]))
    got = {r["doc_id"]: r for r in personal.report(personal.find_personal(docs_of(rows))).collect()}
    for i, t in rows:
        assert got[i]["base_sha256"] == sha(base_personal(t)), t


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="a1@.+- (4=:tokenAKI\n😀", max_size=60), min_size=30, max_size=30))
def test_random_texts(docs_of, texts):
    rows = list(enumerate(texts))
    p = {r["doc_id"]: r for r in personal.report(personal.find_personal(docs_of(rows))).collect()}
    s = {r["doc_id"]: r for r in secrets.report(secrets.scan(docs_of(rows))).collect()}
    for i, t in rows:
        assert p[i]["base_sha256"] == sha(base_personal(t)) and s[i]["base_sha256"] == sha(base_secrets(t)), t


def test_terms_that_reveal_an_entity(docs_of):
    """A rare word that keeps company with an address is found and taken out; a common word is not."""
    rows = [(i, f"the plain words of text {i} here") for i in range(60)]
    rows += [(100 + i, f"the zanzibar office ann@x.org and\nthe rest {i}") for i in range(3)]
    docs = docs_of(rows)
    found = personal.find_personal(docs)
    spans = {r["doc_id"]: r["spans"] for r in personal.report(found).collect()}
    assert all(not spans[i] for i in range(60))
    assert spans[100] == "reveal:4:12,reveal:13:19,email:20:29,reveal:30:33"  # "and" is as rare here
    clean = {r["doc_id"]: r["text"] for r in personal.sanitise(docs, found).collect()}
    assert clean[101] == "the [reveal] [reveal] [email] [reveal]\nthe rest 1" and clean[5] == rows[5][1]


def test_an_entity_does_not_hide_the_words_beyond_it(docs_of):
    """A context reaches over other entities and what fails to be one, to whole words within 64 code points on the line."""
    rows = [(i, f"the plain words of text {i} here") for i in range(60)]
    rows += [(100 + i, f"zanzibar a{i}@x.org, bob@x.org") for i in range(3)]
    spans = {r["doc_id"]: r["spans"] for r in personal.report(personal.find_personal(docs_of(rows))).collect()}
    assert spans[100] == "reveal:0:8,email:9:17,email:19:28"

    rng, term = random.Random(5), re.compile(r"(?<!\S)[^\W\d_]{3,}(?=[\s.,;:!?]|$)")
    parts = ["word", "\u00e9t\u00e9", "ann@x.org", "bob@x.org,", "10.1.2.3", "1.2.3.999", "x" * 30, "\n", "12 34", "+33 1 23 45 67 89", "\U0001f600 ok."]
    texts = ["", "ann@x.org"] + [" ".join(rng.choice(parts) for _ in range(n)) for n in range(1, 40)]
    texts += ["y" * 60 + " " + "abc " + "z" * n + " ann@x.org " + "z" * n + " def" + tail for n in range(56, 64) for tail in ("", ".", "g")]
    base = personal.base_spans(docs_of(list(enumerate(texts))))
    got = {(r["doc_id"], r["entity"], r["term"], r["start"], r["end"])
           for r in personal._contexts(base).join(base.select("k", "doc_id"), "k").collect()}
    want = set()
    for i, t in enumerate(texts):
        for start, _, kind, end in base_personal(t):
            low, high = t.rfind("\n", 0, start) + 1, (t.find("\n", end) + 1 or len(t) + 1) - 1
            near = [(low + m.start(), low + m.end()) for m in term.finditer(t[low:start]) if low + m.start() >= start - 64]
            near += [(end + m.start(), end + m.end()) for m in term.finditer(t[end:high]) if m.end() <= 64]
            want |= {(i, t[start:end].lower(), t[a:b].lower(), a, b) for a, b in near}
    assert got == want and len(want) > 200


def test_odd_rows(odd):
    for report in (personal.report(personal.find_personal(odd())), secrets.report(secrets.scan(odd()))):
        got = report.collect()
        assert len(got) == 11 and sum(r["doc_id"] is None for r in got) == 2
        assert all(r["spans"] == "" for r in got if r["doc_id"] in (2, 3))
    assert personal.report(personal.find_personal(odd().limit(0))).count() == 0
    assert secrets.report(secrets.scan(odd().limit(0))).count() == 0


def test_very_many_matches_in_one_text(spark):
    """The spans of 40,000 matches equal Python's, within seconds; so do counts at the edges of a stretch."""
    import time

    from vitalflow.llm.common import STRETCH, find_all, spans
    pattern = "[0-9]+"
    texts = ["\u00e9 12,345 x " * n for n in (0, 1, STRETCH // 2, STRETCH // 2 + 1, STRETCH, 20_000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    began = time.time()
    got = {r["i"]: [(s["start"], s["end"], s["hit"]) for s in r["s"]]
           for r in df.select("i", spans(F.col("text"), pattern, find_all(F.col("text"), pattern)).alias("s")).collect()}
    assert time.time() - began < 30
    for i, t in enumerate(texts):
        assert got[i] == [(m.start(), m.end(), m.group()) for m in re.finditer(pattern, t)]
