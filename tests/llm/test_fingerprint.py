"""Fingerprints against a plain Python tree, sketch and edit."""

from __future__ import annotations

import hashlib
import re

import xxhash

from vitalflow.llm.fingerprint import BLOCK, SKETCH, fingerprints, report


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def tree(text):
    paragraphs = [md5(p) for p in text.split("\n")]
    sections, run = [], ""
    for h in paragraphs:
        run += h
        if h[0] in "01":
            sections, run = [*sections, run], ""
        else:
            run += ","
    sections = [md5(s) for s in [*sections, run] if s]
    short = set()
    for b in re.findall(r"[^\n]{1,%d}" % BLOCK, text):
        h = xxhash.xxh64_intdigest(b.encode(), 42) >> 32
        short.add(h - (1 << 32) if h >= 1 << 31 else h)
    return hashlib.sha256(",".join(sections).encode()).hexdigest(), sorted(short)[:SKETCH]


def like(a, b):
    if a[0] == b[0]:
        return 1.0
    least = sorted(set(a[1]) | set(b[1]))[:SKETCH]
    j = sum(x in a[1] and x in b[1] for x in least) / len(least) if least else 0.0
    return 2 * j / (1 + j)


def test_against_brute_force(docs_of):
    rows = [(i * 7 % 101, "".join(f"paragraph {j * i % 13} of words\n" for j in range(i % 40)) + f"end {i} é😀") for i in range(60)]
    rows += [(200, ""), (201, None), (202, rows[5][1])]
    got = {r["doc_id"]: r for r in report(fingerprints(docs_of(rows))).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    assert len(got) == len(rows)
    for n, (i, t) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        m = len(t) // 3
        edited = t[:len(t) - m] + after[:m]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (tree(t)[0], tree(edited)[0])
        assert abs(r["near_edited"] - like(tree(t), tree(edited))) < 1e-12 and abs(r["near_next"] - like(tree(t), tree(after))) < 1e-12
        a, b = t.split("\n"), edited.split("\n")
        first = next((k + 1 for k in range(max(len(a), len(b))) if a[k:k + 1] != b[k:k + 1]), 0)
        assert r["first_changed_paragraph"] == first
        assert r["next_doc_id"] == order[(n + 1) % len(order)][0]


def test_edits_are_near_and_others_far(docs_of):
    rows = [(i, " ".join(f"w{i}x{j * j % 997}" for j in range(300))) for i in range(5)]
    for r in report(fingerprints(docs_of(rows))).collect():
        assert r["near_edited"] > 0.5 > 0.05 > r["near_next"]


def test_odd_rows(odd):
    got = report(fingerprints(odd())).collect()
    assert len(got) == 11 and sum(r["doc_id"] is None for r in got) == 2
    twins = [r for r in got if r["doc_id"] == 1]
    assert len(twins) == 2 and twins[0] == twins[1]
    assert report(fingerprints(odd().limit(0))).count() == 0


def test_a_single_document_is_its_own_next(docs_of):
    r = report(fingerprints(docs_of([(1, "abcdef")]))).first()
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
