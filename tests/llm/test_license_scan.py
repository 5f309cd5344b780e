"""License scans: rules, suppression and base places against plain Python over the words of a text."""

from __future__ import annotations

import itertools
import re
import time

import pytest

from vitalflow.llm import license_scan as L
from vitalflow.llm.common import read

from .conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def expected(text):
    words = words_of(text)
    starts = [(i, label) for phrase, label in L.BASE.items() for p in [phrase.split()]
              for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    base = sorted({label for _, label in starts})
    joined = " ".join(words)
    found = []
    for o, r in enumerate(L.rules()):
        for m in re.finditer(f"(?<![^ ])(?:{r.pattern})(?![^ ])", joined):
            at = joined[:m.start()].count(" ")
            found.append((at, at + m.group().count(" ") + 1, r.level, o, r.label))
    kept = [d for d in found if not any(
        e[0] <= d[0] and d[1] <= e[1] and e[2] <= d[2] and (e[1] - e[0] > d[1] - d[0] or (e[2], e[3]) < (d[2], d[3]))
        for e in found)]
    levels = [d[2] for d in kept] + [list(L.CLASSES).index("grant")] * bool(starts)
    return (len(words), len(starts), min((i for i, _ in starts), default=None), max((i for i, _ in starts), default=None),
            ",".join(base), ",".join(sorted({*base, *(d[4] for d in kept)})), list(L.CLASSES.values())[min(levels)] if levels else 0.0)


def got(df):
    return [(r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)) for r in df.collect()]


TEXTS = [
    "Released under the MIT License.", "// Licensed under the Apache License, Version 2.0 (the \"License\");",
    "This work is licensed under CC BY-NC 4.0. Again: cc-by-nc, CC BY NC cc by nc", "CC BY-NC-SA 4.0", "cc by ncx",
    "SPDX-License-Identifier: GPL-3.0-or-later\n# SPDX-License-Identifier: Apache-2.0 OR MIT",
    "under the terms of the GNU Lesser General Public License, version 2.1, or any later version", "GNU GPL v3", "GPLv2",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2",
    "Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "https://www.apache.org/licenses/LICENSE-2.0", "released into the public domain",
    "Key under the MIT license İ mit ÉCOLE licenſe", "a license to nothing", "", None, " . ", "Under the MIT License, under the mit license",
    "BSD 3-Clause License, new BSD license, bsd", "do what the f*** you want to public license", "word " * 3000 + "mit license " * 200,
]


def test_scan_equals_plain_python(spark, docs_of):
    df = docs_of(list(enumerate(TEXTS)) + [(0, TEXTS[0]), (None, TEXTS[1])])
    out = got(L.scan(df))
    assert sorted(map(repr, out)) == sorted(repr((i, expected(t))) for i, t in [*enumerate(TEXTS), (0, TEXTS[0]), (None, TEXTS[1])])


def test_scan_equals_plain_python_on_the_table(spark):
    df = read(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
    out = got(L.scan(df))
    assert len(out) == len(texts) and all(v == expected(texts[i]) for i, v in out)


def strings(tree):
    """Some of the strings that a rule's regex stands for: all choices of its groups, first and last of a class."""
    parts = []
    for op, arg in tree:
        op = str(op)
        if op == "LITERAL":
            parts.append([chr(arg)])
        elif op == "IN":
            of = [chr(a) if str(o) == "LITERAL" else chr(a[0]) for o, a in arg]
            parts.append(of)
        elif op == "SUBPATTERN":
            parts.append(list(strings(arg[-1])))
        elif op == "BRANCH":
            parts.append([s for p in arg[1] for s in strings(p)])
        else:   # MAX_REPEAT
            inner = list(strings(arg[2]))
            parts.append([""] * (arg[0] == 0) + inner)
    return ("".join(x) for x in itertools.islice(itertools.product(*parts), 3000))


def test_every_rule_needs_its_keyword_and_a_stem():
    """What a rule matches is never lost by the keyword gates."""
    parse = pytest.importorskip("re._parser").parse
    rules = L.rules()
    assert len(rules) > 200 and [r.level for r in rules] == sorted(r.level for r in rules)
    for r in rules:
        for s in strings(parse(r.pattern)):
            assert r.keyword in s and any(stem in s for stem in L.STEMS), (r, s)


def test_suppression():
    """The longer and stronger detection stays; a weaker one around a stronger one does not hide it."""
    assert expected("Licensed under the Apache License, Version 2.0")[5] == "apache-2"
    assert expected("GNU Lesser General Public License")[5] == "lgpl"


def test_odd_rows_and_empty_table(spark, odd, docs_of):
    df = odd()
    out = got(L.scan(df))
    assert len(out) == df.count() and all(v[4] == "" for _, v in out)
    none = L.scan(docs_of([]))
    assert none.count() == 0 and dict(none.dtypes)["first_word"] == "bigint"


def test_many_matches_in_one_text(spark, docs_of):
    began = time.time()
    (_, v), = got(L.scan(docs_of([(1, "under the mit license, " * 40_000)])))
    assert v[:6] == (160_000, 40_000, 0, 159_996, "mit", "mit") and time.time() - began < 60
