r"""License scans: ordered signature rules, gated by keywords, with suppression of contained detections.

A text becomes its words, lower-cased and joined by single blanks, so rules need not care for
punctuation, line breaks or comment signs. Rules are regexes over whole words, in five classes from
tags down to short mentions, and ordered within a class. A text is a candidate if it holds one of few
stems, of which every rule has one; a candidate meets only the rules whose keyword it holds. Detections
are intervals of words. One goes if it lies inside another of its own or a stronger class; of equal
intervals the rule that comes first stays. Partly overlapping detections all stay.

The base phrases are looked for on their own and always stay.

Defined cases: a null text is empty: 0 words, no labels (empty strings), score 0; rows are taken one by
one, so repeated rows and null ids get results of their own; further columns are ignored; an empty table
gives an empty result. ``score`` is that of the strongest class that stays, a base place counting as a grant.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick, staged

# The base phrases with their labels, and what parts words (before lower-casing).
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
PARTS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

CLASSES = {"tag": 1.0, "sentence": 0.95, "url": 0.9, "grant": 0.85, "name": 0.6, "mention": 0.3}  # strongest first, with scores
STEMS = ("licen", "gpl", "cc by", "cc0", "creative commons", "creativecommons", "public domain", "permission",
         "redistribution", "spdx", "copyleft")

UNDER = r"(?:licen[sc]ed|released|distributed|published|provided|available|covered) under (?:the )?(?:terms of (?:the )?)?"


@dataclass(frozen=True)
class License:
    """``keyword`` is in everything that ``name`` matches; ``spdx`` are the words of the SPDX identifier."""
    label: str
    keyword: str
    name: str
    spdx: str = ""
    urls: tuple[str, ...] = ()
    sentences: tuple[str, ...] = ()
    mentions: tuple[str, ...] = ()


V = r"(?: version| v)?"
ANY = r"(?: or (?:at your option )?(?:any )?later(?: versions?)?)?"

LICENSES = (
    License("mit", "mit", "mit licen[sc]e", "mit", ("opensource org licen[sc]es mit",),
            ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",),
            ("mit licen[sc]ed", "licen[sc]e mit")),
    License("mit", "expat", "expat licen[sc]e"),
    License("mit-0", "attribution", "mit no attribution(?: licen[sc]e)", "mit 0"),
    License("x11", "x11", "x11 licen[sc]e", "x11"),
    License("isc", "isc", "isc licen[sc]e", "isc", ("opensource org licen[sc]es isc",),
            ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that",)),
    License("0bsd", "bsd", "(?:zero clause|0 clause|bsd zero clause) bsd licen[sc]e", "0bsd", (),
            ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided",)),
    License("bsd-2-clause", "bsd", "(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd) licen[sc]e", "bsd 2 clause", ("opensource org licen[sc]es bsd 2 clause",)),
    License("bsd-3-clause", "bsd", "(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd) licen[sc]e", "bsd 3 clause", ("opensource org licen[sc]es bsd 3 clause",)),
    License("bsd-4-clause", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd) licen[sc]e", "bsd 4 clause"),
    License("bsd", "bsd", "bsd(?: style)? licen[sc]e", "bsd", (),
            ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
            ("licen[sc]e bsd",)),
    License("apache-1.1", "apache", f"apache(?: software)? licen[sc]e{V} 1 1", "apache 1 1"),
    License("apache-2", "apache", f"apache(?: software)? licen[sc]e{V} 2(?: 0)?", "apache 2 0", ("apache org licen[sc]es licen[sc]e 2 0",),
            ("unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis",),
            ("apache 2(?: 0)? licen[sc]ed?", "licen[sc]e apache 2(?: 0)?")),
    License("apache", "apache", "apache(?: software)? licen[sc]e", ""),
    License("gpl-1", "general public", f"gnu general public licen[sc]e{V} 1(?: 0)?{ANY}", "gpl 1 0(?: only| or later)?"),
    License("gpl-2", "general public", f"(?:gnu )?general public licen[sc]e{V} 2(?: 0)?{ANY}", "gpl 2 0(?: only| or later)?", ("gnu org licen[sc]es (?:old licen[sc]es )?gpl 2 0",)),
    License("gpl-3", "general public", f"(?:gnu )?general public licen[sc]e{V} 3(?: 0)?{ANY}", "gpl 3 0(?: only| or later)?", ("gnu org licen[sc]es gpl 3 0",)),
    License("gpl", "general public", "(?:gnu )?general public licen[sc]e", "gpl", ("gnu org licen[sc]es gpl",),
            ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e",
             "you should have received a copy of the gnu general public licen[sc]e")),
    License("gpl-2", "gpl", f"(?:gnu )?gpl{V} ?2(?: 0)?", "gplv2", (), (), ("gplv2", "gpl2")),
    License("gpl-3", "gpl", f"(?:gnu )?gpl{V} ?3(?: 0)?", "gplv3", (), (), ("gplv3", "gpl3")),
    License("gpl", "gpl", "gnu gpl", "", (), (), ("gpl licen[sc]ed?", "licen[sc]e gpl")),
    License("lgpl-2", "library general public", f"gnu library general public licen[sc]e(?:{V} 2(?: 0)?)?{ANY}", "lgpl 2 0(?: only| or later)?"),
    License("lgpl-2.1", "lesser general public", f"(?:gnu )?lesser general public licen[sc]e{V} 2 1{ANY}", "lgpl 2 1(?: only| or later)?", ("gnu org licen[sc]es (?:old licen[sc]es )?lgpl 2 1",)),
    License("lgpl-3", "lesser general public", f"(?:gnu )?lesser general public licen[sc]e{V} 3(?: 0)?{ANY}", "lgpl 3 0(?: only| or later)?", ("gnu org licen[sc]es lgpl 3 0",)),
    License("lgpl", "lesser general public", "(?:gnu )?lesser general public licen[sc]e", "lgpl", ("gnu org licen[sc]es lgpl",)),
    License("lgpl", "lgpl", "(?:gnu )?lgpl(?: ?(?:v|version )?[23](?: [01])?)?", ""),
    License("agpl-3", "affero", f"(?:gnu )?affero general public licen[sc]e{V} 3(?: 0)?{ANY}", "agpl 3 0(?: only| or later)?", ("gnu org licen[sc]es agpl",)),
    License("agpl", "affero", "(?:gnu )?affero general public licen[sc]e", ""),
    License("agpl", "agpl", "(?:gnu )?agpl(?: ?(?:v|version )?3(?: 0)?)?", ""),
    License("gfdl-1.3", "free documentation", f"gnu free documentation licen[sc]e{V} 1 3{ANY}", "gfdl 1 3(?: only| or later)?", ("gnu org licen[sc]es fdl 1 3",)),
    License("gfdl", "free documentation", "gnu free documentation licen[sc]e", "gfdl"),
    License("mpl-1.1", "mozilla", f"mozilla public licen[sc]e{V} 1 1", "mpl 1 1"),
    License("mpl-2", "mozilla", f"mozilla public licen[sc]e{V} 2(?: 0)?", "mpl 2 0", ("mozilla org mpl 2 0 licen[sc]e",),
            ("this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0",)),
    License("mpl", "mozilla", "mozilla public licen[sc]e", "mpl"),
    License("epl-1", "eclipse", f"eclipse public licen[sc]e{V} 1(?: 0)?", "epl 1 0", ("eclipse org legal epl v10 licen[sc]e",)),
    License("epl-2", "eclipse", f"eclipse public licen[sc]e{V} 2(?: 0)?", "epl 2 0", ("eclipse org legal epl 2 0 licen[sc]e",)),
    License("epl", "eclipse", "eclipse public licen[sc]e", "epl"),
    License("edl-1", "eclipse", f"eclipse distribution licen[sc]e(?:{V} 1(?: 0)?)?", ""),
    License("cddl-1", "common development", f"common development and distribution licen[sc]e(?:{V} 1(?: 0)?)?", "cddl 1 0", (),
            ("subject to the terms of the common development and distribution licen[sc]e",)),
    License("cpl-1", "common public", f"common public licen[sc]e(?:{V} 1(?: 0)?)?", "cpl 1 0"),
    License("cpal-1", "attribution", f"common public attribution licen[sc]e(?:{V} 1(?: 0)?)?", "cpal 1 0"),
    License("eupl-1.2", "european union", f"european union public licen[sc]e(?:{V} 1 2)?", "eupl 1 2"),
    License("osl-3", "open software", f"open software licen[sc]e(?:{V} 3(?: 0)?)?", "osl 3 0"),
    License("afl-3", "academic free", f"academic free licen[sc]e(?:{V} 3(?: 0)?)?", "afl 3 0"),
    License("artistic-1", "artistic", f"artistic licen[sc]e{V} 1(?: 0)?", "artistic 1 0"),
    License("artistic-2", "artistic", f"artistic licen[sc]e{V} 2(?: 0)?", "artistic 2 0"),
    License("artistic", "artistic", "(?:perl )?artistic licen[sc]e", ""),
    License("bsl-1", "boost", f"boost software licen[sc]e(?:{V} 1(?: 0)?)?", "bsl 1 0", ("boost org licen[sc]e 1 0",)),
    License("busl-1.1", "business source", f"business source licen[sc]e(?:{V} 1 1)?", "busl 1 1"),
    License("sspl-1", "server side", f"server side public licen[sc]e(?:{V} 1)?", "sspl 1 0"),
    License("elastic-2", "elastic", f"elastic licen[sc]e(?:{V} 2(?: 0)?)?", "elastic 2 0"),
    License("zlib", "zlib", "zlib(?: libpng)? licen[sc]e", "zlib", (),
            ("permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely",)),
    License("libpng", "libpng", "libpng licen[sc]e", "libpng"),
    License("openssl", "openssl", "openssl licen[sc]e", "openssl"),
    License("curl", "curl", "curl licen[sc]e", "curl"),
    License("ftl", "freetype", "freetype(?: project)? licen[sc]e", "ftl"),
    License("ijg", "jpeg", "independent jpeg group licen[sc]e", "ijg"),
    License("psf-2", "python", f"python software foundation licen[sc]e(?:{V} 2)?", "psf 2 0"),
    License("python-2", "python", f"python licen[sc]e(?:{V} 2(?: 0)?)?", "python 2 0"),
    License("php-3", "php", f"php licen[sc]e(?:{V} 3(?: 0?1)?)?", "php 3 01"),
    License("ruby", "ruby", "ruby licen[sc]e", "ruby"),
    License("postgresql", "postgresql", "postgresql licen[sc]e", "postgresql"),
    License("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[sc]e", "ncsa"),
    License("w3c", "w3c", "w3c(?: software)?(?: notice and)? licen[sc]e", "w3c"),
    License("unicode", "unicode", "unicode licen[sc]e(?: agreement)?", "unicode dfs 2016"),
    License("ofl-1.1", "font", f"(?:sil )?open font licen[sc]e(?:{V} 1 1)?", "ofl 1 1"),
    License("ms-pl", "microsoft", "microsoft public licen[sc]e", "ms pl"),
    License("ms-rl", "microsoft", "microsoft reciprocal licen[sc]e", "ms rl"),
    License("wtfpl", "what the", "do what the f[a-z]* you want to public licen[sc]e", "wtfpl"),
    License("beerware", "beer", "beer ?ware licen[sc]e", "beerware"),
    License("unlicense", "unlicen", "unlicen[sc]e", "unlicense", ("unlicen[sc]e org",),
            ("this is free and unencumbered software released into the public domain",)),
    License("public-domain", "public domain", "public domain dedication", "", (),
            ("(?:released|placed|dedicated) (?:in|into|to) the public domain",), ("in the public domain",)),
    License("cc0-1", "cc0", f"cc0(?:{V} ?1(?: 0)?)?(?: universal)?", "cc0 1 0", ("creativecommons org publicdomain zero 1 0",)),
    License("cc0-1", "creative commons", "creative commons zero(?: v?1(?: 0)?)?(?: universal)?", ""),
    License("pddl-1", "public domain", "(?:open data commons )?public domain dedication and licen[sc]e", "pddl 1 0"),
    License("odbl-1", "database", f"(?:odc )?open database licen[sc]e(?:{V} 1(?: 0)?)?", "odbl 1 0"),
    License("odc-by-1", "open data", f"open data commons attribution licen[sc]e(?:{V} 1(?: 0)?)?", "odc by 1 0"),
    License("ogl-3", "open government", f"open government licen[sc]e(?:{V} 3(?: 0)?)?", "ogl uk 3 0"),
    License("cc-by-nc-nd", "cc by nc nd", "cc by nc nd(?: [1-4] 0)?", "cc by nc nd [1-4] 0", ("creativecommons org licen[sc]es by nc nd",)),
    License("cc-by-nc-sa", "cc by nc sa", "cc by nc sa(?: [1-4] 0)?", "cc by nc sa [1-4] 0", ("creativecommons org licen[sc]es by nc sa",)),
    License("cc-by-nc", "cc by nc", "cc by nc(?: [1-4] 0)?", "cc by nc [1-4] 0", ("creativecommons org licen[sc]es by nc",)),
    License("cc-by-nd", "cc by nd", "cc by nd(?: [1-4] 0)?", "cc by nd [1-4] 0", ("creativecommons org licen[sc]es by nd",)),
    License("cc-by-sa", "cc by sa", "cc by sa(?: [1-4] 0)?", "cc by sa [1-4] 0", ("creativecommons org licen[sc]es by sa",)),
    License("cc-by", "cc by", "cc by(?: [1-4] 0)?", "cc by [1-4] 0", ("creativecommons org licen[sc]es by",)),
    License("cc-by-nc-nd", "creative commons", "creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: (?:works )?[1-4] 0)?", ""),
    License("cc-by-nc-sa", "creative commons", "creative commons attribution non ?commercial share ?alike(?: [1-4] 0)?", ""),
    License("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?: [1-4] 0)?", ""),
    License("cc-by-nd", "creative commons", "creative commons attribution no ?deriv(?:ative)?s(?: [1-4] 0)?", ""),
    License("cc-by-sa", "creative commons", "creative commons attribution share ?alike(?: [1-4] 0)?", ""),
    License("cc-by", "creative commons", "creative commons attribution(?: [1-4] 0)?", ""),
    License("cc", "creative commons", "creative commons(?: public)? licen[sc]e", "", ("creativecommons org licen[sc]es",)),
    License("openrail-m", "rail", "(?:bigscience |creativeml )?open ?rail(?: ?m)? licen[sc]e", "openrail m"),
    License("llama", "llama", "llama(?: [23](?: [1-3])?)? community licen[sc]e(?: agreement)?", ""),
    License("gemma", "gemma", "gemma(?: terms of use)? licen[sc]e", ""),
    License("proprietary", "proprietary", "proprietary licen[sc]e", "", (), (), ("proprietary and confidential all rights reserved licen[sc]e",)),
    License("non-commercial", "commercial", "non ?commercial licen[sc]e", "", (), ("licen[sc]ed for non ?commercial use only",)),
    License("eula", "user", "end user licen[sc]e agreement", ""),
)


@dataclass(frozen=True)
class Rule:
    label: str
    level: int      # index of the class
    keyword: str
    pattern: str


def rules(licenses: tuple[License, ...] = LICENSES) -> list[Rule]:
    """The ordered rules: class by class, and in the order of the licenses within a class."""
    kinds = list(CLASSES)
    out = []
    for x in licenses:
        out += [Rule(x.label, kinds.index("tag"), "spdx", f"spdx licen[sc]e identifier {x.spdx}")] * bool(x.spdx)
        out += [Rule(x.label, kinds.index("sentence"), _keyword(p), p) for p in x.sentences]
        out += [Rule(x.label, kinds.index("url"), _keyword(p), p) for p in x.urls]
        out += [Rule(x.label, kinds.index("grant"), x.keyword, UNDER + x.name), Rule(x.label, kinds.index("name"), x.keyword, x.name)]
        out += [Rule(x.label, kinds.index("mention"), _keyword(p), p) for p in x.mentions]
    return sorted(out, key=lambda r: r.level)


def _keyword(pattern: str) -> str:
    """The longest plain stretch of words of a pattern without choices in it."""
    plain, depth, run = [], 0, ""
    for c in pattern + "(":
        if depth == 0 and (c.isalnum() or c == " "):
            run += c
            continue
        if depth == 0:
            plain.append(run[:-1] if c == "?" else run)
            run = ""
        depth += (c in "([") - (c in ")]")
    return max((p.strip() for p in plain), key=len)


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (a number of its own), doc_id, n_words, words (of candidates only: lower-cased, joined by blanks)."""
    text = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), PARTS, " "))
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", text.alias("words"))
    near = F.lower("words")     # lower-cases more than A-Z, which is no matter for plain ASCII stems
    some = near.contains(STEMS[0])
    for stem in STEMS[1:]:
        some = some | near.contains(stem)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    n = F.when(F.col("words") == "", 0).otherwise(spaces(F.col("words")) + 1).cast("bigint")
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", n.alias("n_words"),
                       F.when(some, F.translate("words", upper, upper.lower())).alias("words"))


def base_places(rows: DataFrame) -> DataFrame:
    """``scanned`` candidates with n_base, first_word, last_word and base_labels (sorted array)."""
    framed = F.concat(F.lit(" "), "words", F.lit(" "))
    counts = {p: F.regexp_count(framed, F.lit(f"(?<= ){p}(?= )")).cast("bigint") for p in BASE}
    firsts, lasts, labels = [], [], []
    for phrase, label in BASE.items():
        here, n = F.lit(f" {phrase} "), len(phrase.split())
        found = framed.contains(f" {phrase} ")
        after = spaces(F.substring_index(framed, f" {phrase} ", -1))
        firsts.append(F.when(found, spaces(F.substring_index(framed, f" {phrase} ", 1))))
        lasts.append(F.when(found, F.col("n_words") - after - n))
        labels.append(F.when(F.instr(framed, here) > 0, F.lit(label)))
    total = sum(counts.values(), F.lit(0).cast("bigint"))
    return rows.select("*", total.alias("n_base"), F.least(*firsts).cast("bigint").alias("first_word"),
                       F.greatest(*lasts).cast("bigint").alias("last_word"), F.array_sort(F.array_compact(F.array(*labels))).alias("base_labels"))


def rule_table(spark: SparkSession, licenses: tuple[License, ...] = LICENSES) -> DataFrame:
    """The rules as rows: keyword, ord, level, label, pattern. As many as are written above."""
    rows = [(r.keyword, i, r.level, r.label, f"(?<![^ ])(?:{r.pattern})(?![^ ])") for i, r in enumerate(rules(licenses))]
    return spark.createDataFrame(rows, "keyword string, ord int, level int, label string, pattern string")


def detections(candidates: DataFrame, licenses: tuple[License, ...] = LICENSES) -> DataFrame:
    """row, ord, level, label, start, end (words, end exclusive): every match of a rule, one row each.

    Only rules whose keyword stands in the text run. Matches become rows, and a running sum over
    the rows of one text turns the lengths between them into word numbers, so nothing grows with the
    square of the matches of a text.
    """
    keywords = sorted({r.keyword for r in rules(licenses)})
    held = F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(F.col("words"), k))
    met = candidates.select("row", "words", F.explode(held).alias("keyword"))
    met = met.join(F.broadcast(rule_table(candidates.sparkSession, licenses)), "keyword")
    hits = met.withColumn("hits", F.regexp_extract_all("words", F.col("pattern"), F.lit(0))).where(F.size("hits") > 0)
    gaps = F.transform(F.split("words", F.col("pattern"), -1), spaces)
    lens = F.transform("hits", spaces)
    each = hits.select("row", "ord", "level", "label", F.posexplode(F.arrays_zip(gaps.alias("gap"), lens.alias("len"))).alias("pos", "m"))
    each = each.where(F.col("m.len").isNotNull()).repartition("row")
    run = Window.partitionBy("row", "ord").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.sum(F.col("m.gap") + F.col("m.len")).over(run)
    return each.select("row", "ord", "level", "label", (upto - F.col("m.len")).alias("start"), (upto + 1).alias("end"))


def surviving(found: DataFrame) -> DataFrame:
    """``found`` without the detections that lie in another of a class at least as strong."""
    order = [F.col("start"), F.col("end").desc(), F.col("level"), F.col("ord")]
    earlier = Window.partitionBy("row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    reach = [F.max(F.when(F.col("level") <= c, F.col("end"))).over(earlier).alias(f"r{c}") for c in range(len(CLASSES))]
    covered = F.coalesce(*[F.when(F.col("level") == c, F.col(f"r{c}")) for c in range(len(CLASSES))], F.lit(-1))
    return found.select("*", *reach).where(covered < F.col("end")).select(*found.columns)


def scan(docs: DataFrame, licenses: tuple[License, ...] = LICENSES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, base places, base_labels, labels, score."""
    rows = staged(scanned(docs, id_col, text_col), "license-words")
    candidates = rows.where(F.col("words").isNotNull())
    kept = surviving(detections(candidates, licenses)).groupBy(F.col("row").alias("k_row")).agg(
        F.collect_set("label").alias("found"), F.min("level").alias("best"))
    scores = list(CLASSES.values())
    grant = F.lit(list(CLASSES).index("grant"))
    best = F.least(F.col("best"), F.when(F.col("n_base") > 0, grant))
    score = F.coalesce(*[F.when(best == i, F.lit(s)) for i, s in enumerate(scores)], F.lit(0.0))
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("found", none)))
    with_base = base_places(candidates).join(kept, F.col("row") == F.col("k_row"), "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), score.alias("score"))
    nothing = F.lit(None).cast("bigint")
    plain = rows.where(F.col("words").isNull()).select(
        "doc_id", "n_words", F.lit(0).cast("bigint").alias("n_base"), nothing.alias("first_word"), nothing.alias("last_word"),
        F.lit("").alias("base_labels"), F.lit("").alias("labels"), F.lit(0.0).alias("score"))
    return with_base.unionByName(plain)
