"""Secret scans: a trigram inverted index narrows each rule to candidate texts, which are verified.

Each rule's regex is turned into a Boolean query over lower-cased trigrams that every match must
contain (an AND of clauses, each an OR of trigram sets). The index holds postings (trigram, row)
for the trigrams that the rules ask for. Intersecting a rule's postings gives its candidate rows;
only those run the regex. A rule without mandatory trigrams (long hex runs) scans every text.

Defined cases: a null text counts as empty and has no spans; rows with equal doc_id and text get
equal results, also if doc_id is null; spans are code points, end exclusive; an empty table gives
an empty result. Patterns are written so that a long run is scanned once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import count_kind, digest, find_all, pick, spans, staged


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0      # the group whose length counts
    least: int = 1      # its least length; shorter matches are dropped


# The three base kinds, in their listed order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # only maximal runs of 24 or more are matched, so the start of a run is looked at once
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}"),
)
# Kinds beyond the base ones.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("github", r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

Clause = list[frozenset[str]]  # one of these trigram sets must be in the text as a whole
MOST_STRINGS = 64              # literal alternatives kept before a run is closed


def _exact(tree) -> set[str] | None:
    """The strings that a piece of regex stands for, if they are few."""
    out = {""}
    for op, arg in tree:
        part = _strings(str(op), arg)
        if part is None or len(out) * len(part) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in part}
    return out


def _strings(op: str, arg) -> set[str] | None:
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
        return {chr(c).lower() for _, c in arg}
    if op == "SUBPATTERN":
        return _exact(arg[-1])
    if op == "BRANCH":
        parts = [_exact(p) for p in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op == "MAX_REPEAT" and (arg[0], arg[1]) == (0, 1):
        part = _exact(arg[2])
        return None if part is None else part | {""}
    return None


def trigram_query(pattern: str) -> list[Clause]:
    """What a text must contain for ``pattern`` to match anywhere; empty: nothing can be said."""
    clauses: list[Clause] = []
    runs = {""}

    def close() -> None:
        nonlocal runs
        if min(map(len, runs)) >= 3:
            sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in runs}
            clauses.append(sorted((s for s in sets if not any(o < s for o in sets)), key=sorted))
        runs = {""}

    def walk(tree) -> None:
        nonlocal runs
        for op, arg in tree:
            op = str(op)
            if op in ("AT", "ASSERT", "ASSERT_NOT"):
                continue
            part = _strings(op, arg)
            if part is not None and len(runs) * len(part) <= MOST_STRINGS:
                runs = {a + b for a in runs for b in part}
            elif op == "SUBPATTERN":
                walk(arg[-1])
            elif op == "MAX_REPEAT" and arg[0] >= 1:
                walk(arg[2])
                close()
            else:
                close()

    walk(re._parser.parse(pattern))
    close()
    return clauses


def index_postings(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, k) of the given trigrams over rows (k, text)."""
    low = rows.select("k", F.lower("text").alias("low"))
    found = F.array(*[F.when(F.col("low").contains(t), F.lit(t)) for t in trigrams])
    return low.select("k", F.explode(F.array_compact(found)).alias("trigram"))


def candidates(postings: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """k and one boolean ``c_<kind>`` per rule that has a query: the intersection of its postings."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    seen = postings.groupBy("k").agg(F.collect_set("trigram").alias("seen"))

    def holds(alternative: frozenset[str]) -> Column:
        wanted = F.array(*[F.lit(t) for t in sorted(alternative)])
        return F.size(F.array_except(wanted, "seen")) == 0

    def any_of(clause: Clause) -> Column:
        out = holds(clause[0])
        for a in clause[1:]:
            out = out | holds(a)
        return out

    flags = []
    for kind, clauses in queries.items():
        flag = any_of(clauses[0])
        for c in clauses[1:]:
            flag = flag & any_of(c)
        flags.append(flag.alias(f"c_{kind}"))
    some = F.greatest(*[F.col(f"c_{kind}") for kind in queries]) if len(queries) > 1 else F.col(f"c_{next(iter(queries))}")
    return seen.select("k", *flags).where(some)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """doc_id and ``found``: array of struct(start, rank, kind, end, hit), one row per input row."""
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("k", F.xxhash64("doc_id", "text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    trigrams = sorted({t for q in queries.values() for c in q for s in c for t in s})
    if trigrams:
        postings = staged(index_postings(rows, trigrams), "secret-postings")
        narrowed = rows.join(candidates(postings, rules).withColumnRenamed("k", "c_k"),
                             F.col("k") == F.col("c_k"), "left")
    else:
        narrowed = rows
    none = F.array().cast("array<string>")
    hits = narrowed.select("doc_id", "text", *[
        (F.when(F.col(f"c_{r.kind}"), find_all(F.col("text"), r.pattern)).otherwise(none) if queries[r.kind]
         else find_all(F.col("text"), r.pattern)).alias(f"h_{r.kind}") for r in rules])

    def of(rank: int, r: Rule) -> Column:
        at = spans(F.col("text"), r.pattern, F.col(f"h_{r.kind}"))
        if r.group or r.least > 1:
            at = F.filter(at, lambda s: F.length(F.regexp_extract(s["hit"], r.pattern, r.group)) >= r.least)
        return F.transform(at, lambda s: F.struct(s["start"], F.lit(rank).alias("rank"), F.lit(r.kind).alias("kind"),
                                                  s["end"], s["hit"]))

    return hits.select("doc_id", F.concat(*[of(i, r) for i, r in enumerate(rules)]).alias("found"))


def report(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans."""
    names = [r.kind for r in BASE]
    base = F.filter("found", lambda s: s["kind"].isin(names))
    return found.select(
        "doc_id", *[count_kind("found", n) for n in names],
        F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("found")).alias("spans"))
