"""Personal data: pattern spans plus terms that reveal them, by corpus co-occurrence.

Base spans (email, ip, card, phone) come from patterns. Then information-theoretic sanitisation:
a term t in the context of a protected entity c (whole words within 64 code points, on the same
line) discloses the share PMI(c; t) / IC(c) of c's information, where with D documents
PMI = log2(D * n_ct / (n_c * n_t)) and IC = log2(D / n_c). n_t counts over all documents. Terms
seen with an entity in two documents or more are removed (kind ``reveal``) from a share of 0.9 and
generalised (kind ``narrow``) from 0.7.

Defined cases: a null text counts as empty; rows with equal doc_id and text get equal results;
an entity in every document has no information and discloses nothing; empty tables give empty
results. Spans are code points, end exclusive. Patterns scan a long run of one class once.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import count_kind, digest, find_all, pick, spans, staged

# The base kinds in their listed order. The look-behinds and possessive repeats
# match what the plain patterns match, without going over a long run again and again.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
REACH = 64                       # code points of context on either side
TERM = r"(?<!\S)\p{L}{3,}(?=[\s.,;:!?]|$)"
LEAST_TOGETHER = 2               # documents in which entity and term meet
REMOVE_FROM, GENERALISE_FROM = 0.9, 0.7


def _luhn(digits: Column) -> Column:
    at = F.transform(F.sequence(F.lit(1), F.length(digits)),
                     lambda i: F.substr(F.reverse(digits), i, F.lit(1)).cast("int"))
    doubled = F.transform(at, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return hit.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, k, ``found``: array of struct(start, rank, kind, end, hit, before, after).

    ``before`` and ``after`` are the text around the span, whatever stands there, one code point beyond
    ``REACH``. They come from the text in pieces of that length, so that many spans in a long text do not each count from its start.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    hits = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("k"), "text",
                       *[find_all(F.col("text"), p).alias(f"h_{kind}") for kind, p in PATTERNS.items()])
    some = reduce(or_, [F.size(f"h_{kind}") > 0 for kind in KINDS])
    split = hits.select("doc_id", "k", F.when(some, find_all(F.col("text"), f"(?s).{{1,{REACH + 1}}}")).alias("pieces"),
                        *[spans(F.col("text"), p, F.col(f"h_{kind}")).alias(f"s_{kind}") for kind, p in PATTERNS.items()])

    def piece(i: Column) -> Column:
        return F.coalesce(F.get("pieces", i), F.lit(""))

    def place(at: Column) -> tuple[Column, Column]:
        """The piece of a code point and the place in it."""
        return F.floor(at / (REACH + 1)).cast("int"), F.pmod(at, F.lit(REACH + 1)).cast("int")

    def before(at: Column) -> Column:
        n, r = place(at)
        return F.when(n == 0, F.substr(piece(n), F.lit(1), r)).otherwise(
            F.substr(F.concat(piece(n - 1), piece(n)), r + 1, F.lit(REACH + 1)))

    def after(at: Column) -> Column:
        n, r = place(at)
        return F.substr(F.concat(piece(n), piece(n + 1)), r + 1, F.lit(REACH + 1))

    def of(rank: int, kind: str) -> Column:
        valid = F.filter(f"s_{kind}", lambda s: _valid(kind, s["hit"]))
        return F.transform(valid, lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"),
            s["hit"].alias("hit"), before(s["start"]).alias("before"), after(s["end"]).alias("after")))

    return split.select("doc_id", "k", F.concat(*[of(i, kind) for i, kind in enumerate(KINDS)]).alias("found"))


def _contexts(base: DataFrame) -> DataFrame:
    """k, entity, term, start, end: the whole words near each entity, on its line."""
    one = base.select("k", F.explode("found").alias("s")).select(
        "k", F.lower("s.hit").alias("entity"), F.col("s.start").alias("s_start"), F.col("s.end").alias("s_end"),
        F.substring_index("s.before", "\n", -1).alias("before"), F.substring_index("s.after", "\n", 1).alias("after"))
    words = lambda c: spans(F.col(c), TERM, find_all(F.col(c), TERM))
    left = F.filter(words("before"), lambda w: F.length("before") - w["start"] <= REACH)
    right = F.filter(words("after"), lambda w: w["end"] <= REACH)
    shift = lambda ws, by: F.transform(ws, lambda w: F.struct(
        F.lower(w["hit"]).alias("term"), (w["start"] + by).alias("start"), (w["end"] + by).alias("end")))
    at = F.concat(shift(left, F.col("s_start") - F.length("before")), shift(right, F.col("s_end")))
    return one.select("k", "entity", F.explode(at).alias("w")).select("k", "entity", "w.term", "w.start", "w.end")


def disclosures(docs: DataFrame, base: DataFrame, contexts: DataFrame, text_col: str = "text") -> DataFrame:
    """entity, term, share: how much of an entity's information a term gives away."""
    text = pick(docs, text=text_col)
    together = contexts.select("k", "entity", "term").distinct().groupBy("entity", "term").agg(
        F.count(F.lit(1)).alias("n_ct")).where(F.col("n_ct") >= LEAST_TOGETHER)
    n_c = (base.select("k", F.explode(F.array_distinct(F.transform("found", lambda s: F.lower(s["hit"])))).alias("entity"))
           .distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_c")))
    words = F.array_distinct(find_all(F.lower(F.coalesce("text", F.lit(""))), TERM))
    n_t = text.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    total = text.agg(F.count(F.lit(1)).alias("d")).first()["d"]
    pairs = together.join(n_c, "entity").join(n_t, "term")
    pmi = F.log2(F.lit(float(total)) * F.col("n_ct") / (F.col("n_c") * F.col("n_t")))
    ic = F.log2(F.lit(float(total)) / F.col("n_c"))
    return pairs.where(ic > 0).select("entity", "term", (pmi / ic).alias("share")).where(F.col("share") >= GENERALISE_FROM)


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, k, ``found``: base spans and revealing terms as struct(start, rank, kind, end, hit)."""
    base = staged(base_spans(docs, id_col, text_col), "personal-base")
    contexts = staged(_contexts(base), "personal-contexts")
    shares = staged(disclosures(docs, base, contexts, text_col), "personal-shares")
    kind = F.when(F.col("share") >= REMOVE_FROM, "reveal").otherwise("narrow")
    # an entity shared by very many rows is a hot key here: both sides are plain scans, whose
    # skewed partitions Spark splits
    terms = contexts.join(shares, ["entity", "term"]).groupBy("k", "start", "end", "term").agg(F.max("share").alias("share"))
    terms = terms.groupBy(F.col("k").alias("t_k")).agg(F.collect_list(F.struct(
        "start", F.lit(len(KINDS)).alias("rank"), kind.alias("kind"), "end", F.col("term").alias("hit"))).alias("terms"))
    own = F.transform("found", lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"], s["hit"]))
    out = base.join(terms, F.col("k") == F.col("t_k"), "left")
    return out.select("doc_id", "k", F.concat(own, F.coalesce("terms", F.filter(own, lambda s: F.lit(False)))).alias("found"))


def redact(text: Column, found: Column) -> Column:
    """The text with each span replaced by ``[kind]``; spans that overlap an earlier one merge into it."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(a, s):
        begin = F.greatest(a["at"], s["start"])
        keep = F.substr(text, (a["at"] + 1).cast("int"), (begin - a["at"]).cast("int"))
        fresh = F.when(s["start"] >= a["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise("")
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], keep, fresh).alias("out"))

    return F.aggregate(F.array_sort(found), start, step,
                       lambda a: F.concat(a["out"], F.substr(text, (a["at"] + 1).cast("int"), F.length(text))))


def sanitise(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with personal data and revealing terms replaced by their kind."""
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("k", F.xxhash64("doc_id", "text"))
    one = found.dropDuplicates(["k"]).select(F.col("k").alias("f_k"), "found")
    return rows.join(one, F.col("k") == F.col("f_k")).select("doc_id", redact(F.col("text"), F.col("found")).alias("text"))


def report(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, all spans, and whether there is any."""
    base = F.filter("found", lambda s: s["kind"].isin(list(KINDS)))
    return found.select(
        "doc_id", *[count_kind("found", n) for n in KINDS],
        F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("found")).alias("spans"),
        (F.size("found") > 0).cast("int").alias("has_personal"))
