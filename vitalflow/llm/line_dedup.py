"""Line dedup: repeated windows of three consecutive lines, found globally.

Every line is hashed once; a window's identity is the hash of three consecutive line hashes
(two independent 64-bit hashes, so that unequal windows do not meet by chance at scale). The
first occurrence of a window in (doc_id, line) order stays; every later one marks its three
lines, and marked lines of overlapping windows merge into one covered set, which is removed.

Defined cases: a null text stays null with 0 lines; texts of fewer than three lines have no
window and stay whole; a window of three blank lines is layout and never counts. Rows that
share a doc_id are one document: occurrences at the same (doc_id, line) tie and both stay. Null
doc_ids come last in the order. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, staged


def _windows(rows: DataFrame) -> DataFrame:
    """One row per window: document key, position, two hashes. ``explode`` walks the hash array
    inside generated code, so the three neighbours are plain array reads."""
    lines = F.split("text", "\n", -1)
    hashed = rows.where(F.col("text").contains("\n")).select(
        "doc_id", "k",
        F.transform(lines, lambda x: F.xxhash64(x)).alias("a"),
        F.transform(lines, lambda x: F.xxhash64(x, F.lit(1))).alias("b"),
        F.transform(lines, lambda x: F.trim(x) == "").alias("blank"))
    at = hashed.select("doc_id", "k", "a", "b", "blank", F.posexplode_outer("a").alias("pos", "first"))
    three = lambda c: [F.get(c, F.col("pos") + i) for i in range(3)]
    blank = three("blank")
    return (at.where(F.col("pos") + 2 < F.size("a")).where(~(blank[0] & blank[1] & blank[2]))
            .select("doc_id", "k", "pos", F.xxhash64(*three("a")).alias("w1"), F.xxhash64(*three("b")).alias("w2")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed, text (without the removed lines), one row per input row."""
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("k", F.xxhash64("text"))
    windows = _windows(rows)
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"), F.col("pos").alias("pos"))
    # a hot window shrinks to one row per map task before the shuffle; the written table is a
    # plain scan, so the join below can split the partition of a hot window
    firsts = staged(windows.groupBy("w1", "w2").agg(F.min(order).alias("kept"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1").drop("n"), "line-windows")
    later = windows.join(firsts, ["w1", "w2"]).where(order > F.col("kept"))
    removed = (later.groupBy("doc_id", "k").agg(F.collect_set("pos").alias("at"))
               .select(F.col("doc_id").alias("r_id"), F.col("k").alias("r_k"), F.array_distinct(F.flatten(
                   F.transform("at", lambda p: F.array(p, p + 1, p + 2)))).alias("removed")))
    out = rows.join(removed, rows["doc_id"].eqNullSafe(removed["r_id"]) & (rows["k"] == removed["r_k"]), "left")
    lines = F.split("text", "\n", -1)
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed")),
                       lambda i: F.get(lines, i))
    return out.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))


ORACLE = r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
     p AS (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS p FROM l),
     w AS (SELECT doc_id, p, ls[p] || chr(10) || ls[p + 1] || chr(10) || ls[p + 2] AS win FROM p
           WHERE trim(ls[p], ' ') <> '' OR trim(ls[p + 1], ' ') <> '' OR trim(ls[p + 2], ' ') <> ''),
     r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY win ORDER BY doc_id, p) AS n FROM w),
     c AS (SELECT DISTINCT doc_id, unnest([p, p + 1, p + 2]) AS i FROM r WHERE n > 1),
     g AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(l.ls), 0) AS n_lines, coalesce(len(g.gone), 0) AS n_removed,
       CASE WHEN g.gone IS NULL THEN d.text ELSE array_to_string(
         [l.ls[i] FOR i IN range(1, len(l.ls) + 1) IF NOT list_contains(g.gone, i)], chr(10)) END AS text
FROM documents d LEFT JOIN l ON l.doc_id = d.doc_id LEFT JOIN g ON g.doc_id = d.doc_id
"""
