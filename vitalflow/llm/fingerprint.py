"""Document fingerprints: a Merkle tree over paragraphs and sections.

A paragraph is a line; its node is the hash of its text. A section is a run of paragraphs that
ends after a paragraph whose hash falls in a fixed eighth, so sections find their place again
after an insertion; its node hashes its paragraphs' nodes. The root hashes the sections' nodes:
equal roots mean equal texts, and paragraph nodes that differ locate an edit. Below the
paragraphs, each is cut into blocks of 12 code points; a bottom-k sketch of the block hashes
travels with the tree and measures likeness where roots differ (exact up to ``SKETCH`` blocks).

Defined cases: a null text counts as empty; rows with equal doc_id and text are one document, whose
next document is the next different one; null doc_ids come last in the descending order; ties on
doc_id go by a hash of the text; a single document is its own next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import find_all, pick, staged

BLOCK = 12
SKETCH = 128


def tree(text: Column) -> Column:
    """struct(root, sections, paragraphs, sketch) of a text."""
    paragraphs = F.transform(F.split(text, "\n", -1), lambda p: F.md5(p.cast("binary")))
    ends = lambda h: F.when(F.substring(h, 1, 1).isin("0", "1"), "|").otherwise(",")
    runs = F.split(F.array_join(F.transform(paragraphs, lambda h: F.concat(h, ends(h))), ""), r"\|")
    sections = F.transform(F.array_remove(runs, ""), lambda s: F.md5(s.cast("binary")))
    blocks = find_all(text, r"[^\n]{1,%d}" % BLOCK)
    short = F.transform(blocks, lambda b: F.shiftright(F.xxhash64(b), 32).cast("int"))
    return F.struct(F.sha2(F.array_join(sections, ","), 256).alias("root"), sections.alias("sections"),
                    paragraphs.alias("paragraphs"),
                    F.slice(F.array_sort(F.array_distinct(short)), 1, SKETCH).alias("sketch"))


def likeness(root_a: Column, sketch_a: Column, root_b: Column, sketch_b: Column) -> Column:
    """0 to 1: 1 for equal roots, else twice the shared blocks by all blocks, from the sketches."""
    least = F.slice(F.array_sort(F.array_union(sketch_a, sketch_b)), 1, SKETCH)
    shared = F.size(F.array_intersect(F.array_intersect(least, sketch_a), sketch_b))
    jaccard = F.when(F.size(least) > 0, shared / F.size(least)).otherwise(0.0)
    return F.when(root_a == root_b, 1.0).otherwise(2 * jaccard / (1 + jaccard)).cast("double")


def first_change(paragraphs_a: Column, paragraphs_b: Column) -> Column:
    """Number (from 1) of the first paragraph whose node differs; 0 if none does."""
    return F.array_position(F.zip_with(paragraphs_a, paragraphs_b, lambda a, b: a.eqNullSafe(b)), False)


def _cycle(rows: DataFrame) -> DataFrame:
    """o_k, o_k2 and the document before it in descending doc_id order (before: k, k2, n_chars).

    Small rows only: range-partitioned by doc_id, a window in each range, and the ranges' last
    rows (one for each partition) joined to the ranges that follow.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("k"), F.col("k2")]
    ids = rows.select("doc_id", "k", "k2", F.length("text").cast("bigint").alias("n_chars")).distinct()
    at = staged(ids.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "doc-ranges")
    own = F.struct("k", "k2", "n_chars")
    inside = Window.partitionBy("range").orderBy(*order)
    seen = at.withColumn("at", F.row_number().over(inside)).withColumn("before", F.lag(own).over(inside))
    lasts = staged(seen.groupBy("range").agg(F.max_by(own, "at").alias("last")), "doc-range-ends")
    ring = Window.orderBy("range")
    edges = lasts.select(F.col("range").alias("e_range"), F.coalesce(
        F.lag("last").over(ring),
        F.last("last").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("edge"))
    # one row for each range: bounded by the partition count
    return seen.join(F.broadcast(edges), F.col("range") == F.col("e_range")).select(
        F.col("k").alias("o_k"), F.col("k2").alias("o_k2"), F.coalesce("before", "edge").alias("before"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's tree, its edited text's tree and the likenesses: see ``report`` for the columns."""
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    # k and k2 name a document (id and text); the same columns go into both joins below, which
    # then share one exchange of the texts
    rows = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("k"),
                       F.xxhash64("text", "doc_id", F.lit(1)).alias("k2"), "text")
    cycle = staged(_cycle(rows), "doc-order")
    # what the document before needs of this one: its first code points and its tree's root and sketch
    third = F.floor(F.col("before.n_chars") / 3).cast("int")
    heads = rows.join(cycle, (F.col("k") == F.col("o_k")) & (F.col("k2") == F.col("o_k2"))).select(
        F.col("before.k").alias("h_k"), F.col("before.k2").alias("h_k2"), F.col("doc_id").alias("next_doc_id"),
        F.substr("text", F.lit(1), third).alias("head"), tree(F.col("text")).alias("next"))
    heads = heads.select("h_k", "h_k2", "next_doc_id", "head", F.col("next.root").alias("next_root"), F.col("next.sketch").alias("next_sketch"))
    heads = heads.dropDuplicates(["h_k", "h_k2"])  # the next document may stand in several equal rows
    joined = rows.join(heads, (F.col("k") == F.col("h_k")) & (F.col("k2") == F.col("h_k2")))
    joined = joined.withColumn("n_chars", F.length("text").cast("bigint"))
    kept = (F.col("n_chars") - F.floor(F.col("n_chars") / 3)).cast("int")
    edited = joined.withColumn("edited", F.concat(F.substr("text", F.lit(1), kept), F.col("head")))
    return edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), tree(F.col("text")).alias("tree"),
                         tree(F.col("edited")).alias("edited_tree"), "next_doc_id", "next_root", "next_sketch")


def report(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_chars", "edited_sha256", F.col("tree.root").alias("fingerprint"),
        F.col("edited_tree.root").alias("edited_fingerprint"),
        likeness(F.col("tree.root"), F.col("tree.sketch"), F.col("edited_tree.root"), F.col("edited_tree.sketch")).alias("near_edited"),
        likeness(F.col("tree.root"), F.col("tree.sketch"), F.col("next_root"), F.col("next_sketch")).alias("near_next"),
        "next_doc_id", F.size("tree.sections").alias("n_sections"), F.size("tree.paragraphs").alias("n_paragraphs"),
        first_change(F.col("tree.paragraphs"), F.col("edited_tree.paragraphs")).alias("first_changed_paragraph"))
