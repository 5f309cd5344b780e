"""Conversation prefix trie by van Emde Boas recursion.

A sequence of turns is cut at half of the depth. Prefixes that end at the cut get a name (their
smallest conversation), the distinct left parts build the upper trie, and the right parts build lower
tries, one under each name. Both are tasks of half the depth and are solved together: one round
halves every block of depths, so a table of ``D`` turns takes log2(D) rounds. Totals go back the same
way: blocks are summed from single depths to the whole, then every block hands the totals that lie
below its cut names to the left half (grafting).

No step follows a conversation turn by turn, and none brings the rows of a conversation or of a node
into one task: positions come from a range partitioning, equal sequences become one item with a count
before anything else, and sums are partial sums first. Texts are hashed once (two independent 64-bit
hashes) and do not travel; the parts of a sequence are compared by the combined hashes of their
positions and turns.

Defined cases: rows without conv_id belong to no conversation and are left out; null roles and texts
are empty; the null turn comes first; rows of equal turn are ordered by role, then by hashes; repeated
rows are turns of their own; ``c - c % 20`` cuts towards zero; a table without conversations gives an
empty result, one with turnless conversations only gives the root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, staged
from .ordering import ascending_sha256, numbered

# Fixed values of the query's rebuilt conversations.
FAMILY, SHARED = 20, 4
WORD = r"[^\x20\x09-\x0D]+"


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), e1, e2 (hashes of role and text), words: one row per turn, in order."""
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), F.xxhash64(role, text).alias("e1"),
        F.xxhash64(F.lit(1), text, role).alias("e2"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"))
    # equal rows of one turn shrink to a count before they are ordered
    once = rows.groupBy("conv_id", "turn", "role", "e1", "e2").agg(F.count(F.lit(1)).alias("n"), F.first("words").alias("words"))
    at = numbered(once, "conv_id", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("e1"), F.col("e2")], "n", "trie-order")
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("copy")
    return at.select("conv_id", "pos", "e1", "e2", "words", copies).withColumn("pos", F.col("pos") + F.col("copy")).drop("copy")


def rebuilt(own: DataFrame, ids: DataFrame) -> DataFrame:
    """The sequences of the query: the first turns of the family's first conversation, then the own rest.

    ``own``: written turns; ``ids``: conv_id of all conversations. A family has at most 20 members, so
    the shared turns are copied at most that often.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % SHARED
    family = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")
    first = own.where((F.col("pos") < SHARED - 1) & (F.col("conv_id") % FAMILY == 0))
    lens = first.groupBy(F.col("conv_id").alias("b_id")).agg(F.count(F.lit(1)).alias("b_len"))
    convs = ids.select("conv_id", h.cast("bigint").alias("h"), family)
    convs = convs.join(lens, F.col("base") == F.col("b_id"), "left").select(
        F.col("conv_id").alias("c"), "h", "base", F.least("h", F.coalesce("b_len", F.lit(0))).alias("shared"))
    convs = staged(convs, "trie-conversations")
    head = convs.join(first, (F.col("base") == F.col("conv_id")) & (F.col("pos") < F.col("h"))).select(
        F.col("c").alias("conv_id"), "pos", "e1", "e2", "words")
    rest = own.join(convs, F.col("conv_id") == F.col("c")).where(F.col("pos") >= F.col("h")).select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("shared")).alias("pos"), "e1", "e2", "words")
    return head.unionByName(rest)


def _xor(*columns: str) -> list[Column]:
    return [F.bit_xor(c).alias(c) for c in columns]


def trie(sequences: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of the trie over ``sequences`` (conv_id, pos, e1, e2, words), with totals of their subtrees.

    ``ids`` (conv_id) are all conversations, also those without turns.
    """
    spark = sequences.sparkSession
    one = F.lit(1).cast("bigint")
    # a turn at its position: what the parts of a sequence are put together from
    block = staged(sequences.select("conv_id", F.col("pos").alias("b"), F.xxhash64("pos", "e1").alias("c1"),
                                    F.xxhash64("e2", "pos", F.lit(1)).alias("c2"), "words"), "trie-turns")
    top = ids.agg(F.min("conv_id").alias("root"), F.count(F.lit(1)).alias("n")).first()
    deepest = block.agg(F.max("b")).first()[0]
    root, n_all = top["root"], top["n"]
    nodes, n_children, leaves, saved = None, 0, 1, 0

    if deepest is None:
        ends = ids.select("conv_id", *[F.lit(0).cast("bigint").alias(c) for c in ("depth", "q1", "q2")])
    else:
        rounds = int(deepest).bit_length()
        content = [block.select("conv_id", "b", "c1", "c2", one.alias("n"))]
        for k in range(1, rounds + 1):     # the parts of 2**k turns, from those of half the size
            content.append(staged(content[-1].groupBy("conv_id", F.shiftright("b", 1).alias("b")).agg(
                *_xor("c1", "c2"), F.sum("n").alias("n")), "trie-parts"))
        whole = content[-1]
        nothing = F.lit(0).cast("bigint")
        # an item: one distinct part (c1, c2, n turns) of block b under the name g; rep is its smallest
        # conversation, w how many have it, p1, p2 stand for the path down to g
        items = [staged(whole.groupBy("c1", "c2", "n").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("w")).select(
            "rep", nothing.alias("b"), F.lit(root).cast("bigint").alias("g"), "w", "n", "c1", "c2", nothing.alias("p1"), nothing.alias("p2")),
            "trie-items")]
        for k in range(rounds, 0, -1):
            items.append(_halve(items[-1], content[k - 1], 1 << (k - 1)))
        items.reverse()
        nodes, sums = _own_values(items[0], block)
        ends = whole.select("conv_id", F.col("n").alias("depth"), F.col("c1").alias("q1"), F.col("c2").alias("q2"))
        turnless = ids.join(whole.select("conv_id"), "conv_id", "left_anti")
        ends = ends.unionByName(turnless.select("conv_id", *[nothing.alias(c) for c in ("depth", "q1", "q2")]))
        totals = [sums]
        for k in range(1, rounds + 1):
            totals.append(_sum_up(totals[-1], items[k - 1], 1 << (k - 1)))
        below = totals[-1].select("b", F.col("g").alias("w"), "leaves", "saved").where(F.lit(False))   # nothing yet
        for k in range(rounds, 0, -1):
            below = _graft(below, totals[k - 1], items[k - 1], 1 << (k - 1))
        whole_sum = totals[-1].first()
        leaves, saved = whole_sum["leaves"], whole_sum["saved"]
        n_children = nodes.where("depth = 1").count()
        under = below.select(F.col("b").alias("u_b"), F.col("w").alias("u_w"), F.col("leaves").alias("u_leaves"), F.col("saved").alias("u_saved"))
        nodes = nodes.join(under, (F.col("depth") - 1 == F.col("u_b")) & (F.col("conv_id") == F.col("u_w")), "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            (F.col("leaves") + F.coalesce("u_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("u_saved", F.lit(0))).alias("saved_tokens"), "q1", "q2")

    # the root has no text of its own, and is a leaf only if nothing is below it
    values = {"conv_id": root, "depth": 0, "parent_conv_id": None, "n_convs": n_all, "n_children": n_children,
              "n_leaves": leaves, "saved_tokens": saved, "q1": 0, "q2": 0}
    base = spark.range(int(n_all > 0)).select(*[F.lit(v).cast("bigint").alias(c) for c, v in values.items()])
    nodes = base if nodes is None else nodes.unionByName(base)
    digests = ascending_sha256(ends, ["depth", "q1", "q2"], "conv_id", "trie-ends")
    digests = digests.select(*[F.col(c).alias(f"e_{c}") for c in ("depth", "q1", "q2")], "sha256")
    return nodes.join(digests, (F.col("depth") == F.col("e_depth")) & (F.col("q1") == F.col("e_q1")) & (F.col("q2") == F.col("e_q2")), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def _halve(items: DataFrame, parts: DataFrame, half: int) -> DataFrame:
    """Items of blocks of ``2 * half`` turns -> items of ``half`` turns: upper tries and lower forests."""
    left = parts.where("b % 2 = 0").select(F.col("conv_id").alias("l_id"), F.shiftright("b", 1).alias("l_b"),
                                           F.col("c1").alias("l1"), F.col("c2").alias("l2"), F.col("n").alias("ln"))
    cut = staged(items.join(left, (F.col("rep") == F.col("l_id")) & (F.col("b") == F.col("l_b"))).select(
        "rep", "b", "g", "w", "n", "c1", "c2", "p1", "p2", "l1", "l2", "ln"), "trie-cut")
    upper = staged(cut.groupBy("b", "g", "l1", "l2", "ln").agg(
        F.min("rep").alias("name"), F.sum("w").alias("w"), F.first("p1").alias("p1"), F.first("p2").alias("p2")), "trie-names")
    # a name that very many items share is a hot key here: both sides are plain scans, whose skewed
    # partitions Spark splits
    lower = cut.where("n > ln").alias("i").join(upper.where(F.col("ln") == half).alias("u"), ["b", "g", "l1", "l2"]).select(
        F.col("i.rep").alias("rep"), (F.col("b") * 2 + 1).alias("b"), F.col("u.name").alias("g"), F.col("i.w").alias("w"),
        (F.col("i.n") - F.col("i.ln")).alias("n"), *[F.col(f"i.c{j}").bitwiseXOR(F.col(f"l{j}")).alias(f"c{j}") for j in (1, 2)],
        *[F.col(f"i.p{j}").bitwiseXOR(F.col(f"l{j}")).alias(f"p{j}") for j in (1, 2)])
    upper = upper.select(F.col("name").alias("rep"), (F.col("b") * 2).alias("b"), "g", "w", F.col("ln").alias("n"),
                         F.col("l1").alias("c1"), F.col("l2").alias("c2"), "p1", "p2")
    return staged(upper.unionByName(lower), "trie-items")


def _own_values(items: DataFrame, turns_of: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with their own values, and the sums of these by (depth, parent)."""
    words = turns_of.select(F.col("conv_id").alias("t_id"), F.col("b").alias("t_b"), "words")
    children = items.groupBy(F.col("b").alias("k_b"), F.col("g").alias("k_g")).agg(F.count(F.lit(1)).alias("n_children"))
    at = items.join(words, (F.col("rep") == F.col("t_id")) & (F.col("b") == F.col("t_b")))
    at = at.join(children, (F.col("b") + 1 == F.col("k_b")) & (F.col("rep") == F.col("k_g")), "left")
    nodes = staged(at.select(
        F.col("rep").alias("conv_id"), (F.col("b") + 1).alias("depth"), F.col("g").alias("parent_conv_id"), F.col("w").alias("n_convs"),
        F.coalesce("n_children", F.lit(0).cast("bigint")).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"),
        ((F.col("w") - 1) * F.col("words")).alias("saved"),
        *[F.col(f"p{j}").bitwiseXOR(F.col(f"c{j}")).alias(f"q{j}") for j in (1, 2)]), "trie-nodes")
    sums = nodes.groupBy((F.col("depth") - 1).alias("b"), F.col("parent_conv_id").alias("g")).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return nodes, staged(sums, "trie-sums")


def _names(items: DataFrame, half: int, side: int) -> DataFrame:
    """(n_b, n_g, n_w): the names at the bottom of the left (0) or right (1) blocks, and the names they lie under."""
    full = items.where((F.col("n") == half) & (F.col("b") % 2 == side))
    return full.select(F.col("b").alias("n_b"), F.col("g").alias("n_g"), F.col("rep").alias("n_w"))


def _sum_up(sums: DataFrame, items: DataFrame, half: int) -> DataFrame:
    """Sums by (block, name above it) of ``half`` turns -> the same for blocks of twice the size."""
    left = sums.where("b % 2 = 0").select("b", "g", "leaves", "saved")
    right = sums.where("b % 2 = 1").join(_names(items, half, 0), (F.col("b") - 1 == F.col("n_b")) & (F.col("g") == F.col("n_w")))
    both = left.unionByName(right.select("b", F.col("n_g").alias("g"), "leaves", "saved"))
    return staged(both.groupBy(F.shiftright("b", 1).alias("b"), "g").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "trie-sums")


def _graft(below: DataFrame, sums: DataFrame, items: DataFrame, half: int) -> DataFrame:
    """What lies below the bottom names (b, w) of blocks of ``2 * half`` turns -> the same for ``half`` turns.

    A right block keeps its bottom. Below a name at the cut lie the lower tries under it, and what lies
    below their bottoms.
    """
    keep = below.select((F.col("b") * 2 + 1).alias("b"), "w", "leaves", "saved")
    lower = sums.where("b % 2 = 1").select((F.col("b") - 1).alias("b"), F.col("g").alias("w"), "leaves", "saved")
    deeper = below.join(_names(items, half, 1), (F.col("b") * 2 + 1 == F.col("n_b")) & (F.col("w") == F.col("n_w"))).select(
        (F.col("n_b") - 1).alias("b"), F.col("n_g").alias("w"), "leaves", "saved")
    return staged(keep.unionByName(lower).unionByName(deeper).groupBy("b", "w").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "trie-below")


def query(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    ids = staged(pick(conversations, conv_id="conv_id").where("conv_id IS NOT NULL")
                 .select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct(), "trie-ids")
    own = staged(turns(conversations), "trie-own")
    return trie(rebuilt(own, ids), ids)
