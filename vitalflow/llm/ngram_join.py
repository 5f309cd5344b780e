"""N-gram Jaccard join with adaptive multi-match prefixes.

A text's set holds its distinct shingles. Sets are sorted by a global order, rare shingles first
(by counts over all texts in hashed buckets, then by how many prefixes hold them). Two sets of Jaccard similarity t or more share at least
m shingles within their m-prefixes, the first n - ceil(t n) + m of each; each set picks its own m by
the estimated cost of its candidates, and a pair is a candidate if it shares as many prefix
shingles as the lesser of its two m, and as many as their lengths then demand (see ``_pairs``).
Candidates are verified exactly.

Equal sets are one class from the start, so copies cost one row each. A posting list of at most
``LIST`` sets yields its pairs. Longer ones (families of near copies) never do: each set has a home,
the longest such list it is in, and visits the homes that it meets in other lists; residents and
visitors of a home are compared block by block with matrix products, and only the links that connect
a block's sets leave the task. No link between different sets is lost to the components.

Defined cases: ASCII letters are lower-cased, words are runs without white space; a text of fewer
words than a shingle takes is one shingle; texts without words and null texts have no shingles and
stand alone; null doc_ids give null component ids unless a linked row has one; rows that share a
doc_id are separate nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few_tasks, pick, small_batches, staged
from .components import components
from .hashing import drop_kept, mix, release, released, sliced, word_hashes

BUCKETS = 1 << 18            # of the shingle counts that give the global order
CLASSES = 4                  # order classes per doubling of a count
MOST_MATCHES = 4             # largest m
LAST = 255                   # order class of shingles found to be common
REFINE = 2                   # times that the prefixes are searched for common shingles
MOST_COMMON = 1_000_000      # common shingles that move to the end, the most common ones first
VERIFY = 8.0                 # cost of a candidate against that of a posting
LIST = 32                    # sets in a posting list that still yields its pairs
BLOCK = 256                  # sets of a home compared at once with as many others
COLUMNS = 4096               # shingles in one step of the comparison


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    out = []
    for h in word_hashes([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]):
        w = min(words, len(h))
        if w == 0:
            out.append(h)
            continue
        s = np.full(len(h) - w + 1, w, np.uint64)
        for j in range(w):
            s = mix(s * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - w + 1 + j])
        out.append(np.unique(s))
    return out


def digest(s: np.ndarray) -> int:
    """A 64-bit name of a set."""
    total = int(mix(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)) + len(s) * 0xE7037ED1A0B428DB
    return int(mix(np.array([total % (1 << 64)], np.uint64)).astype(np.int64)[0])


def order_keys(s: np.ndarray, classes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Shingles as places in the global order: class of their count, then hash.

    ``common``: places, ascending, of shingles found to be common; they move to the end of the order.
    """
    c = classes[s & np.uint64(BUCKETS - 1)].astype(np.uint64)
    keys = ((c << np.uint64(55)) | (s >> np.uint64(9))).astype(np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, keys), len(common) - 1)
        keys[common[at] == keys] |= np.int64(LAST << 55)
    return keys


def prefix(keys: np.ndarray, cost: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The prefix of a set given as order keys, and its m. ``cost``: list length by class."""
    n = len(keys)
    base = n - -(-percent * n // 100)
    most = min(n, base + MOST_MATCHES)
    first = np.sort(np.partition(keys, most - 1)[:most] if most < n else keys)
    lists = np.cumsum(cost[first >> np.int64(55)])
    sums = lists[base:most]  # for m = 1, 2, ...: the postings of an m-prefix
    m = int((sums + VERIFY * sums / np.arange(1, len(sums) + 1)).argmin()) + 1
    return first[: base + m], m


def _describe(words: int):
    """Every text's set size and digest, and at the end of a partition the shingle counts by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        names = ["doc_id", "k", "n", "d", "bucket", "count"]
        kind = None
        for batch in (part for whole in batches for part in sliced(whole)):
            kind = batch.column("doc_id").type
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            counts += np.bincount((np.concatenate(sets) & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
            none = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("k"), pa.array([len(s) for s in sets], pa.int32()),
                 pa.array([digest(s) if len(s) else None for s in sets], pa.int64()), *none], names)
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(used), kind), *[pa.nulls(len(used), t) for t in (pa.int64(), pa.int32(), pa.int64())],
                 pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], names)

    return released(run)


def order_classes(buckets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Order class of every bucket and list length by class, from (bucket, count): at most BUCKETS rows."""
    got = buckets.groupBy("bucket").agg(F.sum("count").alias("n")).toArrow()
    n = np.zeros(BUCKETS)
    n[got["bucket"].to_numpy()] = got["n"].to_numpy()
    classes = np.minimum(LAST - 1, np.floor(CLASSES * np.log2(n + 1))).astype(np.uint8)
    usual = np.median(n)  # what unrelated shingles bring to a bucket
    cost = np.maximum(0, 2 ** (np.arange(LAST + 1) / CLASSES) - 2 * usual) + 1
    cost[LAST] = 32 * LIST
    return classes, cost


def _postings(shared, words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, cost, common = shared.value
        seen: set[int] = set()
        for batch in (part for whole in batches for part in sliced(whole)):
            tokens, names, sizes, needs = [], [], [], []
            for s in shingle_sets(batch.column("text").to_pylist(), words):
                if not len(s) or (d := digest(s)) in seen:
                    continue
                if len(seen) > 200_000:  # only spares repeated rows, which are dropped later anyway
                    seen.clear()
                seen.add(d)
                first, m = prefix(order_keys(s, classes, common), cost, percent)
                tokens.append(first)
                names.append(np.full(len(first), d))
                sizes.append(np.full(len(first), len(s), np.int32))
                needs.append(np.full(len(first), m, np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, names, sizes, needs)],
                                                 ["token", "d", "n", "need"])

    return released(run)


def _posts(rows: DataFrame, order: tuple, words: int, percent: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(order)
    return rows.select("text").mapInArrow(_postings(shared, words, percent), "token bigint, d bigint, n int, need int")


def refined(rows: DataFrame, classes: np.ndarray, cost: np.ndarray, words: int, percent: int) -> tuple:
    """The order with common shingles moved to its end.

    A bucket's count cannot tell a shingle of a passage that some hundred texts share from the
    usual traffic of its bucket. Prefixes are therefore made and counted, over all texts; what is in
    more than ``LIST`` of them moves to the end, and prefixes close up with rarer shingles. Only the
    order depends on this, so nothing is lost if a common shingle is missed.
    """
    common = np.zeros(0, np.int64)
    for _ in range(REFINE):
        found = _posts(rows, (classes, cost, common), words, percent).groupBy("token").agg(F.count(F.lit(1)).alias("c"))
        found = found.where((F.col("c") > LIST) & (F.shiftright("token", 55) < LAST))
        got = found.orderBy(F.desc("c"), "token").limit(MOST_COMMON).toArrow()["token"].to_numpy()
        if not len(got):
            break
        common = np.union1d(common, got)
    return classes, cost, common


def posting_lists(rows: DataFrame, order: tuple, words: int, percent: int, most: int) -> DataFrame:
    """token, d, n, need, c: the postings of tokens that two sets or more have; c counts the sets. ``most``: postings at most."""
    posts, cost = _posts(rows, order, words, percent), order[1]
    heavy = F.element_at(F.array(*[F.lit(bool(c > 16 * LIST)) for c in cost]), F.shiftright("token", 55).cast("int") + 1)
    # a token that many sets may share is counted map-side and joined, so its rows need not meet in
    # one task; the others meet once, by token
    light = posts.where(~heavy).repartition("token").dropDuplicates(["token", "d"])
    light = light.withColumn("c", F.expr("count(*) OVER (PARTITION BY token)")).where("c > 1")
    hot = staged(posts.where(heavy).dropDuplicates(["token", "d"]), "heavy-postings", most)
    counts = staged(hot.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "heavy-counts", hot.count())
    return staged(few_tasks(light, most).unionByName(hot.join(counts, "token").select("token", "d", "n", "need", "c")), "posting-lists")


def _pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Candidates (u, v) of the short lists: pairs that share enough prefix shingles.

    At least the lesser m. And more, if the sets are to link: they then share at least
    a = ceil(t / (1 + t) * (n_u + n_v)) shingles, so at most n - a of a set's prefix are not in the
    other set. Of the two prefixes, all the shared shingles of the one that ends first lie in both:
    at least one set has prefix length - (n - a) = a - ceil(t n) + m of them there.
    """
    near = lambda a, b: (F.least(a["n"], b["n"]) * 100 >= F.greatest(a["n"], b["n"]) * percent)
    each = F.transform("sets", lambda a: F.transform(
        F.filter("sets", lambda b: (b["d"] > a["d"]) & near(a, b)),
        lambda b: F.struct(a["d"].alias("u"), b["d"].alias("v"), a["n"].alias("n_u"), b["n"].alias("n_v"),
                           a["need"].alias("m_u"), b["need"].alias("m_v"))))
    lists = lists.groupBy("token").agg(F.collect_list(F.struct("d", "n", "need")).alias("sets"))
    pairs = lists.select(F.explode(F.flatten(each)).alias("p")).select("p.*")
    pairs = pairs.groupBy(*pairs.columns).agg(F.count(F.lit(1)).alias("shared"))
    up = lambda x, y: F.expr(f"({x} + {y} - 1) div {y}")
    both = up(f"{percent}L * (n_u + n_v)", 100 + percent)
    enough = F.least(both - up(f"{percent}L * n_u", 100) + F.col("m_u"), both - up(f"{percent}L * n_v", 100) + F.col("m_v"))
    return pairs.where(F.col("shared") >= F.greatest(F.least("m_u", "m_v"), enough)).select("u", "v")


def _homes(lists: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Residents (home, d) and visitors (home, d) of the long lists, which have so many rows.

    Two sets that meet in a long list either share a home, or the one with the lesser home visits
    the other's: every such pair is compared in exactly one home.
    """
    home = staged(lists.groupBy("d").agg(F.max(F.struct("c", "token")).alias("home")), "homes", rows)
    at = staged(lists.join(home, "d").select("token", "d", "home"), "home-postings")
    there = staged(at.select(F.col("token").alias("t_token"), F.col("home").alias("other")).distinct(), "home-tokens", rows)
    visits = at.join(there, F.col("token") == F.col("t_token")).where(F.col("other") > F.col("home"))
    return (home.select(F.col("home.token").alias("home"), "d"),
            staged(visits.select(F.col("other.token").alias("home"), "d").distinct(), "home-visits"))


def _block_rows(residents: DataFrame, visitors: DataFrame) -> tuple[DataFrame, int]:
    """home, i, j, guest, d: the sets that each comparison (block i with block j) needs; and how many rows these are at most.

    ``j`` >= 0 are blocks of residents, i <= j; -1 - b is block b of the visitors, against residents i.
    """
    blocks = residents.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nb"))
    guests = visitors.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nv"))
    sizes = blocks.join(guests, "home", "left").fillna(0, ["nv"])
    sizes = staged(sizes, "home-blocks").withColumnRenamed("home", "b_home")
    most = BLOCK * (sizes.agg(F.sum(F.expr("bigint(nb) * (nb + 2 * nv)"))).first()[0] or 0)
    own = residents.join(sizes, F.col("home") == F.col("b_home"))
    own = own.withColumn("b", F.pmod(F.xxhash64("d", F.lit(3)), F.col("nb")).cast("int"))
    with_own = own.select("home", "d", "b", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("x")).select(
        "home", F.least("b", "x").alias("i"), F.greatest("b", "x").alias("j"), F.lit(False).alias("guest"), "d")
    with_guests = own.where("nv > 0").select("home", "d", "b", F.explode(F.sequence(F.lit(0), F.col("nv") - 1)).alias("x")).select(
        "home", F.col("b").alias("i"), (-1 - F.col("x")).alias("j"), F.lit(False).alias("guest"), "d")
    come = visitors.join(sizes, F.col("home") == F.col("b_home"))
    come = come.withColumn("b", F.pmod(F.xxhash64("d", F.lit(3)), F.col("nv")).cast("int"))
    come = come.select("home", "d", "b", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("i")).select(
        "home", "i", (-1 - F.col("b")).alias("j"), F.lit(True).alias("guest"), "d")
    return with_own.unionByName(with_guests).unionByName(come), most


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets link: a square Boolean matrix, from matrix products over their shared shingles."""
    size = np.array([len(s) for s in sets])
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    shared = count[place] > 1
    new = np.cumsum(count > 1) - 1
    row, col = row[shared], new[place[shared]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int((count > 1).sum()), COLUMNS):
        a, b = np.searchsorted(col, [low, low + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row[a:b], col[a:b] - low] = 1
        both += part @ part.T
    both = np.rint(both).astype(np.int64)
    return 100 * both >= percent * (size[:, None] + size[None, :] - both)


def _connect(words: int, percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """The links that connect the sets of one comparison: each set with the least one it reaches."""
        drop_kept()
        names = group["d"].to_numpy(np.int64)
        link = linked(shingle_sets(group["text"].tolist(), words), percent)
        if group["j"].iloc[0] < 0:  # visitors meet residents, not each other
            guest = group["guest"].to_numpy(bool)
            link &= guest[:, None] != guest[None, :]
        np.fill_diagonal(link, True)
        label = np.arange(len(names))
        while True:
            new = np.where(link, label[None, :], len(names)).min(1)
            new = new[new]
            if (new == label).all():
                break
            label = new
        far = np.flatnonzero(label != np.arange(len(names)))
        release()
        return pd.DataFrame({"u": names[far], "v": names[label[far]]})

    return run


def _verify(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in sliced(whole, "text_u")):
            left = shingle_sets(batch.column("text_u").to_pylist(), words)
            right = shingle_sets(batch.column("text_v").to_pylist(), words)
            both = np.array([len(a) + len(b) - len(np.union1d(a, b)) for a, b in zip(left, right)], np.int64)
            size = np.array([len(a) + len(b) for a, b in zip(left, right)], np.int64)
            keep = pa.array(100 * both >= percent * (size - both))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(keep)

    return released(run)


BROADCAST_ROWS = 1_000_000   # keys that are broadcast at most; beyond it the texts are shuffled


def _checked(keys: DataFrame) -> DataFrame:
    """A written table of keys, broadcast if it has few rows."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def _texts_of(rows: DataFrame, classes: DataFrame, needed: DataFrame, most: int) -> DataFrame:
    """d, text: one text of each needed class, of ``most`` at most. Texts move, not their shingles, which are larger."""
    wanted = staged(classes.join(needed, "d", "left_semi").select(F.col("rep_k").alias("w_k"), "d"), "needed-texts", most)
    some = rows.select("k", "text").join(_checked(wanted), F.col("k") == F.col("w_k"))
    return staged(some.dropDuplicates(["k"]).select("d", "text"), "texts")


def join(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, k, n_shingles, root, component_id: one row per input row.

    Texts link from ``percent`` Jaccard similarity on; ``root`` names the component (null without
    shingles), ``component_id`` is its least doc_id.
    """
    small_batches(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.xxhash64("doc_id", "text").alias("k"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    told = staged(rows.mapInArrow(_describe(words), f"doc_id {kind}, k bigint, n int, d bigint, bucket int, count bigint"), "set-digests")
    order, cost = order_classes(told.where("bucket IS NOT NULL").select("bucket", "count"))
    own = told.where("bucket IS NULL").select("doc_id", "k", "n", "d")
    full = own.where("n > 0")
    size = full.agg(F.count(F.lit(1)).alias("sets"), F.sum(F.expr(f"n - ceil({percent}L * n / 100) + {MOST_MATCHES}")).alias("posts")).first()
    classes = staged(full.groupBy("d").agg(F.min("doc_id").alias("rep"), F.min("k").alias("rep_k")), "set-classes", size["sets"])

    lists = posting_lists(rows, refined(rows, order, cost, words, percent), words, percent, size["posts"] or 0)
    short = F.col("c") <= LIST
    size_of = lists.agg(F.sum(F.when(short, F.col("c") - 1)).alias("twice"), F.count_if(~short).alias("long")).first()
    pairs = staged(_pairs(lists.where(short), percent), "candidates", (size_of["twice"] or 0) // 2)
    residents, visitors = _homes(lists.where(~short), size_of["long"])
    needed = (pairs.select(F.col("u").alias("d")).unionByName(pairs.select(F.col("v").alias("d")))
              .unionByName(residents.select("d")).unionByName(visitors.select("d")).distinct())
    texts = _texts_of(rows, classes, needed, size["sets"])

    both = pairs.join(texts.select(F.col("d").alias("u"), F.col("text").alias("text_u")), "u")
    both = both.join(texts.select(F.col("d").alias("v"), F.col("text").alias("text_v")), "v").select("u", "v", "text_u", "text_v")
    cold = both.mapInArrow(_verify(words, percent), "u bigint, v bigint")
    blocks, most = _block_rows(residents, visitors)
    hot = blocks.join(texts, "d").groupBy("home", "i", "j").applyInPandas(_connect(words, percent), "u bigint, v bigint")
    found = components(cold.unionByName(hot), pairs.count() + most)

    roots = classes.join(found.select(F.col("u").alias("d"), "root"), "d", "left").withColumn("root", F.coalesce("root", "d"))
    roots = staged(roots, "set-roots", size["sets"])
    least = staged(roots.groupBy("root").agg(F.min("rep").alias("component_id")), "component-ids", size["sets"])
    named = staged(roots.join(least, "root").select(F.col("d").alias("c_d"), "root", "component_id"), "set-components")
    # both sides are plain scans: the partition of a class that very many rows share can be split
    return own.join(named, F.col("d") == F.col("c_d"), "left").select(
        "doc_id", "k", F.col("n").cast("bigint").alias("n_shingles"), "root",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def query(docs: DataFrame) -> DataFrame:
    return join(docs, words=3, percent=90).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all their columns, with one document of each group: that of the least doc_id."""
    names = docs.columns
    found = staged(join(docs, words, percent), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k")
    first = staged(found.where("root IS NOT NULL").groupBy("root").agg(F.min(order).alias("first")).select(
        F.col("root").alias("f_root"), F.col("first.k").alias("f_k")), "group-firsts", found.count())
    # the rows to drop are the few; both sides of this join are plain scans, so a hot group is split
    drop = found.where("root IS NOT NULL").join(first, (F.col("root") == F.col("f_root")) & (F.col("k") != F.col("f_k")))
    drop = staged(drop.select(F.col("k").alias("d_k")).distinct(), "dropped-rows")
    again = found.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() > 0
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key = F.xxhash64(f"c{names.index('doc_id')}", f"c{names.index('text')}")
    kept = plain.withColumn("k", key).join(_checked(drop), F.col("k") == F.col("d_k"), "left_anti")
    if again:  # equal rows are one document
        kept = kept.dropDuplicates(["k"])
    return kept.select(*plain.columns).toDF(*names)
