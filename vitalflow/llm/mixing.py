"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources share all words of the corpus by weight, none beyond ``EPOCHS`` times its own size; the
excess is shared again by weight. Blocks of ``BLOCK`` words go to the sources by highest quotients
(target / (2n + 1)), which gives integer quotas; each source's quota goes to its shards the same
way, by shard size. Within a shard the documents stand in a seeded order and the quota takes whole
passes over them and then the first blocks of one more pass.

Only sources and shards reach the driver or one task as sums: a hot source is dealt over all
shards, whose number follows the number of documents up to ``MOST_SHARDS``. Highest quotients are found by bisection on the
divisor, so the cost does not depend on the number of blocks.

Defined cases: a null text has size 0 and nothing is taken of it; a null source is a source of its
own and sorts last; ties of quotients go to the source or shard that sorts first; rows that share a
doc_id are separate rows, placed by a hash of id and text, and equal rows next to each other; an
empty table or one without words takes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, small_batches, staged
from .hashing import released

WEIGHTS = (1, 2, 3)      # repeating, over the sources by code point
EPOCHS = 3               # no document is taken more often
BLOCK = 16               # words in a block
SHARD_DOCS = 512         # documents in a shard, about
MOST_SHARDS = 1 << 16    # a source's quotas are dealt over at most so many shards in one task
SEED = 17
MOST_SOURCES = 1_000_000
WHITE = r"[\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words: the runs between white space."""
    words = F.split(text, WHITE, -1)
    ends = F.when(F.get(words, F.lit(0)) == "", 1).otherwise(0) + F.when(F.element_at(words, -1) == "", 1).otherwise(0)
    n = F.size(words) - F.when((F.size(words) == 1) & (ends > 0), 1).otherwise(ends)
    return F.when(text.isNull(), 0).otherwise(n).cast("bigint")


def targets(sizes: np.ndarray, weights: np.ndarray, most: float = EPOCHS) -> np.ndarray:
    """Shares of the total by weight; what a source cannot take is shared again until none is above."""
    out, free, left = np.zeros(len(sizes)), sizes > 0, float(sizes.sum())
    while free.any():
        share = left * weights / weights[free].sum()
        over = free & (share >= most * sizes)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = most * sizes[over]
        left -= out[over].sum()
        free &= ~over
    return out


def apportion(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by highest quotients votes / (2n + 1), at most ``most`` each; ties to the first."""
    votes = np.asarray(votes, float)
    seats = int(min(seats, most[votes > 0].sum())) if len(votes) else 0
    given = np.zeros(len(votes), np.int64)
    if not seats:
        return given
    # seats that a quotient above q gives: n + 1 seats need votes / (2n + 1) > q
    at = lambda q: np.where(votes > 0, np.minimum(np.ceil(np.maximum(votes / q - 1, 0) / 2), most), 0).astype(np.int64)
    low, high = 0.0, votes.max()
    for _ in range(200):
        mid = (low + high) / 2
        if not low < mid < high:
            break
        if at(mid).sum() > seats:
            low = mid
        else:
            high = mid
    given = at(high)
    for _ in range(int(seats - given.sum())):  # equal quotients at the divisor: at most one for each row
        q = np.where((votes > 0) & (given < most), votes / (2 * given + 1), -1.0)
        given[int(q.argmax())] += 1
    return given


def plan_sources(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, block: int = BLOCK) -> DataFrame:
    """source, source_size, target, blocks of (source, source_size): one row per source."""
    got = sizes.limit(MOST_SOURCES + 1).collect()
    if len(got) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    got.sort(key=lambda r: (r["source"] is None, r["source"] or ""))  # str order is code point order
    size = np.array([r["source_size"] for r in got], float)
    target = targets(size, np.array([weights[i % len(weights)] for i in range(len(got))], float))
    blocks = apportion(target, int(round(target.sum() / block)), np.ceil(EPOCHS * size / block).astype(np.int64))
    # as an Arrow table: from a list Spark would start Python workers of another kind on every executor
    table = pa.table({"source": pa.array([r["source"] for r in got], pa.string()),
                      "source_size": pa.array([r["source_size"] for r in got], pa.int64()),
                      "target": pa.array(target, pa.float64()), "blocks": pa.array(blocks, pa.int64())})
    return sizes.sparkSession.createDataFrame(table, "source string, source_size bigint, target double, blocks bigint")


def _quotas(group: pd.DataFrame) -> pd.DataFrame:
    """One source's blocks over its shards, by shard size."""
    group = group.sort_values("shard")
    size = group["shard_size"].to_numpy()
    most = -(-EPOCHS * size // group["block"].iloc[0])
    group["quota"] = np.minimum(apportion(size, int(group["blocks"].iloc[0]), most) * group["block"].iloc[0], EPOCHS * size)
    return group[["source", "shard", "shard_size", "quota"]]


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, block: int = BLOCK, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, k, source, size, source_size, target, taken: one row per input row."""
    rows = pick(docs, doc_id=id_col, text=text_col, source=source_col)
    order = F.xxhash64("doc_id", "text", F.lit(SEED))
    light = staged(rows.select("doc_id", F.xxhash64("doc_id", "text").alias("k"), F.col("source").cast("string").alias("source"),
                               size_of(F.col("text")).alias("size"), order.alias("turn")), "mix-sizes")
    shards = min(MOST_SHARDS, max(1, light.count() // SHARD_DOCS))
    light = light.withColumn("shard", F.pmod(F.xxhash64("turn", F.lit(SEED)), F.lit(shards)))
    by_shard = staged(light.groupBy("source", "shard").agg(F.sum("size").alias("shard_size")), "mix-shards")
    plan = plan_sources(by_shard.groupBy("source").agg(F.sum("shard_size").alias("source_size")), weights, block)
    plan = F.broadcast(plan)  # one row for each source, at most MOST_SOURCES
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    dealt = by_shard.join(plan, same(by_shard, plan)).select(by_shard["source"], "shard", "shard_size", "blocks", F.lit(block).alias("block"))
    quotas = dealt.groupBy("source").applyInPandas(_quotas, "source string, shard bigint, shard_size bigint, quota bigint")
    quotas = staged(quotas, "mix-quotas").select(F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "shard_size", "quota")
    inside = Window.partitionBy("source", "shard").orderBy("turn", "doc_id", "k", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = light.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(quotas, placed["source"].eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard")))
    passes = F.when(F.col("shard_size") > 0, F.floor(F.col("quota") / F.col("shard_size"))).otherwise(0)
    rest = F.col("quota") - passes * F.col("shard_size")
    taken = F.col("size") * passes + F.least(F.greatest(rest - F.col("before"), F.lit(0)), F.col("size"))
    plan = plan.withColumnsRenamed({"source": "p_source"})
    return placed.join(plan, placed["source"].eqNullSafe(F.col("p_source"))).select(
        "doc_id", "k", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken"))


def query(docs: DataFrame) -> DataFrame:
    return mix(docs).drop("k", "source")


def first_words(text: str, n: int) -> str:
    """The text up to the end of its n-th word."""
    raw = text.encode("utf-8", "surrogatepass")
    word = ~np.isin(np.frombuffer(raw, np.uint8), (9, 10, 11, 12, 13, 32))
    ends = np.flatnonzero(np.diff(word.astype(np.int8), append=0) == -1)
    return raw[: int(ends[n - 1]) + 1].decode("utf-8", "surrogatepass") if 0 < n <= len(ends) else text if n else ""


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself, all columns of ``docs``: a row for every whole pass over a document, and one
    cut after the words of the last blocks. Documents that the mix does not take are not in it."""
    small_batches(docs.sparkSession)
    names = docs.columns
    plan = mix(docs, **how).where("taken > 0").select(F.col("k").alias("m_k"), "size", "taken")
    # equal rows have equal keys; they share their words evenly enough: the largest of them counts
    plan = staged(plan.groupBy("m_k").agg(F.max("size").alias("m_size"), F.max("taken").alias("m_taken")), "mix-taken")
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index('text')}"
    key = F.xxhash64(f"c{names.index('doc_id')}", text)
    copies = F.explode(F.sequence(F.lit(0), F.ceil(F.col("m_taken") / F.col("m_size")) - 1))
    out = plain.join(plan, key == F.col("m_k")).select("*", copies.alias("pass"))
    left = F.col("m_taken") - F.col("pass") * F.col("m_size")
    out = out.withColumn("left", F.when(left < F.col("m_size"), left))

    @F.pandas_udf("string")
    @released
    def cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, left in parts:
            yield pd.Series([t if pd.isna(n) else first_words(t, int(n)) for t, n in zip(texts, left)])

    out = out.withColumn(text, F.when(F.col("left").isNull(), F.col(text)).otherwise(cut(text, "left")))
    if "n_chars" in names:
        n_chars = f"c{names.index('n_chars')}"
        out = out.withColumn(n_chars, F.when(F.col("left").isNull(), F.col(n_chars)).otherwise(F.length(text)))
    return out.select(*plain.columns).toDF(*names)
