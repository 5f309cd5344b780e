"""Benchmark decontamination by spaced-seed hashing.

A mask names the token positions of a window that count; the rest may be substituted. Every window
of every text and of every test item is hashed under each mask, and equal hashes are joined. A hit
fixes the alignment of a text to an item; the aligned tokens are then compared: a text is
contaminated by an item if some window of 20 aligned tokens (or the whole item, if it is shorter)
agrees in at least three quarters of them. The masks are chosen so that any such window, of any 15
of 20 tokens or of three quarters of an item of 11 to 19, is hit by at least one of them (the tests
go through all patterns), so nothing that the comparison would accept is missed. Items of fewer tokens are matched whole: one hash of
all their tokens, joined with equally long windows of the texts. Letters of scripts that put no
spaces between words (Chinese, Japanese, Thai, Lao, Burmese, Khmer) are a token each.

Only small rows move: the test hashes are broadcast in blocks of at most ``BLOCK`` rows (a larger
test set takes more passes over the texts, none grows the broadcast), and a text's row carries its
token hashes only inside its own task. Of a run of windows that agree entirely only the first is
emitted, so a long passage that very many texts share costs a few rows for each text.

Defined cases: null and empty texts have no tokens and are clean; items without tokens never match;
items with fewer than ``LEAST`` tokens match if all their tokens stand in a row, so an item of one
word marks every text with that word; items without an id are named by a hash of their text;
rows with equal doc_id and text get equal results; empty tables give clean or empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, staged

MASKS = ("110111", "1101000011", "11001011", "110000001011")
LEAST = 11           # tokens of an item that is matched by masks
SPAN = max(map(len, MASKS))
WINDOW = 20          # aligned tokens looked at together
BLOCK = 200_000      # test hashes in one broadcast, about 150 bytes each

# Thai to Lao, Burmese, Khmer; with them Chinese characters and Japanese syllables
_MARKED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\ua9e0-\ua9ff\uaa60-\uaa7f"
_UNSPACED = (rf"[{_MARKED}\u3005-\u3007\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
             r"\uff66-\uff9f\x{20000}-\x{3ffff}]")
_BETWEEN = rf"(?:(?!\p{{M}})[^\p{{L}}\p{{N}}]|(?![{_MARKED}\u3099\u309a])\p{{M}})+"  # vowel signs stay


def tokens(text: Column) -> Column:
    low = F.lower(text)
    single = F.split(F.regexp_replace(low, rf"({_UNSPACED}\p{{M}}*)", " $1 "), _BETWEEN)
    return F.array_remove(F.when(low.rlike(_UNSPACED), single).otherwise(F.split(low, r"[^\p{L}\p{N}]+")), "")


def _hashes(df: DataFrame) -> DataFrame:
    return df.withColumn("h", F.transform(tokens(F.col("text")), lambda t: F.xxhash64(t))).drop("text")


def _seeds(df: DataFrame, *keys: str) -> DataFrame:
    """Keys, h, pos, seed: all windows under all masks; a window that ends beyond the text has no seed.

    ``posexplode`` keeps the walk in generated code; the outer form, as the plain one would compute
    the hashes once more to test for empty arrays.
    """
    at = df.select(*keys, "h", F.posexplode_outer("h").alias("pos", "first"))
    of = [F.when(F.col("pos") + len(mask) <= F.size("h"),
                 F.xxhash64(F.lit(m), *[F.get("h", F.col("pos") + i) for i, c in enumerate(mask) if c == "1"]))
          for m, mask in enumerate(MASKS)]
    return at.select(*keys, "h", "pos", F.explode(F.array(*of)).alias("seed")).where(F.col("seed").isNotNull())


def _window_before() -> Column:
    """The window of ``SPAN`` tokens that starts one token earlier; null at the start of a text."""
    return F.when(F.col("pos") > 0, F.slice("h", F.greatest(F.col("pos"), F.lit(1)), F.lit(SPAN)))


def _best_window(item: Column, text: Column) -> Column:
    """Most agreeing tokens in a window, of the item's and the text's aligned tokens."""
    same = F.zip_with(item, text, lambda a, b: F.when(a == b, 1).otherwise(0))
    width = F.least(F.lit(WINDOW), F.col("item_size"))
    sums = F.transform(F.sequence(F.lit(0), F.greatest(F.size(item) - width, F.lit(0))),
                       lambda i: F.aggregate(F.slice(same, i + 1, width), F.lit(0), lambda a, x: a + x))
    return F.array_max(sums)


def _items(items: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    """item_id, item_h; an item without an id is named by a hash of its text."""
    rows = pick(items, item_id=item_col, text=item_text_col).where(F.col("text").isNotNull())
    kind = rows.schema["item_id"].dataType.simpleString()
    name = F.hash("text") if kind == "int" else F.xxhash64("text")
    if kind not in ("int", "bigint"):
        rows, name = rows.withColumn("item_id", F.col("item_id").cast("string")), name.cast("string")
    test = _hashes(rows.withColumn("item_id", F.coalesce("item_id", name))).withColumnRenamed("h", "item_h")
    return test.where(F.size("item_h") > 0).dropDuplicates(["item_id", "item_h"])


def _whole_matches(own: DataFrame, short: DataFrame) -> list[DataFrame]:
    """k, item_id, agree for items too short for the masks, a frame for each block of items."""
    sizes = sorted(r["n"] for r in short.select(F.size("item_h").alias("n")).distinct().collect())  # below LEAST
    if not sizes:
        return []

    def whole(h: str, pos: Column, n: int) -> Column:
        return F.xxhash64(F.lit(n), *[F.get(h, pos + i) for i in range(n)])

    seeds = staged(short.withColumn("t_seed", F.coalesce(*[
        F.when(F.size("item_h") == n, whole("item_h", F.lit(0), n)) for n in sizes])), "test-short")
    blocks = max(1, -(-seeds.count() // BLOCK))
    at = own.select("k", "h", F.posexplode_outer("h").alias("pos", "first"))
    at = at.select("k", "h", "pos", F.explode(F.array(*[whole("h", F.col("pos"), n) for n in sizes])).alias("seed"))
    same = (F.col("seed") == F.col("t_seed")) & (F.slice("h", F.col("pos") + 1, F.size("item_h")) == F.col("item_h"))
    return [at.join(F.broadcast(seeds.where(F.pmod(F.xxhash64("t_seed", F.lit(7)), F.lit(blocks)) == b)), same)
            .select("k", "item_id", F.size("item_h").alias("agree")).distinct() for b in range(blocks)]


def contaminations(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """k, item_id, agree: the items that each text holds (k names a text, see ``flag``)."""
    every = staged(_items(items, item_col, item_text_col), "test-items")
    test = every.where(F.size("item_h") >= LEAST)
    seeds = staged(_seeds(test.withColumnRenamed("item_h", "h"), "item_id").select(
        "seed", "item_id", F.col("pos").alias("item_pos"), F.col("h").alias("item_h"),
        _window_before().alias("item_before")).dropDuplicates(), "test-seeds")
    blocks = max(1, -(-seeds.count() // BLOCK))
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.xxhash64("doc_id", "text").alias("k"), "text")
    short = _whole_matches(_hashes(rows), every.where(F.size("item_h") < LEAST))
    own = _seeds(_hashes(rows), "k")

    def hits(block: int) -> DataFrame:
        part = seeds.where(F.pmod(F.xxhash64("seed", F.lit(7)), F.lit(blocks)) == block).withColumnRenamed("seed", "t_seed")
        again = F.coalesce(_window_before() == F.col("item_before"), F.lit(False))
        met = own.join(F.broadcast(part), (F.col("seed") == F.col("t_seed")) & ~again)
        at = F.col("pos") - F.col("item_pos")
        low = F.greatest(F.lit(0), -at)
        n = F.least(F.size("item_h"), F.size("h") - at) - low
        return met.select("k", "item_id", F.size("item_h").alias("item_size"), F.slice("item_h", low + 1, n).alias("item"),
                          F.slice("h", at + low + 1, n).alias("own"))

    # written, so that the comparison is not drawn into the join, which then would leave generated
    # code and copy a text's hashes for each of its windows
    found = staged(reduce(DataFrame.unionByName, [hits(b) for b in range(blocks)]), "seed-hits")
    found = found.withColumn("agree", _best_window(F.col("item"), F.col("own")))
    width = F.least(F.lit(WINDOW), F.col("item_size"))
    found = found.where(F.col("agree") * 4 >= width * 3).select("k", "item_id", "agree")
    return (reduce(DataFrame.unionByName, short, found)
            .groupBy("k", "item_id").agg(F.max("agree").alias("agree")))


def flag(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, k, contaminated, n_items, items (ids, ascending, comma-joined), agree: one row per input row."""
    found = contaminations(docs, items, id_col, text_col, item_col, item_text_col)
    by_text = found.groupBy(F.col("k").alias("f_k")).agg(
        F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list("item_id")).alias("items"),
        F.max("agree").alias("agree"))
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.xxhash64("doc_id", "text").alias("k"))
    out = rows.join(by_text, F.col("k") == F.col("f_k"), "left")
    return out.select("doc_id", "k", F.col("f_k").isNotNull().alias("contaminated"),
                      F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
                      F.coalesce(F.array_join("items", ","), F.lit("")).alias("items"),
                      F.coalesce("agree", F.lit(0)).cast("bigint").alias("agree"))


def remove_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, whose text holds no test item."""
    bad = staged(contaminations(docs, items, id_col, text_col).select(F.col("k").alias("bad_k")).distinct(), "contaminated")
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key = F.xxhash64(f"c{names.index(id_col)}", f"c{names.index(text_col)}")
    return plain.join(bad, key == F.col("bad_k"), "left_anti").toDF(*names)


_SQL_MASKS = ("11101001011", "11011000111", "10110110101")  # of the SQL, which finds no more than these hit
_SQL_SPAN = len(_SQL_MASKS[0])


def _sql_seeds(table: str, key: str) -> str:
    masks = ", ".join("[" + ", ".join(str(i) for i, c in enumerate(m) if c == "1") + "]" for m in _SQL_MASKS)
    return (f"SELECT {key}, p, m, [h[p + o] FOR o IN masks[m]] AS seed FROM (SELECT {key}, h, "
            f"unnest(range(1, len(h) - {_SQL_SPAN - 2})) AS p FROM {table}), "
            f"(SELECT [{masks}] AS masks, unnest([1, 2, 3]) AS m)")


ORACLE = rf"""
WITH dt AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+') IF x <> ''] AS h
            FROM documents WHERE text IS NOT NULL),
     bt AS (SELECT item_id, [x FOR x IN regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+') IF x <> ''] AS h
            FROM benchmark WHERE text IS NOT NULL),
     ds AS ({_sql_seeds("dt", "doc_id")}),
     bs AS ({_sql_seeds("bt", "item_id")}),
     hit AS (SELECT DISTINCT doc_id, item_id, ds.p - bs.p AS diag FROM ds JOIN bs ON ds.m = bs.m AND ds.seed = bs.seed),
     al AS (SELECT doc_id, item_id, diag, least({WINDOW}, len(bt.h)) AS width,
                   [CASE WHEN bt.h[i] = dt.h[i + diag] THEN 1 ELSE 0 END
                    FOR i IN range(greatest(1, 1 - diag), least(len(bt.h), len(dt.h) - diag) + 1)] AS same
            FROM hit JOIN dt USING (doc_id) JOIN bt USING (item_id)),
     sc AS (SELECT doc_id, item_id, width, list_max([list_sum(same[i:i + width - 1])
                   FOR i IN range(1, greatest(len(same) - width, 0) + 2)]) AS agree FROM al),
     ok AS (SELECT doc_id, item_id, max(agree) AS agree FROM sc WHERE agree * 4 >= width * 3 GROUP BY ALL),
     g AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items, max(agree) AS agree
           FROM ok GROUP BY doc_id)
SELECT d.doc_id, g.doc_id IS NOT NULL AS contaminated, coalesce(g.n_items, 0) AS n_items,
       coalesce(g.items, '') AS items, coalesce(g.agree, 0)::BIGINT AS agree
FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id
"""
