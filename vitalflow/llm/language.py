"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of 1- to 3-grams per language come from a bounded sample of the learning rows, counted in
Spark. The matrix of log-probabilities (buckets x languages) is broadcast, and each batch of texts
is scored as a sparse product: the rows of its n-grams, summed per text.

Defined cases: ``und`` with score 0 for a null text, for one without a letter, and where there is
nothing to learn from. Letters are those of the Unicode categories L. The language is the one of the
greatest posterior over the whole text; the score is its posterior with the evidence of at most 100 n-grams, so it
stays below 1 on mixed texts. Ties go to the language that sorts first. Every text is scored whole,
in pieces of bounded size. Repeated rows get equal results of their own; an empty table gives an empty
result. Where no language can be learned, ``keep_identified`` keeps every row: nothing is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, small_batches
from .hashing import released, sliced

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
LEARN_PER_LANGUAGE = 2000    # about so many documents of each language are learned from
EVIDENCE = 100               # n-grams that the posterior counts at most
PIECE = 1 << 18              # code points scored at once
LATIN = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(LATIN.search(text)) or any(map(str.isalpha, text))


def grams(points: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each code point; BUCKETS where it would leave its text."""
    h = np.full(len(points), order, np.uint32)
    for i in range(order):
        h[: len(h) - i] = (h[: len(h) - i] ^ points[i:]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    out = (h >> np.uint32(16)).astype(np.int32)
    for i in range(1, order):
        out[ends - i] = BUCKETS
    return out


def pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text numbers, starts, code points) of whole texts, or of parts of long ones, of bounded size.

    Each text stands between spaces; the parts of a long one share two code points.
    """
    who, start, parts, size = [], [], [], 0
    for n, text in enumerate(texts):
        p = np.frombuffer(f" {text.lower()}  ".encode("utf-32-le", "surrogatepass"), "<u4")
        for low in range(0, max(1, len(p) - 2), PIECE - 2):
            part = p[low:low + PIECE]
            if size + len(part) > PIECE and size:
                yield np.array(who), np.array(start), np.concatenate(parts)
                who, start, parts, size = [], [], [], 0
            who.append(n)
            start.append(size)
            parts.append(part)
            size += len(part)
    if size:
        yield np.array(who), np.array(start), np.concatenate(parts)


class Model:
    """Languages, their log-priors and the matrix of log-probabilities (its last row is zero)."""

    def __init__(self, languages: list[str], counts: np.ndarray, documents: np.ndarray):
        self.languages = languages
        if languages:
            p = np.log(counts + 0.5) - np.log(counts.sum(0) + 0.5 * BUCKETS)
            p -= p.mean(1, keepdims=True)  # only differences between languages matter
            self.matrix = np.vstack([p, np.zeros((1, len(languages)))]).astype(np.float32)
            self.prior = np.log((documents + 1.0) / (documents.sum() + len(documents)))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        known = [n for n, t in enumerate(texts) if t and self.languages and has_letter(t)]
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        total = np.zeros((len(known), len(self.languages)))
        n_grams = np.zeros(len(known))
        for who, start, points in pieces([texts[n] for n in known]):
            ends = np.append(start[1:], len(points))
            for order in ORDERS:
                b = grams(points, ends, order)
                np.add.at(total, who, np.add.reduceat(self.matrix[b], start, axis=0))
            np.add.at(n_grams, who, (ends - start) * len(ORDERS))
        if known:
            best = (total + self.prior).argmax(1)
            z = total * (np.minimum(n_grams, EVIDENCE) / n_grams)[:, None] + self.prior
            z = np.exp(z - z.max(1, keepdims=True))
            p = z[np.arange(len(z)), best] / z.sum(1)
            for n, b, s in zip(known, best, p):
                names[n], scores[n] = self.languages[b], float(s)
        return names, scores


def _sampled(rows: DataFrame, per_class: dict, column: str) -> DataFrame:
    """About the given share of each class's rows, chosen by a hash of the id, the same in every run."""
    share = F.create_map(*[x for c, s in per_class.items() for x in (F.lit(c), F.lit(float(s)))])
    unit = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return rows.where(unit < share[F.col(column)])


def train(learn: DataFrame, per_language: int = LEARN_PER_LANGUAGE) -> Model:
    """Model from rows (doc_id, text, lang); rows without text or language teach nothing."""
    small_batches(learn.sparkSession)
    rows = learn.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    there = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(there)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    some = _sampled(rows, {c: min(1.0, per_language / n) for c, n in there.items()}, "lang").select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                own = seen.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                for _, start, points in pieces(group["text"].tolist()):
                    ends = np.append(start[1:], len(points))
                    for order in ORDERS:
                        own += np.bincount(grams(points, ends, order), minlength=BUCKETS + 1)
        for lang, own in seen.items():
            at = np.flatnonzero(own[:BUCKETS])
            yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": own[at]})

    # at most buckets x languages rows come to the driver
    rows = (some.mapInPandas(released(count), "lang string, bucket int, n bigint").groupBy("lang", "bucket")
            .agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros((BUCKETS, len(languages)))
    counts[rows["bucket"].to_numpy(int), np.searchsorted(languages, rows["lang"].to_numpy(str))] = rows["n"]
    return Model(languages, counts, np.array([there[x] for x in languages], float))


def held_out(column: Column) -> Column:
    """Rows that are never learned from."""
    return F.crc32(column.cast("string").cast("binary")) % 5 == 0


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, one row per input row."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in sliced(whole)):
            names, scores = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()),
                                              pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(released(score), f"doc_id {kind}, lang_pred string, score double")


def learning_rows(docs: DataFrame) -> DataFrame:
    rows = pick(docs, doc_id="doc_id", text="text", lang="lang")
    return rows.where(~F.coalesce(held_out(F.col("doc_id")), F.lit(True)))


def query(docs: DataFrame) -> DataFrame:
    out = identify(docs, train(learning_rows(docs)))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all their columns, whose language is told with a score of ``least`` or more."""
    if not model.languages:
        return docs
    small_batches(docs.sparkSession)
    names = docs.columns
    at, shared = names.index("text"), docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    @released
    def sure(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in parts:
            _, scores = shared.value.predict([t if isinstance(t, str) else None for t in text])
            yield pd.Series(np.array(scores) >= least)

    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.where(sure(F.col(f"c{at}"))).toDF(*names)
