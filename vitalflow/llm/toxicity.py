"""Toxicity: a convolutional text classifier trained in numpy.

Words are hashed twice into one table of embeddings (a word's vector is the sum of both, so two
words rarely share it); filters of widths 1, 2 and 3 slide over the text, each is pooled by its
maximum, and a logistic layer reads the pooled values. The first embedding coordinate starts from
each bucket's smoothed log-odds in the learning texts. Thresholds are calibrated by language: a
small word model names a text's language from the text alone, and the threshold of that language
becomes score 0.5.

For scoring, embedding times filter is one table for each filter column, so a convolution is a sum
of table rows. Every text is scored whole, in pieces that overlap by two words.

All labelled rows outside the held-out fold are learned from, in Spark: the counts are sums over their
partitions; in each round every partition learns from all its rows, from the same net on, and the nets are
averaged place by place over the partitions that moved it; a fifth of the rows is set apart and all its raw scores,
counted in steps of 1 / ``STEPS``, give the thresholds. Only counts and averages come to the driver.

Defined cases: a null or empty text is scored like one pad word; with no learning rows of either
label every score is 0; repeated rows get equal scores; unlabelled rows teach nothing.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, staged
from .hashing import NON_WORD, released, sliced, word_hashes
from .language import held_out
from .ngram_join import _checked

BITS = 18
BUCKETS = 1 << BITS
LANGUAGE_BUCKETS = 1 << 16
SIZE, FILTERS, WIDTHS = 4, 6, (1, 2, 3)
LEARNER_ROWS = 20_000         # learning rows of a partition, about
STEPS = 1024                 # in which raw scores are counted for the thresholds, to a unit
EPOCHS, BATCH, RATE = 4, 64, 0.05
LEAST_TO_CALIBRATE = 12      # rows of either label that a language needs for its own threshold
PIECE = 100_000              # words scored at once


def words_of(texts: list[str | None]) -> list[np.ndarray]:
    return word_hashes([(t or "").lower().encode("utf-8", "surrogatepass") for t in texts], NON_WORD)


def buckets(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ((hashes & np.uint64(BUCKETS - 1)).astype(np.int32), ((hashes >> np.uint64(32)) & np.uint64(BUCKETS - 1)).astype(np.int32))


def _language_buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(LANGUAGE_BUCKETS - 1)).astype(np.int32)


@dataclass
class Net:
    table: np.ndarray            # (BUCKETS + 1, SIZE); the last row is the pad word and stays zero
    filters: list[np.ndarray]    # one (width, SIZE, FILTERS) per width
    bias: np.ndarray             # (widths, FILTERS)
    out: np.ndarray              # (widths * FILTERS)
    level: float

    def columns(self) -> list[list[np.ndarray]]:
        return [[self.table @ f[j] for j in range(len(f))] for f in self.filters]


def _padded(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both bucket rows of all texts, each followed by as many pad words as the widest filter needs."""
    pad = np.full(WIDTHS[-1] - 1 or 1, BUCKETS, np.int32)
    a, b, start, at = [], [], [], 0
    for h in texts:
        one, two = buckets(h)
        start.append(at)
        a += [one, pad]
        b += [two, pad]
        at += len(one) + len(pad)
    return np.concatenate(a), np.concatenate(b), np.array(start)


def _slide(columns: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One width's filter values at every word. The windows that run over a text's end only add pads."""
    z = columns[0][a] + columns[0][b]
    for j in range(1, len(columns)):
        z[:-j] += columns[j][a[j:]] + columns[j][b[j:]]
    return z


def _pooled(columns: list[list[np.ndarray]], texts: list[np.ndarray]) -> np.ndarray:
    """Maximum of every filter over every text: (texts, widths * FILTERS)."""
    a, b, start = _padded(texts)
    return np.hstack([np.maximum.reduceat(_slide(c, a, b), start, axis=0) for c in columns])


def _seen(texts: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """In how many texts of either label a bucket occurs."""
    seen = np.zeros((2, BUCKETS + 1))
    for h, y in zip(texts, label):
        seen[int(y), np.unique(np.concatenate(buckets(h)))] += 1
    return seen


def _open_net(seen: np.ndarray, n: np.ndarray) -> Net:
    """The net before learning, from ``_seen`` and the numbers of rows of label 0 and 1."""
    rng = np.random.default_rng(7)
    odds = np.log((seen[1] + 1) / (n[1] + 2)) - np.log((seen[0] + 1) / (n[0] + 2))
    odds[seen.sum(0) == 0] = 0
    table = rng.normal(0, 0.01, (BUCKETS + 1, SIZE))
    table[:, 0] = odds / 2
    table[BUCKETS] = 0
    filters = [rng.normal(0, 0.05, (w, SIZE, FILTERS)) for w in WIDTHS]
    for f in filters:
        f[:, 0, :] += rng.uniform(0.5, 1, (1, FILTERS)) / len(f) ** 0.5
    k = len(WIDTHS) * FILTERS
    return Net(table, filters, np.zeros((len(WIDTHS), FILTERS)), np.full(k, 1.0 / k), -2.0)


class Learner:
    """A net that learns: logistic loss, Adagrad; through the pooling only the window of the maximum gets a gradient."""

    def __init__(self, net: Net, n: np.ndarray):
        """``n``: rows of label 0 and 1 in all that is learned from; both labels weigh the same."""
        self.net, self.weights = net, 0.5 / np.maximum(1, n) * n.sum()
        self.sums = {"filters": [np.full_like(f, 1e-2) for f in net.filters], "bias": np.full_like(net.bias, 1e-2),
                     "out": np.full_like(net.out, 1e-2), "level": 1e-2}
        self.table_sum = np.full(BUCKETS + 1, 1e-2)

    def _small(self) -> tuple[np.ndarray, np.ndarray]:
        """All parameters beside the table, and their sums of squares, as two vectors."""
        flat = lambda filters, bias, out, level: np.concatenate([*map(np.ravel, filters), bias.ravel(), out, [level]])
        net = self.net
        return flat(net.filters, net.bias, net.out, net.level), flat(*self.sums.values())

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Every place of the net with its values and sum of squares: (places, SIZE + 1). The table's come first."""
        values, sums = self._small()
        rest = np.zeros((len(values), SIZE + 1))
        rest[:, 0], rest[:, SIZE] = values, sums
        return np.vstack([np.column_stack([self.net.table, self.table_sum]), rest])

    def put(self, place: np.ndarray, rows: np.ndarray) -> None:
        """Set places to other values, as ``places`` gives them."""
        every = self.places()
        every[place] = rows
        net = self.net
        net.table, self.table_sum = every[:BUCKETS + 1, :SIZE].copy(), every[:BUCKETS + 1, SIZE].copy()

        def unpack(flat: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, float]:
            ends = np.cumsum([*[f.size for f in net.filters], net.bias.size, net.out.size])
            *filters, bias, out, level = np.split(flat, ends)
            return [x.reshape(f.shape) for x, f in zip(filters, net.filters)], bias.reshape(net.bias.shape), out, float(level[0])

        net.filters, net.bias, net.out, net.level = unpack(every[BUCKETS + 1:, 0].copy())
        self.sums = dict(zip(self.sums, unpack(every[BUCKETS + 1:, SIZE].copy())))

    def learn(self, texts: list[np.ndarray], label: np.ndarray, rng: np.random.Generator) -> None:
        """One pass over rows in a random order."""
        net, sums, table_sum = self.net, self.sums, self.table_sum
        weight = self.weights[label.astype(int)]
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            pick_ = order[at:at + BATCH]
            a, b, start = _padded([texts[i] for i in pick_])
            ends = np.append(start[1:], len(a))
            used, where = np.unique(np.concatenate([a, b]), return_inverse=True)
            la, lb = where[: len(a)], where[len(a):]
            local = net.table[used]
            pooled, best = [], []
            for f in net.filters:
                z = _slide([local @ f[j] for j in range(len(f))], la, lb)
                top = np.stack([s + z[s:e].argmax(0) for s, e in zip(start, ends)])
                best.append(top)
                pooled.append(np.take_along_axis(z, top, 0))
            raw = np.hstack(pooled) + net.bias.reshape(-1)
            act = np.maximum(raw, 0)
            p = 1 / (1 + np.exp(-np.clip(act @ net.out + net.level, -30, 30)))
            g = (p - label[pick_]) * weight[pick_] / len(pick_)
            d_raw = g[:, None] * net.out[None, :] * (raw > 0)
            d_out, d_level = act.T @ g + 1e-4 * net.out, g.sum()
            d_local = np.zeros_like(local)
            for w, (f, top) in enumerate(zip(net.filters, best)):
                d = d_raw[:, w * FILTERS:(w + 1) * FILTERS]
                d_f = np.zeros_like(f)
                for j in range(len(f)):
                    pos = np.minimum(top + j, len(la) - 1)
                    inside = (top + j < ends[:, None]) & (d != 0)
                    for rows in (la[pos], lb[pos]):
                        d_f[j] += np.einsum("nf,nfs->sf", d * inside, local[rows])
                        np.add.at(d_local, rows[inside], d[inside][:, None] * f[j].T[np.nonzero(inside)[1]])
                sums["filters"][w] += d_f ** 2
                net.filters[w] = f - RATE * d_f / np.sqrt(sums["filters"][w])
            d_bias = d_raw.sum(0).reshape(net.bias.shape)
            sums["bias"] += d_bias ** 2
            sums["out"] += d_out ** 2
            sums["level"] += d_level ** 2
            net.bias -= RATE * d_bias / np.sqrt(sums["bias"])
            net.out -= RATE * d_out / np.sqrt(sums["out"])
            net.level -= RATE * d_level / np.sqrt(sums["level"])
            hit = np.abs(d_local).sum(1) > 0
            hit[used == BUCKETS] = False
            table_sum[used[hit]] += (d_local[hit] ** 2).sum(1)
            net.table[used[hit]] -= RATE * d_local[hit] / np.sqrt(table_sum[used[hit]])[:, None]


def fit(texts: list[np.ndarray], label: np.ndarray) -> Net:
    """A net from rows at hand."""
    n = np.bincount(label.astype(int), minlength=2)
    learner, rng = Learner(_open_net(_seen(texts, label), np.maximum(1, n)), n), np.random.default_rng(11)
    for _ in range(EPOCHS):
        learner.learn(texts, label, rng)
    return learner.net


class Model:
    """Net, language model and thresholds, ready to score. Made from rows at hand; ``train`` learns from tables."""

    def __init__(self, texts: list[np.ndarray], label: np.ndarray, lang: list[str | None], prior: np.ndarray):
        """``prior``: rows of label 0 and 1 that the sample stands for."""
        self.net = None
        if not len(label) or len(set(label.tolist())) < 2:
            return
        self._fit_languages(texts, lang)
        apart = np.arange(len(label)) % 5 == 0
        if len(set(label[~apart].tolist())) < 2 or len(set(label[apart].tolist())) < 2:
            apart[:] = False
        net = fit([t for t, x in zip(texts, apart) if not x], label[~apart])
        self._set(net)
        check = np.flatnonzero(apart) if apart.any() else np.arange(len(label))
        raw, named = self._raw([texts[i] for i in check]), self._languages([texts[i] for i in check])
        share = np.where(label[check] == 1, prior[1] / max(1, (label == 1).sum()), prior[0] / max(1, (label == 0).sum()))
        self._set_thresholds(raw, label[check], named, np.ones(len(check)), share)

    def _set(self, net: Net) -> None:
        self.net = Net(net.table.astype(np.float32), [f.astype(np.float32) for f in net.filters], net.bias, net.out, net.level)
        self._columns = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_columns": None}  # made anew by each worker, smaller to send

    def _fit_languages(self, texts: list[np.ndarray], lang: list[str | None]) -> None:
        names = sorted({x for x in lang if x is not None})
        counts = np.zeros((LANGUAGE_BUCKETS, len(names)))
        for h, x in zip(texts, lang):
            if x is not None:
                counts[:, names.index(x)] += np.bincount(_language_buckets(h), minlength=LANGUAGE_BUCKETS)
        self._set_languages(names, counts)

    def _set_languages(self, names: list[str], counts: np.ndarray) -> None:
        self.names = names
        self.words = np.log((counts + 0.1) / (counts + 0.1).sum(0)).astype(np.float32)

    def _set_thresholds(self, raw: np.ndarray, label: np.ndarray, named: np.ndarray, rows: np.ndarray, share: np.ndarray) -> None:
        """From raw scores by label and language; ``rows``: how many rows each is, ``share``: how many it stands for."""
        everywhere = threshold(raw, label, share)
        self.thresholds = np.full(max(1, len(self.names)), everywhere)
        for n in range(len(self.names)):
            own = named == n
            if min(rows[own & (label == 1)].sum(), rows[own & (label == 0)].sum()) >= LEAST_TO_CALIBRATE:
                self.thresholds[n] = threshold(raw[own], label[own], share[own])

    def _languages(self, texts: list[np.ndarray]) -> np.ndarray:
        if not self.names:
            return np.zeros(len(texts), int)
        return np.array([self.words[_language_buckets(h)].sum(0).argmax() for h in texts])

    def _raw(self, texts: list[np.ndarray]) -> np.ndarray:
        if self._columns is None:
            self._columns = [[c.astype(np.float32) for c in cs] for cs in self.net.columns()]
        top = np.full((len(texts), len(self.net.out)), -np.inf)
        who, parts, size = [], [], 0

        def flush() -> None:
            if who:
                np.maximum.at(top, who, _pooled(self._columns, parts))

        for n, h in enumerate(texts):
            for low in range(0, max(1, len(h)), PIECE):
                part = h[low:low + PIECE + WIDTHS[-1] - 1]
                if size + len(part) > PIECE and who:
                    flush()
                    who, parts, size = [], [], 0
                who.append(n)
                parts.append(part)
                size += len(part)
        flush()
        return np.maximum(top + self.net.bias.reshape(-1), 0) @ self.net.out + self.net.level

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.net is None or not texts:
            return np.zeros(len(texts))
        hashed = words_of(texts)
        z = self._raw(hashed) - self.thresholds[self._languages(hashed)]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def threshold(raw: np.ndarray, label: np.ndarray, share: np.ndarray) -> float:
    """The cut with the best F1, rows weighted by what they stand for, midway between two scores."""
    order = np.argsort(-raw, kind="stable")
    hit = np.cumsum((label * share)[order])
    f1 = 2 * hit / (np.cumsum(share[order]) + (label * share).sum())
    f1[:-1][raw[order][:-1] == raw[order][1:]] = -1  # no cut between equal scores
    at = int(f1.argmax())
    return float((raw[order][at] + raw[order][min(at + 1, len(raw) - 1)]) / 2)


def _counted(languages: list[str]):
    """(label or 2 + language, bucket, n): texts by bucket and label, words by bucket and language, of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, words = np.zeros((2, BUCKETS + 1)), np.zeros((len(languages), LANGUAGE_BUCKETS))
        at = {x: i for i, x in enumerate(languages)}
        for batch in (part for whole in batches for part in sliced(whole)):
            texts, label = words_of(batch.column("text").to_pylist()), batch.column("toxic").to_numpy()
            learns = batch.column("learns").to_numpy(zero_copy_only=False)
            seen += _seen([t for t, x in zip(texts, learns) if x], label[learns])
            for h, x in zip(texts, batch.column("lang").to_pylist()):
                if x is not None:
                    words[at[x]] += np.bincount(_language_buckets(h), minlength=LANGUAGE_BUCKETS)
        for kind, counts in enumerate([*seen, *words]):
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), kind, np.int32)), pa.array(used.astype(np.int32)),
                                              pa.array(counts[used].astype(np.int64))], ["kind", "bucket", "n"])

    return released(run)


def _round(shared, number: int):
    """One pass of a partition over its rows; the places of the net that it moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, rng = copy.deepcopy(shared.value), np.random.default_rng([11, number])
        start = learner.places()
        for batch in (part for whole in batches for part in sliced(whole)):
            learner.learn(words_of(batch.column("text").to_pylist()), batch.column("toxic").to_numpy(), rng)
        now = learner.places()
        moved = np.flatnonzero((now != start).any(1))
        yield pa.RecordBatch.from_arrays([pa.array(moved.astype(np.int32)), *[pa.array(now[moved, c]) for c in range(SIZE + 1)]],
                                         ["place", *VALUES])

    return released(run)


def _raw_counts(shared):
    """(named, toxic, step, n): the raw scores of a partition's rows by the language that the model names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in sliced(whole)):
            texts = words_of(batch.column("text").to_pylist())
            step = np.rint(np.clip(shared.value._raw(texts), -60, 60) * STEPS).astype(np.int64)
            every = np.column_stack([shared.value._languages(texts), batch.column("toxic").to_numpy(), step]).astype(np.int64)
            each, n = np.unique(every, axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([*[pa.array(each[:, c]) for c in range(3)], pa.array(n.astype(np.int64))],
                                             ["named", "toxic", "step", "n"])

    return released(run)


VALUES = [f"v{i}" for i in range(SIZE + 1)]


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from all labelled rows outside the held-out fold; see the module's text."""
    marked = pick(labels, doc_id="doc_id", toxic="toxic").where(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    marked = staged(marked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "toxic-labels")
    learners = -(-marked.count() // LEARNER_ROWS) or 1
    rows = pick(docs, doc_id="doc_id", text="text", lang="lang").join(_checked(marked), "doc_id")
    rows = rows.repartition(learners, "doc_id").dropDuplicates(["doc_id"])
    rows = staged(rows.withColumn("apart", F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(5)) == 0), "toxic-learning")
    kinds = rows.groupBy("apart", "toxic", "lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per language and kind
    n = np.zeros((2, 2), int)
    for r in kinds:
        n[int(r["apart"]), r["toxic"]] += r["n"]
    model = Model([], np.zeros(0), [], np.zeros(2))
    if not n.sum(0).all():
        return model
    split = bool(n.all())   # else too few rows: all are learned from and calibrated on
    languages = sorted({r["lang"] for r in kinds if r["lang"] is not None})
    learn, check = (rows.where(~F.col("apart")), rows.where("apart")) if split else (rows, rows)
    n = n[0] if split else n.sum(0)

    learns = ~F.col("apart") if split else F.lit(True)
    counts = rows.select("text", "lang", "toxic", learns.alias("learns")).mapInArrow(_counted(languages), "kind int, bucket int, n bigint")
    got = counts.groupBy("kind", "bucket").agg(F.sum("n").alias("n")).toArrow()  # at most a row per bucket and label or language
    kind, bucket, number = (got[c].to_numpy() for c in ("kind", "bucket", "n"))
    seen, words = np.zeros((2, BUCKETS + 1)), np.zeros((LANGUAGE_BUCKETS, len(languages)))
    seen[kind[kind < 2], bucket[kind < 2]] = number[kind < 2]
    words[bucket[kind >= 2], kind[kind >= 2] - 2] = number[kind >= 2]
    model._set_languages(languages, words)

    learner, context = Learner(_open_net(seen, n), n), docs.sparkSession.sparkContext
    for r in range(EPOCHS):
        shared = context.broadcast(learner)
        moved = learn.select("text", "toxic").mapInArrow(_round(shared, r), f"place int, {', '.join(f'{v} double' for v in VALUES)}")
        got = moved.groupBy("place").agg(*[F.avg(v).alias(v) for v in VALUES]).toArrow()  # at most a row per place
        learner.put(got["place"].to_numpy(), np.column_stack([got[v].to_numpy() for v in VALUES]))
        shared.unpersist()
    model._set(learner.net)

    shared = context.broadcast(model)
    counts = check.select("text", "toxic").mapInArrow(_raw_counts(shared), "named bigint, toxic bigint, step bigint, n bigint")
    got = counts.groupBy("named", "toxic", "step").agg(F.sum("n").alias("n")).orderBy("named", "toxic", "step").toArrow()
    n = got["n"].to_numpy().astype(float)
    model._set_thresholds(got["step"].to_numpy() / STEPS, got["toxic"].to_numpy().astype(float), got["named"].to_numpy(), n, n)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, one row per input row; only the text is read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(shared.value.score(batch.column("text").to_pylist()), pa.float64())],
                ["doc_id", "score"])

    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = score(docs, train(docs, labels))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
