"""Every stage on its own input against plain Python, and the whole run."""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import corpus_pipeline
from vitalflow.llm import hashing, language, mixing, ngram_join, token_output
from vitalflow.llm.common import BATCH, BATCH_CONF, read, small_batches, staged

from .conftest import SF
from .test_ngram_join import brute


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "token_output"]
    docs = read(spark, SF, "documents")
    bench = [re.findall(r"[^\W_]+", r["text"].lower()) for r in read(spark, SF, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = staged(stage(spark, docs, SF), f"test-{name}")
        after = [r["doc_id"] for r in out.collect()]
        if name == "language":
            model = language.train(language.learning_rows(docs))
            _, score = model.predict([t for _, t in before])
            assert sorted(after) == sorted(i for (i, _), s in zip(before, score) if s >= 0.5)
        elif name == "near_duplicates":
            found = brute(before, 5, 80)
            assert sorted(after) == sorted(i for i, (n, c) in found.items() if c == i or not n)
        elif name == "decontamination":
            def leaks(text):
                w = re.findall(r"[^\W_]+", (text or "").lower())
                grams = {tuple(w[i:i + 13]) for i in range(len(w))}
                return any(tuple(b[i:i + 13]) in grams for b in bench for i in range(max(1, len(b) - 12)))
            assert sorted(after) == sorted(i for i, t in before if not leaks(t))
        elif name == "mixing":
            sizes = {i: len((t or "").encode().split()) for i, t in before}
            words = sum(len((r["text"] or "").encode().split()) for r in out.collect())
            assert abs(words - sum(sizes.values())) <= 16 and set(after) <= set(sizes)
        else:
            assert sorted(after) == sorted(i for i, _ in before)
        if name != "token_output":
            assert out.columns == docs.columns
            docs = out
    total = out.agg({"n_tokens": "sum"}).first()[0]
    run = corpus_pipeline.run(spark, SF)
    assert run.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert (run.count(), run.agg({"n_tokens": "sum"}).first()[0]) == (len(after), total)


KEPT = {"language": None, "near_duplicates": 10, "decontamination": 11, "mixing": None, "token_output": 11}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows_and_empty_tables(spark, odd, name, stage):
    """Nulls, empty and long texts, a repeated row, columns whose names clash; and no rows at all."""
    docs = odd()
    out = stage(spark, docs, SF)
    rows = out.count()
    if KEPT[name] is not None:
        assert rows == KEPT[name]       # the repeated row is the only near duplicate
    if name != "token_output":
        assert out.columns == docs.columns
    none = stage(spark, docs.limit(0), SF)
    assert none.count() == 0 and none.columns == out.columns


def test_texts_reach_workers_in_small_batches(spark):
    """Every stage that hands texts to Python workers limits a batch by its bytes; a session's own limit stays."""
    docs, rows = read(spark, SF, "documents"), lambda d: d.select("text").mapInArrow(_bytes, "n bigint")
    long = spark.range(0, 9000, 1, 1).select(F.repeat(F.lit("word "), 400).alias("text"))
    for stage in (corpus_pipeline.identify_language, corpus_pipeline.drop_near_duplicates, corpus_pipeline.mix_sources, corpus_pipeline.write_tokens):
        spark.conf.unset(BATCH_CONF)
        stage(spark, docs, SF)
        got = [r["n"] for r in rows(long).collect()]
        assert len(got) > 1 and max(got) <= 1.1 * BATCH
    spark.conf.set(BATCH_CONF, "5m")
    small_batches(spark)
    assert spark.conf.get(BATCH_CONF) == "5m"
    spark.conf.unset(BATCH_CONF)


def _bytes(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])


def test_the_mix_plan_needs_no_python_workers(spark):
    """Source sums become a table on the driver: rows from a list would start workers of another kind on each executor."""
    sizes = spark.createDataFrame([(None, 10), ("b", 1 << 40), ("a", 0)], "source string, source_size bigint")
    plan = mixing.plan_sources(sizes)
    assert "ExistingRDD" not in plan._jdf.queryExecution().toString()
    assert [(r["source"], r["source_size"]) for r in plan.collect()] == [("a", 0), ("b", 1 << 40), (None, 10)]
    assert mixing.plan_sources(sizes.limit(0)).count() == 0


def test_tasks_drop_what_other_operators_keep_in_a_worker():
    """The tokenizer's memory goes also if the task's code is a copy, as in a worker."""
    for keeps, left in (("words", 1), (None, 0)):
        token_output._WORDS["x"] = None
        task = cloudpickle.loads(cloudpickle.dumps(hashing.released(lambda batches: batches, keeps)))
        assert list(task([1, 2])) == [1, 2] and len(token_output._WORDS) == left
    token_output._WORDS["x"] = None
    ngram_join._connect(5, 80)(pd.DataFrame({"home": [1], "i": [0], "j": [0], "guest": [False], "d": [7], "text": ["a b"]}))
    assert not token_output._WORDS
