"""The training-text pipeline: language, near duplicates, benchmark passages, mixing, token output.

Each stage takes the documents that the one before kept. ``run`` writes every stage's result to the
shared checkpoint folder and reads it back.

Defined cases, for every stage: an empty table gives an empty result with the stage's columns; further
columns are carried along, also if their names differ from the documents' own by case alone or repeat
``k``, ``n`` and the like; rows are taken by their text and ids, so a null id or a repeated row is a
document like any other; no text is cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitalflow.llm import decontaminate, language, mixing, ngram_join, token_output
from vitalflow.llm.common import read, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a score of 0.5 or more; the rest go.

    Null texts and texts without a letter have no language and go. Ties between languages do not matter.
    Where no row has both text and language outside the held-out fold, nothing is learned and every document stays.
    """
    return language.keep_identified(docs, language.train(language.learning_rows(docs)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links by five-word shingles at a similarity of 0.8.

    The smallest doc_id stays, of equal ids one row, and a null id last. Documents without words link with nothing and all stay.
    """
    return ngram_join.keep_one(docs, words=5, percent=80)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none and stay; items without text mark nothing."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: repeated, whole, cut or left out.

    A null source is a source of its own, the last one. Documents without words have nothing to take and go.
    """
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token blocks of the mix, read back: a row per document with its place in the token stream.

    A null text yields the end id alone; null ids come first, and rows that share an id are ordered by a hash of their texts.
    """
    return token_output.query(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

ORACLE_SQL = None  # learned, hashed and coded stages: tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
