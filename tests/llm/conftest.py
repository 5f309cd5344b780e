from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def docs_of(spark):
    """Documents from (doc_id, text[, lang, source]) rows."""
    def make(rows):
        full = [(i, t, *(more or ("en", "s")), len(t) if t is not None else None) for i, t, *more in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture()
def odd(docs_of):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash with the operators' own."""
    def make(spark_df=None):
        from pyspark.sql import functions as F
        rows = [(1, "The same words in a row for every one of them."), (1, "The same words in a row for every one of them."),
                (2, ""), (3, None), (None, "no id here, but words there are"), (None, None), (4, "a\n" * 3000),
                (5, "0123456789 " * 4000), (6, "x" * 200_000), (7, " \t\n \n"), (8, "é" * 50 + " ünï çødé 😀 words")]
        df = docs_of(rows)
        for name in ("k", "K", "k2", "h", "d", "n", "found", "pos", "seed", "size", "score", "TEXT", "Doc_Id", "part"):
            df = df.withColumns({name: F.lit("clash")}) if name.lower() not in ("text", "doc_id") else df
        names = [*df.columns, "TEXT", "Doc_Id"]
        return df.select("*", F.lit("clash"), F.lit(0)).toDF(*names)
    return make


@pytest.fixture(scope="session")
def llm_duck():
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return con
