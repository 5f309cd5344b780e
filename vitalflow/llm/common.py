"""Helpers shared by the text operators: column picking, written intermediate tables, spans."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, as ``new=old``; other columns may clash in name or in case."""
    at = {new: df.columns.index(old) for new, old in names.items()}
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{i}").alias(new) for new, i in at.items()])


BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH = 2 << 20   # bytes of rows that go to a Python worker at a time, about


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of about ``BATCH`` bytes, unless the session has a limit of its own.

    By Spark's default a batch is 10,000 rows or 64 MB. Every running task holds it in the executor's Arrow
    vectors and once more as bytes, both in buffers that grow by doubling outside the heap, and the worker holds it again.
    """
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH))


FILE_ROWS = 50_000   # rows of keys that are worth a file of their own


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """A frame that ends in a shuffle of at most ``rows`` rows of keys, its partitions dealt over no more tasks than so few rows are worth.

    A task takes its partitions one after another, so it needs no more memory. Otherwise every shuffle partition makes a file, which
    costs an executor three processes on a local disk (Hadoop runs chmod to set permissions) and some requests on any other.
    """
    return df.coalesce(min(1 + rows // FILE_ROWS, 1 << 30))


def staged(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing, and
    joins against it see a plain scan, whose skewed partitions Spark can split.

    ``rows``: see ``few_tasks``.
    """
    spark = df.sparkSession
    if rows is not None:
        df = few_tasks(df, rows)
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


STRETCH = 256   # matches whose spans are put into one array at a time


def spans(text: Column, pattern: str, hits: Column) -> Column:
    """Code-point spans of all matches of ``pattern``: array of struct(start, end, hit).

    ``hits`` is ``regexp_extract_all(text, pattern, 0)``. The texts between the matches come
    from a split by the same pattern, so the running sum of both lengths gives every start. An array
    that grows by one is copied each time, so the sum runs over stretches of ``STRETCH`` matches, and over
    the stretches' lengths: tens of thousands of matches in one text cost little more than a few.
    """
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
    steps = F.zip_with(gaps, hits, lambda g, h: F.struct(
        F.length(g).cast("bigint").alias("gap"), F.length(h).cast("bigint").alias("len"), h.alias("hit")))
    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>")
    zero = F.lit(0).cast("bigint")

    def walk(stretch: Column, at: Column) -> Column:
        return F.aggregate(
            stretch, F.struct(at.alias("at"), none.alias("out")),
            lambda a, x: F.struct(
                (a["at"] + x["gap"] + x["len"]).alias("at"),
                F.concat(a["out"], F.array(F.struct(
                    (a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + x["len"]).alias("end"),
                    x["hit"].alias("hit")))).alias("out")),
            lambda a: a["out"])

    def starts(stretches: Column) -> Column:
        lengths = F.transform(stretches, lambda s: F.aggregate(s, zero, lambda a, x: a + x["gap"] + x["len"]))
        return F.aggregate(
            lengths, F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out")),
            lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
            lambda a: a["out"])

    def cut(all_steps: Column) -> Column:
        last = F.floor((F.size(all_steps) - 1) / F.lit(STRETCH)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_steps, i * STRETCH + 1, F.lit(STRETCH)))

    # an array of one element binds its value, which would otherwise be computed wherever it is named
    bound = lambda value, of: F.get(F.transform(F.array(value), of), F.lit(0))
    long = bound(steps, lambda st: bound(cut(st), lambda ss: F.flatten(F.zip_with(ss, starts(ss), walk))))
    return F.when(F.size(hits) > STRETCH, long).when(F.size(hits) > 0, walk(steps, zero)).otherwise(none)


def find_all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def digest(spans_col: Column) -> Column:
    """``kind:start:end`` of struct(start, rank, kind, end) spans, by start, then rank, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans_col), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(found: str, kind: str) -> Column:
    """How many spans of a kind, as ``n_<kind>``."""
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
