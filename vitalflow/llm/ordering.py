"""Order inside groups of any size: range-partitioned rows, numbered, and hashed as one stream.

A group may hold a third of all rows, so no step here brings a group's rows into one task: rows
are range-partitioned by (group, order), which cuts a large group at its order, and only
per-partition summaries of a group meet again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

PIECE = 4096  # values joined into one piece


def placed(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows`` in the order of ``order``, with ``at``: a number that grows in that order, and ``part``,
    the range partition. Written, so both stay as they are when a task runs again."""
    at = F.monotonically_increasing_id()
    df = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("*", at.alias("at"))
    return staged(df, name).withColumn("part", F.shiftrightunsigned("at", 33))


def numbered(rows: DataFrame, key: str, order: list, weight: str, name: str) -> DataFrame:
    """``rows`` with ``pos``: the sum of ``weight`` over the earlier rows of the same (non-null) key."""
    df = placed(rows, [F.col(key), *order], name)
    inside = Window.partitionBy(key, "part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = df.groupBy(key, "part").agg(F.sum(weight).alias("total"))
    before = F.sum("total").over(Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(F.col(key).alias("o_key"), F.col("part").alias("o_part"), F.coalesce(before, F.lit(0)).alias("before"))
    run = df.withColumn("run", F.sum(weight).over(inside) - F.col(weight))
    out = run.join(parts, (F.col(key) == F.col("o_key")) & (F.col("part") == F.col("o_part")))
    return out.withColumn("pos", (F.col("before") + F.col("run")).cast("bigint")).drop("o_key", "o_part", "before", "run", "part", "at")


def _runs(batch: pa.RecordBatch, n_keys: int) -> Iterator[tuple[tuple, list]]:
    """Consecutive rows of ``batch`` with equal first ``n_keys`` columns: the key and the last column's values."""
    columns = [c.to_pylist() for c in batch.columns]
    keys = list(zip(*columns[:n_keys]))
    low = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[low]:
            yield keys[low], columns[-1][low:i]
            low = i


def ascending_sha256(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``keys`` and ``sha256``: of the group's values as text, ascending, comma-joined.

    Values become pieces of up to ``PIECE`` where they lie after a range partitioning, so a large group is
    a few rows when its pieces meet; these run through the hash one by one.
    """
    spark_keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keys).schema.fields)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, texts, found = [], [], []
            for key, values in _runs(batch, len(keys)):
                for i in range(0, len(values), PIECE):
                    found.append(key)
                    firsts.append(values[i])
                    texts.append(",".join(map(str, values[i:i + PIECE])))
            cols = [pa.array([k[i] for k in found], batch.column(i).type) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(firsts, batch.column(len(keys)).type), pa.array(texts, pa.string())],
                                             names=[*keys, "first", "piece"])

    def sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for key, pieces in _runs(batch, len(keys)):
                if key != now:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state, lead = key, hashlib.sha256(), ""
                for piece in pieces:
                    state.update((lead + piece).encode())
                    lead = ","
            yield _rows(done, batch)
            kind = batch
        if now is not None:
            yield _rows([(now, state.hexdigest())], kind)

    def _rows(done: list, like: pa.RecordBatch) -> pa.RecordBatch:
        cols = [pa.array([k[i] for k, _ in done], like.column(i).type) for i in range(len(keys))]
        return pa.RecordBatch.from_arrays([*cols, pa.array([h for _, h in done], pa.string())], names=[*keys, "sha256"])

    kind = rows.schema[value].dataType.simpleString()
    order = [*keys, value]
    pieces = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        join, f"{spark_keys}, first {kind}, piece string")
    pieces = staged(pieces, name)
    return pieces.repartition(*keys).sortWithinPartitions(*keys, "first").drop("first").mapInArrow(sha, f"{spark_keys}, sha256 string")
