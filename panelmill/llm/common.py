"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.session import Stored

#: Characters that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str) -> Stored:
    """``df`` written to the folder in ``spark.checkpoint.dir``: read more than once, safe from lost executors."""
    return Stored(df, label)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), so that no other column of the input can clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


_remembered: list[Callable] = []


def remembered(size: int) -> Callable:
    """The last ``size`` results stay in a worker process from task to task, until it begins with work that does not use them."""

    def add(f: Callable) -> Callable:
        _remembered.append(lru_cache(maxsize=size)(f))
        return _remembered[-1]

    return add


def forget(using: Callable | None = None) -> None:
    """Gives up all that is remembered but the results of ``using``."""
    for f in _remembered:
        if f is not using:
            f.cache_clear()
    pa.default_memory_pool().release_unused()


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512, using: Callable | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time: texts and what is made of them take more room in Python than in Arrow, and a worker
    keeps the room it once took for all later stages. So what other stages remembered goes first, but for ``using``."""
    forget(using)
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
        pa.default_memory_pool().release_unused()


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def ranked(df: DataFrame, order: Sequence[str], label: str, weight: str | None = None) -> Stored:
    """``df`` stored with ``rank``, the place of a row in ``order`` (from 0), and ``before``, the weight of all earlier rows.

    Rows are dealt by ranges and counted where they are; only the totals of the ranges, a row for each partition, go
    through the driver. Without ``weight`` a row weighs 1. Reads ``df`` twice, so pass a stored table; end ``order`` with
    a column that tells equal rows apart if they may be many.
    """
    at = df.columns.index(weight) if weight else -1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, w = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            each = b.column(at).to_numpy(zero_copy_only=False).astype(np.int64) if weight else np.ones(b.num_rows, np.int64)
            run = np.cumsum(each)
            new = [pa.array(np.full(b.num_rows, part, np.int32)), pa.array(np.arange(n, n + b.num_rows)), pa.array(run - each + w)]
            n, w = n + b.num_rows, w + int(each.sum())
            yield pa.RecordBatch.from_arrays([*b.columns, *new], [*b.schema.names, "range_", "rank", "before"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    here = df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(count, f"{kinds}, range_ int, rank bigint, before bigint")
    local = store(here, label + "-local")
    value = F.sum(weight) if weight else F.count(F.lit(1))
    parts = local.df.groupBy("range_").agg(F.count(F.lit(1)).alias("n"), value.cast("long").alias("w")).orderBy("range_").collect()
    starts, n, w = [], 0, 0
    for p in parts:
        starts.append((p.range_, n, w))
        n, w = n + p.n, w + p.w
    offsets = df.sparkSession.createDataFrame(starts, "range_ int, n_ bigint, w_ bigint")  # one row a partition
    out = local.df.join(F.broadcast(offsets), "range_").select(
        *df.columns, (F.col("rank") + F.col("n_")).alias("rank"), (F.col("before") + F.col("w_")).alias("before"))
    done = store(out, label)
    local.delete()
    return done
