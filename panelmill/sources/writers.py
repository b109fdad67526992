"""Table, report and model writers."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelmill.sources.readers import _suffix

CANDLE_PARTITIONS = ("symbol", "interval", "year")


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def save_dataset(df: DataFrame, path: str) -> None:
    """Parquet or CSV by suffix."""
    suffix = _suffix(path)
    if suffix == ".parquet":
        df.write.mode("overwrite").parquet(path)
    elif suffix in (".csv", ".txt"):
        df.write.mode("overwrite").option("header", True).csv(path)
    else:
        raise ValueError(f"cannot write the format of {path}")


def with_symbol_bucket(df: DataFrame, buckets: int) -> DataFrame:
    """Partition column for panels with too many symbols to give each its own directory."""
    return df.withColumn("symbol_bucket", F.pmod(F.xxhash64("symbol"), F.lit(buckets)).cast("int"))


def by_partition(df: DataFrame, partitions: Sequence[str], sort: Sequence[str] = ()) -> DataFrame:
    """Cluster rows on the partition columns before a partitioned write.

    A rebalance keeps each task to few folders and, unlike a plain repartition, splits a partition value
    that holds a large share of the rows over several tasks.
    """
    inner = [c for c in sort if c in df.columns and c not in partitions]
    return df.hint("rebalance", *partitions).sortWithinPartitions(*partitions, *inner)


def append_partitions(
    df: DataFrame, path: str, partitions: Sequence[str] = CANDLE_PARTITIONS, sort: Sequence[str] = ("symbol", "ts"),
) -> None:
    """Append to Hive partitions."""
    by_partition(df, partitions, sort).write.mode("append").partitionBy(*partitions).parquet(path)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Overwrite only the partitions that ``df`` has rows for."""
    (
        by_partition(df, partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions).parquet(path)
    )


def save_tables(tables: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    """One directory per named report table."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer.option("header", True).csv(f"{folder}/{name}")
        else:
            writer.format(fmt).save(f"{folder}/{name}")


def save_json(spark: SparkSession, payload: Mapping, path: str) -> None:
    """A small configuration mapping as one JSON line, through Spark so that any file system works."""
    line = json.dumps(payload, ensure_ascii=False, default=str)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).head()[0])


def save_models(models: Mapping[str, MLWritable], folder: str) -> None:
    for name, model in models.items():
        model.write().overwrite().save(f"{folder}/{name}")
