"""Small whole-table upserts as numbered snapshot folders.

A table is never overwritten while it is read. Each version goes to a new ``v=N`` folder, and only
folders that carry Spark's ``_SUCCESS`` marker count, so a job that dies half way changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from panelmill.operators.ingest import upsert


def _versions(spark: SparkSession, path: str) -> list[int]:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("v=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name[2:]))
    return sorted(found)


def read_current(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/v={versions[-1]}")


def publish(df: DataFrame, path: str) -> int:
    versions = _versions(df.sparkSession, path)
    version = (versions[-1] if versions else 0) + 1
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    return version


def upsert_table(new: DataFrame, path: str, schema: StructType, keys: Sequence[str], recency: Sequence[str] = ()) -> int:
    """Merge ``new`` into the current version and publish the result; returns the version number."""
    current = read_current(new.sparkSession, path, schema)
    return publish(upsert(current, new, keys, recency), path)
