"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK, _WRITING = threading.Lock(), []  # the setting before, and an entry for each write under way


def get_session(app: str = "panelmill", cpus: int | None = None) -> SparkSession:
    """A local session for tests and benches; on a cluster pass in the session spark-submit made."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a temporary one in local mode only."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="panelmill-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of queries run inside are deleted as each ends, not when the driver collects garbage."""
    with _LOCK:
        if not _WRITING:
            _WRITING.append(spark.conf.get(CLEANUP, "false"))
        _WRITING.append(None)
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            _WRITING.pop()
            if len(_WRITING) == 1:
                spark.conf.set(CLEANUP, _WRITING.pop())


class Stored:
    """A frame written as Parquet in the shared folder.

    Cuts lineage durably (it survives lost executors) and, unlike an RDD checkpoint, keeps column pruning
    and filter pushdown for whatever reads the table next. ``delete`` it once nothing lazy reads it.
    """

    written: list[Stored] = []

    def __init__(self, df: DataFrame, label: str) -> None:
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, label)
        with shuffles_dropped(self.spark):
            df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)
        Stored.written.append(self)

    def delete(self) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        if self in Stored.written:
            Stored.written.remove(self)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a stored table that lives until ``clear_scratch`` or the end of the job."""
    return Stored(df, label).df


def clear_scratch() -> None:
    """Delete every table this process stored; frames that still read them become unusable."""
    for stored in list(Stored.written):
        stored.delete()
