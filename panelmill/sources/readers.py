"""Table readers. Paths go to Spark as they are, so any file system it knows works."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from panelmill.functions.columns import DATE_NAMES, require_column, to_day
from panelmill.sources.schemas import CANDLES

PATH_NOT_FOUND = "PATH_NOT_FOUND"


def _suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return f".{name.rsplit('.', 1)[-1].lower()}" if "." in name else ""


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet or CSV/TXT by suffix; CSV without a schema reads strings (coerce with ``to_number``)."""
    suffix = _suffix(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        if suffix == ".parquet":
            return reader.parquet(path)
        if suffix in (".csv", ".txt"):
            return reader.csv(path, header=True)
    except AnalysisException as error:
        if error.getCondition() == PATH_NOT_FOUND:
            raise FileNotFoundError(f"there is nothing at {path}") from error
        raise
    raise ValueError(f"{path} ends in no known format")


def input_order(df: DataFrame) -> Column | None:
    """The place of a row in the files that ``df`` scans: file, part of the file, row. ``None`` if ``df`` is no scan of files.

    A part of a file is read by one task from its first row to its last, so a row's number in the task orders the rows of
    a part; parts are ordered by where they begin and files by their names.
    """
    try:
        df.select("_metadata.file_path", "_metadata.file_block_start").schema
    except AnalysisException:
        return None
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("row"))


def try_read(spark: SparkSession, path: str) -> DataFrame | None:
    """Like ``read_table`` but missing or unsupported input is ``None``."""
    try:
        return read_table(spark, path)
    except (FileNotFoundError, ValueError):
        return None


def read_if_exists(
    spark: SparkSession, path: str, schema: StructType, columns: Sequence[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Pruned and filtered scan; a missing table is an empty frame with the asked columns.

    The schema is given, not inferred: inference reads the partition folder ``interval=1d`` as the
    number 1.0.
    """
    try:
        df = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != PATH_NOT_FOUND:
            raise
        df = spark.createDataFrame([], schema)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def read_candles(
    spark: SparkSession, path: str, interval: str, symbols: Sequence[str] | None = None,
    schema: StructType = CANDLES, require_rows: bool = False,
) -> DataFrame:
    """One interval of the partitioned candle table as a panel; the filters prune partitions."""
    df = spark.read.schema(schema).parquet(path).where(F.col("interval") == interval)
    if symbols is not None:
        df = df.where(F.col("symbol").isin(list(symbols)))
    if require_rows and df.isEmpty():
        raise ValueError(f"No candles for interval={interval} symbols={symbols}")
    return df


def load_dataset(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Model-ready table with ``date`` as a day. No physical sort: order lives in the windows."""
    df = read_table(spark, path, schema)
    source = "date" if "date" in df.columns else require_column(df, DATE_NAMES, "date")
    return df.withColumn("date", to_day(df, source))
