"""Structured Streaming versions of candle ingest, key de-duplication and the daily rollup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from panelmill.functions.columns import nonzero
from panelmill.operators.ingest import ingest_candles
from panelmill.sources.writers import append_partitions


def landing(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int = 1000) -> DataFrame:
    """Files of a landing folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def ingest(
    stream: DataFrame, path: str, checkpoint: str, recency: Sequence[str],
    partitions: Sequence[str] = ("symbol", "interval", "year"), keys: Sequence[str] = ("symbol", "interval", "ts"),
) -> StreamingQuery:
    """Append rows with new keys to the candle table, one micro-batch at a time.

    A batch that is replayed after a failure finds its keys stored and adds nothing twice.
    """
    def store(batch: DataFrame, _: int) -> None:
        batch = batch.persist()  # read for the keys, the partitions and the rows
        append_partitions(ingest_candles(batch, path, recency, partitions, keys), path, partitions)
        batch.unpersist()

    return (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def dedup(stream: DataFrame, keys: Sequence[str], ts: str = "ts", lateness: str = "1 day") -> DataFrame:
    """First row per key; state is kept for ``lateness`` behind the newest event time."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(keys))


def daily_rollup(stream: DataFrame, keys: Sequence[str], ts: str = "ts", lateness: str = "1 hour") -> DataFrame:
    """Daily vwap, range and volatility of intraday bars, emitted once the watermark closes the day.

    A bar that comes twice counts once, so the closes kept per open day are at most one per slot: 288 for five-minute
    bars. Days that the watermark has not closed when a bounded run ends come from ``open_days``.
    """
    once = [*keys, ts]
    stream = stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(once) if stream.isStreaming else stream.dropDuplicates(once)
    ordered = F.array_sort(F.collect_list(F.struct(ts, "close")))
    daily = (
        stream.groupBy(*keys, F.window(ts, "1 day").alias("day"))
        .agg(
            F.sum(F.col("close") * F.col("volume")).alias("traded"), F.sum("volume").alias("volume"),
            (F.max("high") - F.min("low")).alias("intraday_range"), ordered.alias("bars"),
        )
    )
    closes = F.transform("bars", lambda b: b["close"])
    pairs = F.arrays_zip(F.slice(closes, 2, F.size(closes)).alias("now"), closes.alias("before"))
    returns = F.filter(
        F.transform(pairs, lambda p: F.try_divide(p["now"], nonzero(p["before"])) - 1), lambda r: r.isNotNull()
    )
    n = F.size("returns")
    mean = F.try_divide(F.aggregate("returns", F.lit(0.0), lambda a, r: a + r), n)
    spread = F.aggregate("returns", F.lit(0.0), lambda a, r: a + (r - F.col("mean")) * (r - F.col("mean")))
    vwap = F.try_divide(F.col("traded"), nonzero(F.col("volume")))
    return (
        daily.withColumn("returns", returns).withColumn("mean", mean)
        .select(
            *keys, F.to_date("day.start").alias("date"), vwap.alias("daily_vwap"), "intraday_range",
            F.when(n > 1, F.sqrt(F.try_divide(spread, n - 1))).alias("intraday_vol"),
            (F.try_divide(F.element_at(closes, -1), nonzero(vwap)) - 1).alias("close_vs_vwap"),
        )
    )


def open_days(landed: DataFrame, closed: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """The rollup of the days that the stream has not emitted, from the landed bars."""
    left = landed.withColumn("date", F.to_date(ts)).join(closed.select(*keys, "date"), [*keys, "date"], "left_anti")
    return daily_rollup(left.drop("date"), keys, ts)


def append_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once Parquet sink for a stream in append mode."""
    return (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
