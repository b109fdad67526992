"""Streaming queries, run to completion over files that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill.queries.base import BARS, BARS_5M, query, six, with_
from panelmill.queries.ingest import LATE
from panelmill.queries.features import INTRADAY
from panelmill.session import scratch_path
from panelmill.sources import views as M
from panelmill.streaming import bars as S

CANDLE = "symbol string, interval string, ts timestamp, close double, volume double"


def _candles(df):
    return df.select(
        F.concat(F.lit("S"), F.col("series").cast("string")).alias("symbol"), F.lit("1d").alias("interval"),
        F.col("date").cast("timestamp").alias("ts"), "close", "volume",
    )


@query("stream_ingest", with_(BARS, LATE) + """select 'S' || series as symbol, date, close, volume from old
  union all select 'S' || l.series, l.date, l.close, l.volume from late l anti join old o on l.series = o.series and l.date = o.date""")
def stream_ingest(spark, folder):
    """History lands and is ingested; a late batch lands and the restarted stream adds its new keys."""
    land, path, checkpoint = (scratch_path(spark, n) for n in ("landing", "streamed", "checkpoint"))
    history = M.bars(spark, folder).where(F.col("date") < F.lit("2001-01-01").cast("date"))
    for batch in (history, M.late_batch(spark, folder)):
        _candles(batch).write.mode("append").parquet(land)
        stream = S.landing(spark, land, CANDLE)
        S.ingest(stream, path, checkpoint, ["volume"], ["interval", "year"]).awaitTermination()
    return spark.read.parquet(path).select("symbol", F.to_date("ts").alias("date"), "close", "volume")


@query("stream_dedup", with_(BARS_5M) + "select series, ts, close, volume from bars_5m")
def stream_dedup(spark, folder):
    """Five-minute bars that landed twice leave the stream once."""
    land, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "deduped", "checkpoint"))
    bars = M.bars_5m(spark, folder).select("series", F.col("ts").cast("timestamp").alias("ts"), "close", "volume")
    bars.unionByName(bars).write.parquet(land)
    stream = S.dedup(S.landing(spark, land, bars.schema), ["series", "ts"], lateness="100 days")
    S.append_files(stream, out, checkpoint).awaitTermination()
    return spark.read.schema(bars.schema).parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_daily_rollup", INTRADAY)
def stream_daily_rollup(spark, folder):
    """Days as the watermark closes them, then those still open at the end of the bounded run."""
    land, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "rollup", "checkpoint"))
    bars = M.bars_5m(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    bars.write.parquet(land)
    rollup = S.daily_rollup(S.landing(spark, land, bars.schema), M.KEYS)
    S.append_files(rollup, out, checkpoint).awaitTermination()
    closed = spark.read.schema(rollup.schema).parquet(out)
    return six(closed.unionByName(S.open_days(spark.read.parquet(land), closed, M.KEYS)))
