"""Data-quality profiles of a table, as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from panelmill.functions.columns import DATE_NAMES, find_column, to_instant, to_number
from panelmill.operators.ingest import union_all
from panelmill.operators.metrics import missing_ratio
from panelmill.operators.ranks import guarded_corr, rank_correlation
from panelmill.session import materialise

PROFILE_SCHEMA = (
    "name string, status string, rows bigint, columns int, date_col string, date_non_null bigint, "
    "date_min timestamp, date_max timestamp, duplicate_dates bigint, volume_zero_count bigint, "
    "volume_negative_count bigint, ohlc_non_positive_rows bigint, high_below_low_rows bigint"
)


def anomaly_counts(df: DataFrame) -> list:
    """Volume and OHLC fault counts; null for columns the table does not have."""
    found = {f: find_column(df, (f,)) for f in ("open", "high", "low", "close", "volume")}
    num = {f: to_number(F.col(c)) for f, c in found.items() if c}
    absent = F.lit(None).cast("bigint")
    v = num.get("volume")
    out = [
        (absent if v is None else F.count_if(v == 0)).alias("volume_zero_count"),
        (absent if v is None else F.count_if(v < 0)).alias("volume_negative_count"),
    ]
    prices = [num.get(f) for f in ("open", "high", "low", "close")]
    if any(p is None for p in prices):
        return out + [absent.alias("ohlc_non_positive_rows"), absent.alias("high_below_low_rows")]
    bad = [F.coalesce(p <= 0, F.lit(False)) for p in prices]
    return out + [
        F.count_if(bad[0] | bad[1] | bad[2] | bad[3]).alias("ohlc_non_positive_rows"),
        F.count_if(num["high"] < num["low"]).alias("high_below_low_rows"),
    ]


def ohlcv_anomalies(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*anomaly_counts(df))


def table_profile(df: DataFrame | None, name: str, spark=None) -> DataFrame:
    """One row of counts, date range and faults; ``None`` stands for a missing table."""
    if df is None:
        empty = spark.createDataFrame([(name, "missing_or_unsupported")], "name string, status string")
        return union_all(spark.createDataFrame([], PROFILE_SCHEMA), empty)
    date_col = find_column(df, DATE_NAMES)
    d = to_instant(df, date_col) if date_col else F.lit(None).cast("timestamp")
    faults = anomaly_counts(df)
    rows = df.agg(
        F.lit(name).alias("name"), F.lit("ok").alias("status"), F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"), F.lit(date_col).alias("date_col"),
        F.count(d).alias("date_non_null"), F.min(d).alias("date_min"), F.max(d).alias("date_max"),
        *faults,
    )
    # distinct dates are counted apart: beside the other aggregates they would multiply the scanned rows
    if date_col:
        dates = df.select(d.alias("d")).where("d is not null").distinct().agg(F.count(F.lit(1))).scalar()
        repeats = F.col("date_non_null") - dates
    else:
        repeats = F.lit(None).cast("bigint")
    return rows.withColumn("duplicate_dates", repeats).select(*[c.split()[0] for c in PROFILE_SCHEMA.split(", ")])


def is_ordered(df: DataFrame, seq: str, date: str) -> DataFrame:
    """``out_of_order``: rows whose date is before that of the previous row under ``seq``.

    The rows are range-partitioned on ``seq``; neighbours are compared inside each partition, and the
    edges of consecutive partitions in a table with one row per partition.
    """
    laid = materialise(
        df.select(F.col(seq).alias("s"), F.col(date).alias("d")).where("d is not null")
        .repartitionByRange("s").withColumn("part", F.spark_partition_id()),
        "ordered",
    )
    inside = Window.partitionBy("part").orderBy("s")
    within = laid.select((F.col("d") < F.lag("d").over(inside)).alias("bad"))
    edges = laid.groupBy("part").agg(F.min_by("d", "s").alias("head"), F.max_by("d", "s").alias("tail"))
    between = edges.select((F.col("head") < F.lag("tail").over(Window.orderBy("part"))).alias("bad"))
    return within.union(between).agg(F.count_if("bad").alias("out_of_order"))


def common_window(profiles: DataFrame) -> DataFrame:
    """Latest start and earliest end over the usable tables."""
    usable = profiles.where("status = 'ok' and date_min is not null and date_max is not null")
    span = usable.agg(F.max("date_min").alias("start"), F.min("date_max").alias("end"))
    status = (
        F.when(F.col("start").isNull(), "unavailable").when(F.col("start") > F.col("end"), "empty_intersection").otherwise("ok")
    )
    return span.select(status.alias("status"), "start", "end")


def return_outliers(df: DataFrame, keys: Sequence[str], k: float = 5.0, ret: str = "ret_1") -> DataFrame:
    """Rows whose return is more than ``k`` of its series' deviations away from zero."""
    deviation = F.stddev_samp(ret).over(Window.partitionBy(*keys))
    return df.withColumn("_dev", deviation).where(F.abs(F.col(ret)) > k * F.col("_dev")).drop("_dev")


def zero_exposure(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Series whose strategy never takes a position."""
    return curve.groupBy(*keys).agg(F.count_if(F.col("signal") != 0).alias("active_days")).where("active_days = 0")


def prediction_summary(predictions: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Rows and both correlations of a stored prediction table, over all its series together."""
    spearman = rank_correlation(predictions, [], pred, y).scalar()
    rows = predictions.agg(F.count(F.lit(1)).alias("predictions_rows"), guarded_corr(pred, y).alias("pearson"))
    return rows.withColumn("spearman", spearman)


def quality_report(tables: dict[str, DataFrame | None], spark) -> dict[str, DataFrame]:
    """Profiles, their common window and the five emptiest columns of each table."""
    profiles = union_all(*[table_profile(df, name, spark) for name, df in tables.items()])
    missing = union_all(*[
        missing_ratio(df, 5).select(F.lit(name).alias("name"), "column", "missing_ratio")
        for name, df in tables.items() if df is not None
    ])
    return {"profiles": profiles, "common_window": common_window(profiles), "missing": missing}


