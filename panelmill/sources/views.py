"""Bar-shaped views of a star schema (lineitem, orders, events, supplier, nation).

The registered queries read these tables; a user with real candles starts from ``readers`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelmill.functions.columns import quantise

# A total order of the trades of a day: (l_orderkey, l_linenumber) alone is not unique.
TRADE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
KEYS = ["series"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed(*parts: tuple[Column, int]) -> Column:
    """Whole numbers of so many digits each, in this order, as one decimal that sorts as they do. A struct would make every
    aggregate around it sort its rows. The digits may add up to 38; a number that needs more raises."""
    out = None
    for value, digits in parts:
        value = value.cast(f"decimal({digits},0)")
        out = value if out is None else out * F.lit(str(10**digits)).cast(f"decimal({digits + 1},0)") + value
    return out.cast("decimal(38,0)")


def trade_order() -> Column:
    cents = F.round(F.col("l_extendedprice") * 100)
    return packed((F.col("l_orderkey"), 12), (F.col("l_linenumber"), 2), (F.col("l_partkey"), 10), (cents, 10), (F.col("l_quantity"), 4))


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily OHLCV per supplier. First and last trade are ordered aggregates, so a day with any number
    of trades is combined on the map side, by hash: the order is one number of fixed width."""
    trades = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("series"), F.to_date("l_shipdate").alias("date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("px"), *TRADE_ORDER,
    )
    order = trade_order()
    return trades.groupBy("series", "date").agg(
        quantise(F.min_by("px", order), 4).alias("open"), quantise(F.max("px"), 4).alias("high"),
        quantise(F.min("px"), 4).alias("low"), quantise(F.max_by("px", order), 4).alias("close"),
        F.sum("l_quantity").alias("volume"),
    )


def context(spark: SparkSession, folder: str, urgent_only: bool = False) -> DataFrame:
    """Average order value per day, dense or (urgent orders only) with gaps."""
    orders = table(spark, folder, "orders")
    if urgent_only:
        orders = orders.where(F.col("o_orderpriority") == "1-URGENT")
    cents = F.sum(F.floor(F.col("o_totalprice") * 100 + 0.5)).cast("double")
    return orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        quantise(cents / 100 / F.count(F.lit(1)), 4).alias("close")
    )


def keyed_context(spark: SparkSession, folder: str) -> DataFrame:
    """Returned quantity per supplier and day: a sparse context that differs by series."""
    returned = table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    return returned.groupBy(F.col("l_suppkey").alias("series"), F.to_date("l_shipdate").alias("date")).agg(
        F.sum("l_quantity").alias("returned_qty"),
        F.max(F.when(F.col("l_linenumber") > 2, F.col("l_quantity"))).alias("late_line_qty"),
    )


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    days = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return days.withColumn("is_trading_day", F.weekday("date") < 5)


def dividends(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_suppkey").alias("series"), F.col("l_shipdate").alias("record_date"),
        F.col("l_discount").alias("dividend_net"),
    )


def bars_5m(spark: SparkSession, folder: str) -> DataFrame:
    """Five-minute bars per event type."""
    ev = table(spark, folder, "events")
    slot = F.timestamp_seconds(F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 300) * 300)
    order = packed((F.unix_micros(F.col("ts").cast("timestamp")), 18), (F.col("event_id"), 19))
    return ev.groupBy(F.col("event_type").alias("series"), slot.cast("timestamp_ntz").alias("slot")).agg(
        F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"),
        F.max_by("value", order).alias("close"), F.count(F.lit(1)).cast("double").alias("volume"),
    ).withColumnRenamed("slot", "ts")


def instruments(spark: SparkSession, folder: str) -> DataFrame:
    """One instrument per supplier, listed on the exchange of its nation."""
    s, n = table(spark, folder, "supplier"), table(spark, folder, "nation")
    key = F.col("s_suppkey")
    id_text = key.cast("string")
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        key.alias("series"), F.concat(F.lit("S"), id_text).alias("symbol"), F.upper("s_name").alias("ticker"),
        F.concat(F.lit("uid-"), id_text).alias("instrument_id"), F.concat(F.lit("figi-"), id_text).alias("figi"),
        F.concat(F.lit("C"), (key % 4).cast("string")).alias("class_code"), F.col("n_name").alias("exchange"),
        F.concat(F.lit("CUR"), F.col("n_regionkey").cast("string")).alias("currency"),
        F.lit(1).alias("lot"), F.col("s_name").alias("name"),
        F.when(key % 3 == 0, F.lit(None)).when(key % 3 == 1, F.lit("1980-01-01")).otherwise(F.lit("1996-05-01"))
        .cast("timestamp").alias("first_1day_candle_date"),
        F.when(key % 2 == 0, F.lit("2001-06-01")).cast("timestamp").alias("first_1min_candle_date"),
    )


def late_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A landing batch: new days, plus days of an earlier year sent again with a changed volume."""
    b = bars(spark, folder)
    fresh = b.where(F.col("date") >= F.lit("2001-01-01").cast("date"))
    again = b.where(F.year("date") == 2000).withColumn("volume", F.col("volume") + 1)
    return fresh.unionByName(again)


def dirty_bars(spark: SparkSession, folder: str, made: DataFrame | None = None) -> DataFrame:
    """Bars (``made``, if they are stored already) as text with the usual faults, each row sent twice; ``seq`` says which copy
    came later."""
    b = bars(spark, folder) if made is None else made
    d = F.dayofmonth("date")
    first = b.select(
        "series", F.lit(1).alias("seq"), F.col("date").cast("string").alias("Date"),
        F.col("open").cast("string").alias("Open"), F.col("high").cast("string").alias("High"),
        F.col("low").cast("string").alias("LOW"), F.col("close").cast("string").alias("Close"),
        F.col("volume").cast("string").alias("Volume"),
    )
    second = b.select(
        "series", F.lit(2).alias("seq"),
        F.when(d == 31, F.lit("not a date")).otherwise(F.col("date").cast("string")).alias("Date"),
        F.when(d == 1, F.lit("inf")).otherwise(F.col("open").cast("string")).alias("Open"),
        F.when(d == 2, F.col("low") - 1).otherwise(F.col("high")).cast("string").alias("High"),
        F.when(d == 3, F.lit("n/a")).otherwise(F.col("low").cast("string")).alias("LOW"),
        F.when(d == 4, F.lit("-1.0")).otherwise(F.col("close").cast("string")).alias("Close"),
        F.when(d == 5, F.lit("0")).when(d == 6, F.lit("-3")).otherwise((F.col("volume") + 1).cast("string")).alias("Volume"),
    )
    return first.unionByName(second)


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Model-free predictions: five-day momentum for the next log return, with an interval around it.

    The sample prices jump by a factor of two and more a day. Everything is divided by 100, so that
    returns are of the size a daily strategy sees and compound to finite equity.
    """
    from panelmill.operators import features as X

    df = X.make_target(X.add_rolling_returns(X.add_returns(bars(spark, folder), KEYS), KEYS), KEYS)
    df = df.select(
        "series", "date", quantise(F.col("y") / 100, 10).alias("y"), "y_dir",
        quantise(F.col("momentum_5") / 100, 10).alias("pred"), quantise(F.col("volatility_20") / 200, 10).alias("half"),
    ).dropna()
    return df.select(
        "series", "date", "y", "y_dir", "pred",
        (F.col("pred") - F.col("half")).alias("q_low"), (F.col("pred") + F.col("half")).alias("q_high"),
    )
