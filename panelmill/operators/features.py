"""Return, volatility, volume, calendar and context features, targets and indicators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from panelmill.functions.columns import OHLCV, nonzero
from panelmill.functions.windows import full_window, ordered, running, trailing

# Feature horizons and windows.
RETURN_STEPS = (1, 2, 5, 10)
RETURN_WINDOWS = (5, 10, 20)
CONTEXT_MEAN, CONTEXT_STD = 5, 20
VOLUME_SHORT, VOLUME_LONG = 5, 20


def step_return(price: str, steps: int, keys: Sequence[str]) -> Column:
    clean = nonzero(F.col(price))
    return F.try_divide(clean, F.lag(clean, steps).over(ordered(keys))) - 1


def log_volume(volume: str = "volume") -> Column:
    v = F.col(volume)
    return F.when(v.isNotNull(), F.ln(F.greatest(v, F.lit(1.0))))


def add_returns(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumns({f"ret_{k}": step_return("close", k, keys) for k in RETURN_STEPS})


def add_rolling_returns(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rolling sample deviation and mean of ``ret_1``."""
    cols = {}
    for n in RETURN_WINDOWS:
        cols[f"volatility_{n}"] = full_window(F.stddev_samp, "ret_1", keys, n)
        cols[f"momentum_{n}"] = full_window(F.avg, "ret_1", keys, n)
    return df.withColumns(cols)


def add_candle_shape(df: DataFrame) -> DataFrame:
    close, opening = nonzero(F.col("close")), nonzero(F.col("open"))
    return df.withColumns({
        "hl_range": F.try_divide(F.col("high") - F.col("low"), close),
        "co_move": F.try_divide(F.col("close") - F.col("open"), opening),
    })


def add_volume_features(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    df = df.withColumn("log_volume", log_volume())
    deviation = full_window(F.stddev_samp, "log_volume", keys, VOLUME_LONG)
    mean_long = full_window(F.avg, "log_volume", keys, VOLUME_LONG)
    return df.withColumns({
        "log_volume_mean_5": full_window(F.avg, "log_volume", keys, VOLUME_SHORT),
        "log_volume_mean_20": mean_long,
        "volume_zscore_20": F.try_divide(F.col("log_volume") - mean_long, deviation),
    })


def add_calendar_parts(df: DataFrame) -> DataFrame:
    d = F.col("date")
    return df.withColumns({
        "day_of_week": F.weekday(d).cast("int"),
        "month": F.month(d).cast("int"),
        "day_of_month": F.dayofmonth(d).cast("int"),
        "is_month_end": (F.last_day(d) == d).cast("int"),
    })


def add_dividend_flags(df: DataFrame, keys: Sequence[str], lead: bool = False) -> DataFrame:
    """Clean flag; ``lead`` adds the next row's flag, which needs a dividend calendar known in advance."""
    flag = F.coalesce(F.col("dividend_flag_t"), F.lit(0)).cast("int") if "dividend_flag_t" in df.columns else F.lit(0)
    df = df.withColumn("dividend_flag_t", flag)
    if lead:
        following = F.lead("dividend_flag_t", 1).over(ordered(keys))
        df = df.withColumn("dividend_flag_t_plus_1", F.coalesce(following, F.lit(0)))
    return df


def context_columns(prefix: str) -> list[str]:
    return [f"ret_{prefix}_1", f"ret_{prefix}_mom_{CONTEXT_MEAN}", f"ret_{prefix}_vol_{CONTEXT_STD}"]


def _context_from_close(df: DataFrame, close: str, prefix: str, keys: Sequence[str]) -> DataFrame:
    one, mean, deviation = context_columns(prefix)
    df = df.withColumn(one, step_return(close, 1, keys))
    return df.withColumns({
        mean: full_window(F.avg, one, keys, CONTEXT_MEAN),
        deviation: full_window(F.stddev_samp, one, keys, CONTEXT_STD),
    })


def context_features(context: DataFrame, prefix: str, keys: Sequence[str] = ()) -> DataFrame:
    """Context returns on the context's own calendar; ``context`` has one row per key and date."""
    close = f"close_{prefix}"
    if close not in context.columns:
        raise ValueError(f"the context has no close column {close}")
    out = _context_from_close(context.select(*keys, "date", close), close, prefix, keys)
    return out.select(*keys, "date", *context_columns(prefix))


def drop_context_prices(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    return df.drop(*[f"{field}_{p}" for p in prefixes for field in OHLCV])


def make_features(df: DataFrame, keys: Sequence[str], prefixes: Sequence[str] = (), dividend_lead: bool = False) -> DataFrame:
    """All features of a cleaned panel. The windows share one spec: one exchange and one sort by series."""
    df = add_returns(df, keys)
    df = add_rolling_returns(df, keys)
    df = add_candle_shape(df)
    df = add_volume_features(df, keys)
    for p in prefixes:
        if f"ret_{p}_1" not in df.columns and f"close_{p}" in df.columns:
            df = _context_from_close(df, f"close_{p}", p, keys)
    df = add_calendar_parts(df)
    df = add_dividend_flags(df, keys, dividend_lead)
    return drop_context_prices(df, prefixes)


def make_target(df: DataFrame, keys: Sequence[str], kind: str = "log") -> DataFrame:
    """Next-row return ``y`` and its direction; a missing ``y`` has direction 0."""
    if kind not in ("log", "simple"):
        raise ValueError("target kind must be one of: log, simple")
    close = nonzero(F.col("close"))
    ratio = F.try_divide(F.lead(close, 1).over(ordered(keys)), close)
    df = df.withColumn("y", F.ln(ratio) if kind == "log" else ratio - 1)
    return df.withColumn("y_dir", F.coalesce((F.col("y") > 0).cast("int"), F.lit(0)))


def drop_last_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop each series' newest row, which has no next day."""
    following = F.lead("date").over(ordered(keys))
    return df.withColumn("_next", following).where(F.col("_next").isNotNull()).drop("_next")


def finalize(df: DataFrame, require_rows: bool = False) -> DataFrame:
    """Drop rows with a null, a NaN or an infinity in any column.

    A finite number times zero is zero, anything else is not: one short sum tests all floats, in place of a condition a column.
    """
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    rest = [c for c in df.columns if c not in floats]
    out = df.dropna("any", subset=rest) if rest else df
    if floats:
        out = out.where(reduce(add, [F.col(f"`{c}`") * F.lit(0.0) for c in floats]) == 0)
    if require_rows and out.isEmpty():
        raise ValueError("no row is left without missing values")
    return out


def latest_rows(df: DataFrame, keys: Sequence[str], order: str = "date") -> DataFrame:
    from panelmill.operators.ingest import keep_first

    return keep_first(df, keys, [F.col(order).desc()])


# --- indicators -------------------------------------------------------------------------------------


def add_atr(df: DataFrame, keys: Sequence[str], rows: int = 14) -> DataFrame:
    """Average true range (simple mean) and its share of the close."""
    previous = F.lag("close").over(ordered(keys))
    span = F.col("high") - F.col("low")
    widest = F.greatest(span, F.abs(F.col("high") - previous), F.abs(F.col("low") - previous))
    df = df.withColumn("true_range", widest)
    df = df.withColumn(f"atr_{rows}", full_window(F.avg, "true_range", keys, rows))
    return df.withColumn(f"atr_pct_{rows}", F.try_divide(F.col(f"atr_{rows}"), nonzero(F.col("close"))))


def add_obv(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """On-balance volume: running volume signed by the direction of the close."""
    move = F.signum(F.col("close") - F.lag("close").over(ordered(keys)))
    df = df.withColumn("_signed", F.coalesce(move, F.lit(0.0)) * F.col("volume"))
    return df.withColumn("obv", F.sum("_signed").over(running(keys))).drop("_signed")


def add_accumulation(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Accumulation/distribution line; a bar without range adds nothing."""
    c, h, low = F.col("close"), F.col("high"), F.col("low")
    flow = F.coalesce(F.try_divide((c - low) - (h - c), h - low), F.lit(0.0)) * F.col("volume")
    df = df.withColumn("_flow", flow)
    return df.withColumn("ad_line", F.sum("_flow").over(running(keys))).drop("_flow")


def add_mfi(df: DataFrame, keys: Sequence[str], rows: int = 14) -> DataFrame:
    """Money flow index over ``rows`` changes of the typical price."""
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    df = df.withColumn("_tp", typical)
    df = df.withColumn("_change", F.col("_tp") - F.lag("_tp").over(ordered(keys)))
    money = F.col("_tp") * F.col("volume")
    w = trailing(keys, rows)
    up = F.sum(F.when(F.col("_change") > 0, money).otherwise(0.0)).over(w)
    down = F.sum(F.when(F.col("_change") < 0, money).otherwise(0.0)).over(w)
    index = F.when(F.count("_change").over(w) == rows, F.try_divide(100 * up, up + down))
    return df.withColumn(f"mfi_{rows}", index).drop("_tp", "_change")


def intraday_rollup(bars: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Daily vwap, range and 5-minute volatility from intraday bars (one row per key and slot)."""
    df = bars.withColumn("date", F.to_date(ts))
    within_day = ordered([*keys, "date"], ts)
    change = F.try_divide(F.col("close"), nonzero(F.lag("close").over(within_day))) - 1
    traded = F.sum(F.col("close") * F.col("volume"))
    daily = df.withColumn("_ret", change).groupBy(*keys, "date").agg(
        F.try_divide(traded, nonzero(F.sum("volume"))).alias("daily_vwap"),
        (F.max("high") - F.min("low")).alias("intraday_range"),
        F.stddev_samp("_ret").alias("intraday_vol"),
        F.max_by("close", ts).alias("_close"),
    )
    return daily.withColumn("close_vs_vwap", F.try_divide(F.col("_close"), nonzero(F.col("daily_vwap"))) - 1).drop("_close")
