"""Signals, strategy curves and their metrics, per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelmill.functions.columns import finite
from panelmill.functions.windows import ordered, running

TRADING_DAYS = 252  # fixed value: periods per year
BPS = 10_000.0  # fixed value: basis points per unit


def threshold_signal(pred: Column, threshold: Column | float) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(pred > t, 1).when(pred < -t, -1).otherwise(0)


def selector_signal(
    pred: Column, q_low: Column, q_high: Column, threshold: Column | float = 0.0, thr_min: Column | float = 0.0,
    use_cost_rule: bool = True, risk_multiple: float = 1.0, max_width: float | None = None,
) -> Column:
    """Direction of the main prediction, kept only where the predicted interval limits the risk."""
    if risk_multiple <= 0:
        raise ValueError("the risk multiple has to be above 0")
    if max_width is not None and max_width <= 0:
        raise ValueError("a largest width has to be above 0")
    pred, q_low, q_high = finite(pred), finite(q_low), finite(q_high)
    if use_cost_rule:
        band = risk_multiple * (thr_min if isinstance(thr_min, Column) else F.lit(float(thr_min)))
        long_ok, short_ok = q_low > -band, q_high < band
    else:
        long_ok, short_ok = q_low > 0, q_high < 0
    usable = pred.isNotNull() & q_low.isNotNull() & q_high.isNotNull()
    if max_width is not None:
        usable = usable & ((q_high - q_low) <= max_width)
    side = threshold_signal(pred, threshold)
    keep = usable & (((side == 1) & long_ok) | ((side == -1) & short_ok))
    return F.when(F.coalesce(keep, F.lit(False)), side).otherwise(0)


def cost_threshold(cost_bps: float, multiplier: float = 1.0) -> float:
    """Smallest prediction worth trading after costs."""
    if cost_bps <= 0:
        return 0.0
    if multiplier <= 0:
        raise ValueError("the multiplier has to be above 0")
    return cost_bps / BPS * multiplier


def strategy_curve(
    df: DataFrame, keys: Sequence[str], signal: Column, date: str = "date", y: str = "y", pred: str = "pred",
    cost_bps: float = 0.0,
) -> DataFrame:
    """Day-by-day signal, turnover, cost, return, equity and drawdown of each series."""
    out = df.select(*keys, date, F.col(y).alias("y_true"), F.col(pred).alias("pred"), signal.alias("signal"))
    previous = F.coalesce(F.lag("signal", 1).over(ordered(keys, date)), F.lit(0))
    out = out.withColumn("turnover", F.abs(F.col("signal") - previous).cast("double"))
    out = out.withColumn("transaction_cost", F.lit(cost_bps / BPS) * F.col("turnover"))
    out = out.withColumn("strategy_return", F.col("signal") * F.col("y_true") - F.col("transaction_cost"))
    out = out.withColumn("equity", F.exp(F.sum("strategy_return").over(running(keys, date))))
    out = out.withColumn("equity_peak", F.max("equity").over(running(keys, date)))
    return out.withColumn("drawdown", F.col("equity") / F.col("equity_peak") - 1.0)


def sharpe_ratio(returns: Column) -> Column:
    deviation = F.stddev_pop(returns)
    return F.when(deviation <= 0, 0.0).otherwise(F.try_divide(F.avg(returns), deviation) * F.sqrt(F.lit(float(TRADING_DAYS))))


def annual_growth(last_equity: Column, n: Column) -> Column:
    return F.when(last_equity > 0, F.pow(last_equity, F.lit(float(TRADING_DAYS)) / n) - 1.0).otherwise(0.0)


def hit_ratio(y: Column, signal: Column) -> Column:
    hit = (F.signum(y) == F.signum(signal)).cast("double")
    return F.coalesce(F.avg(F.when(signal != 0, hit)), F.lit(0.0))


def strategy_metrics(curve: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    last = F.max_by("equity", date)
    active = (F.col("signal") != 0).cast("double")
    return curve.groupBy(*keys).agg(
        (last - 1.0).alias("total_return"),
        annual_growth(last, F.count(F.lit(1))).alias("cagr"),
        sharpe_ratio(F.col("strategy_return")).alias("sharpe"),
        F.min("drawdown").alias("max_drawdown"),
        F.avg(active).alias("exposure"),
        F.sum("turnover").alias("turnover_total"),
        F.avg("turnover").alias("turnover_avg"),
        F.sum("transaction_cost").alias("transaction_cost_total"),
        hit_ratio(F.col("y_true"), F.col("signal")).alias("hit_rate"),
    )


def signal_label(signal: Column) -> Column:
    return F.when(signal == 1, "long").when(signal == -1, "short").otherwise("flat")


def signal_rate(df: DataFrame, keys: Sequence[str], signal: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg((F.col(signal) != 0).cast("double")).alias("signal_rate"))


def low_signal_warning(df: DataFrame, keys: Sequence[str], pred: str, min_threshold: float) -> DataFrame:
    """Series whose p90 of |prediction| is below the cost threshold: they will mostly stay flat."""
    p90 = F.percentile(F.abs(F.col(pred)), F.lit(0.9))
    return df.groupBy(*keys).agg(p90.alias("pred_abs_p90")).withColumn(
        "low_signal", F.lit(min_threshold > 0) & (F.col("pred_abs_p90") < min_threshold)
    )
