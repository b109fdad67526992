"""Raw tables to clean bar, calendar and dividend frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelmill.functions.columns import (
    AMOUNT_NAMES, DATE_NAMES, DIVIDEND_DATE_NAMES, OHLCV, find_column, require_column, to_day, to_instant, to_number,
)
from panelmill.operators.ingest import dedup_last, keep_first
from panelmill.sources.readers import input_order


def check_dates(df: DataFrame, name: str = "date") -> DataFrame:
    """Fail on an empty table or one without a single readable date (runs one small job)."""
    rows, dated = df.agg(F.count(F.lit(1)), F.count(name)).head()
    if rows == 0:
        raise ValueError("there are no rows")
    if dated == 0:
        raise ValueError(f"no value of {name} is a date")
    return df


def _order_columns(df: DataFrame, recency: Sequence[str]) -> list[Column]:
    """What "last" means: the named columns, else the place of a row in the files that are read, else nothing."""
    found = [F.col(c) for c in recency]
    if not found and (place := input_order(df)) is not None:
        found = [place]
    return [c.alias(f"_seq{i}") for i, c in enumerate(found)]


def _keep_last(df: DataFrame, keys: Sequence[str], recency: Sequence[str]) -> DataFrame:
    """Keep-last by ``recency``; rows without any order of their own are picked by value so that reruns agree."""
    if recency:
        return dedup_last(df, keys, recency).drop(*[c for c in recency if c not in keys])
    rest = [c for c in df.columns if c not in keys]
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in rest])


def prepare_bars(
    df: DataFrame, keys: Sequence[str] = (), suffix: str = "", recency: Sequence[str] = (), validate: bool = False,
) -> DataFrame:
    """``keys, date`` and numeric OHLCV, one row per key and day, the last row winning.

    The last one by ``recency``; without it, of a frame that was read from files, the last in file order.

    Every OHLCV column is required for the main series (no suffix) and optional for a context series.
    """
    day = to_day(df, require_column(df, DATE_NAMES, "date"))
    cols = []
    for field in OHLCV:
        source = find_column(df, (field,))
        if source is None and not suffix:
            raise ValueError(f"the bar table has no column for {field}")
        if source is not None:
            cols.append(to_number(F.col(source)).alias(f"{field}_{suffix}" if suffix else field))
    extra = _order_columns(df, recency)
    out = df.select(*keys, day.alias("date"), *cols, *extra)
    if validate:
        check_dates(out)
    out = out.where(F.col("date").isNotNull())
    return _keep_last(out, [*keys, "date"], [f"_seq{i}" for i in range(len(extra))])


def prepare_calendar(df: DataFrame, keys: Sequence[str] = (), recency: Sequence[str] = ()) -> DataFrame:
    """``date, is_trading_day``; without a flag column, or for an empty flag, the day counts as trading."""
    day = to_day(df, require_column(df, DATE_NAMES, "date"))
    flag = find_column(df, ("is_trading_day",))
    trading = F.lit(True) if flag is None else F.coalesce(F.col(flag).cast("boolean"), F.lit(True))
    extra = _order_columns(df, recency)
    out = df.select(*keys, day.alias("date"), trading.alias("is_trading_day"), *extra)
    return _keep_last(out.where(F.col("date").isNotNull()), [*keys, "date"], [f"_seq{i}" for i in range(len(extra))])


def prepare_dividends(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Dividend amount and flag per day; a missing or zero amount counts 1."""
    day = to_day(df, require_column(df, DIVIDEND_DATE_NAMES, "dividend date"))
    amount_name = find_column(df, AMOUNT_NAMES)
    if amount_name is None:
        amount = F.lit(1.0)
    else:
        value = F.coalesce(to_number(F.col(amount_name)), F.lit(0.0))
        amount = F.when(value == 0.0, 1.0).otherwise(value)
    return (
        df.select(*keys, day.alias("date"), amount.alias("amount")).where(F.col("date").isNotNull())
        .groupBy(*keys, "date").agg(F.sum("amount").alias("dividend_amount_t"))
        .withColumn("dividend_flag_t", (F.col("dividend_amount_t") > 0).cast("int"))
    )


def prepare_dated(df: DataFrame, keys: Sequence[str] = (), recency: Sequence[str] = (), required: bool = True) -> DataFrame:
    """Any table with a ``date`` timestamp (time of day kept), undated rows dropped, keep-last per date."""
    name = find_column(df, DATE_NAMES)
    if name is None and required:
        raise ValueError(f"no date column: expected one of {', '.join(DATE_NAMES)}")
    instant = F.lit(None).cast("timestamp") if name is None else to_instant(df, name)
    seq = _order_columns(df, recency)
    out = df.select("*", *seq).withColumn("date", instant).where(F.col("date").isNotNull())
    order = [f"_seq{i}" for i in range(len(seq))] or [c for c in out.columns if c not in (*keys, "date")]
    return keep_first(out, [*keys, "date"], [F.col(c).desc_nulls_last() for c in order]).drop(*[f"_seq{i}" for i in range(len(seq))])
