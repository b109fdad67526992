"""Flatten nested records of a bar feed into the raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def quotation(value: Column | str) -> Column:
    """``struct<units, nano>`` as a double; null if either part is missing."""
    part = F.col(value) if isinstance(value, str) else value
    return part.getField("units").cast("double") + part.getField("nano").cast("double") / F.lit(1e9)


def flatten_candles(records: DataFrame, instruments: DataFrame, by: str = "instrument_id") -> DataFrame:
    """Candle records (``instrument_id, interval, time`` and quotation prices) as candle rows.

    ``instruments`` has one row per instrument; Spark broadcasts it when its measured size allows.
    """
    prices = [quotation(c).alias(c) for c in ("open", "high", "low", "close")]
    return (
        records.join(instruments.select(by, "symbol", "ticker", "figi"), by)
        .select("symbol", "ticker", "figi", by, F.lower(F.trim("interval")).alias("interval"),
                F.col("time").alias("ts"), *prices, "volume")
    )


def flatten_schedules(response: DataFrame) -> DataFrame:
    """``exchanges[].days[]`` as one row per exchange and day."""
    return (
        response.select(F.explode("exchanges").alias("e"))
        .select(F.col("e.exchange").alias("exchange"), F.explode("e.days").alias("d"))
        .select("exchange", "d.*")
    )


def flatten_dividends(response: DataFrame, context: Sequence[str] = ("symbol",)) -> DataFrame:
    """``dividends[]`` as rows, quotations as doubles and enum values by name."""
    item = response.select(*context, F.explode("dividends").alias("d"))
    return item.select(
        *context,
        *[F.col(f"d.{c}").alias(c) for c in ("last_buy_date", "record_date", "payment_date", "declared_date", "created_at")],
        *[quotation(F.col(f"d.{c}")).alias(c) for c in ("dividend_net", "close_price", "yield_value")],
        *[F.col(f"d.{c}").cast("string").alias(c) for c in ("regularity", "dividend_type")],
    )


def label_statuses(statuses: DataFrame, instruments: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Attach the symbol by instrument id, else by figi, and stamp the load time."""
    by_id = instruments.select(F.col("instrument_id"), F.col("symbol").alias("symbol_by_id"))
    by_figi = instruments.select(F.col("figi"), F.col("symbol").alias("symbol_by_figi"))
    joined = statuses.join(by_id, "instrument_id", "left").join(by_figi, "figi", "left")
    symbol = F.coalesce("symbol_by_id", "symbol_by_figi").alias("symbol")
    rest = [c for c in statuses.columns if c not in ("instrument_id", "figi")]
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    return joined.select(symbol, "instrument_id", "figi", *rest, stamp.alias("loaded_at"))
