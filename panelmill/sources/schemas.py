"""Explicit schemas of the raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

_TYPES = {
    "string": StringType(), "int": IntegerType(), "bigint": LongType(), "double": DoubleType(),
    "boolean": BooleanType(), "timestamp": TimestampType(),
}


def _schema(text: str) -> StructType:
    """Schema from ``name type, name type``; unlike ``fromDDL`` this needs no running session."""
    return StructType([StructField(n, _TYPES[t]) for n, t in (item.split() for item in text.split(","))])

INSTRUMENTS = _schema(
    "symbol string, ticker string, instrument_id string, figi string, class_code string, exchange string, "
    "currency string, lot int, min_price_increment double, name string, first_1day_candle_date timestamp, "
    "first_1min_candle_date timestamp, loaded_at timestamp"
)
CANDLES = _schema(
    "symbol string, ticker string, figi string, instrument_id string, interval string, ts timestamp, "
    "open double, high double, low double, close double, volume bigint, year int"
)
DIVIDENDS = _schema(
    "symbol string, ticker string, figi string, instrument_id string, currency string, last_buy_date timestamp, "
    "record_date timestamp, payment_date timestamp, declared_date timestamp, created_at timestamp, "
    "dividend_net double, close_price double, yield_value double, regularity string, dividend_type string"
)
SCHEDULES = _schema(
    "exchange string, date timestamp, is_trading_day boolean, start_time timestamp, end_time timestamp, "
    "opening_auction_start_time timestamp, opening_auction_end_time timestamp, "
    "closing_auction_start_time timestamp, closing_auction_end_time timestamp, "
    "evening_start_time timestamp, evening_end_time timestamp"
)
#: Beside these a status has the flags of its feed: every column whose name ends in ``FLAG_END``.
STATUSES = _schema("symbol string, instrument_id string, figi string, trading_status string, only_best_price boolean, loaded_at timestamp")
FLAG_END = "_available_flag"

# Record key of each stored table; a later row with the same key replaces the earlier one.
TABLE_KEYS = {
    "instruments": ["symbol"],
    "candles": ["symbol", "interval", "ts"],
    "dividends": ["symbol", "record_date", "payment_date", "last_buy_date", "dividend_net"],
    "schedules": ["exchange", "date"],
    "statuses": ["symbol", "instrument_id", "loaded_at"],
}


def status_schema(columns: Sequence[str]) -> StructType:
    """The schema of statuses whose feed has these columns."""
    flags = [c for c in columns if c.endswith(FLAG_END)]
    return StructType([*STATUSES.fields[:4], *(StructField(c, BooleanType()) for c in flags), *STATUSES.fields[4:]])
