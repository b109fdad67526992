"""Column lookup, coercion and small scalar expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Accepted column names, in order of preference.
DATE_NAMES = ("date", "ts", "datetime", "time")
OHLCV = ("open", "high", "low", "close", "volume")
DIVIDEND_DATE_NAMES = ("record_date", "last_buy_date", "payment_date", "declared_date", "date", "ts")
AMOUNT_NAMES = ("dividend_net", "amount", "value")

# Accepted spellings of a bar interval.
INTERVAL_NAMES = {"1d": "1d", "d": "1d", "day": "1d", "5m": "5m", "5min": "5m"}


def find_column(df: DataFrame, names: Iterable[str]) -> str | None:
    """First of ``names`` present in ``df``, ignoring case (schema only, no data access)."""
    by_lower = {c.lower(): c for c in df.columns}
    return next((by_lower[n.lower()] for n in names if n.lower() in by_lower), None)


def require_column(df: DataFrame, names: Sequence[str], what: str) -> str:
    found = find_column(df, names)
    if found is None:
        raise ValueError(f"no {what} column: expected one of {', '.join(names)}")
    return found


def to_instant(df: DataFrame, name: str) -> Column:
    """Timestamp of a date-like column; unparseable values become null, zone-less values are UTC."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(name).cast("timestamp")
    if isinstance(kind, T.NumericType):
        # integers are nanoseconds since the epoch
        return F.timestamp_micros(F.floor(F.col(name) / 1000).cast("long"))
    return text_instant(F.col(name))


#: Seconds or minutes followed by a zone or an offset.
ZONED = r"[0-9]:[0-9]{1,2}(\.[0-9]*)?\s*([A-Za-z]|[+-][0-9])"


def text_instant(text: Column) -> Column:
    """Instant of a text; one that names no zone is UTC, whatever the zone of the session."""
    text = F.trim(text)
    local = F.concat(text.try_cast("timestamp_ntz").cast("string"), F.lit("Z"))
    return F.when(text.rlike(ZONED), text.try_cast("timestamp")).otherwise(local.try_cast("timestamp"))


def to_day(df: DataFrame, name: str) -> Column:
    """UTC calendar day of a date-like column."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.to_date(F.col(name))
    instant = to_instant(df, name)
    if isinstance(kind, T.StringType):
        text = F.trim(F.col(name))
        utc = F.to_date(F.to_utc_timestamp(instant, F.current_timezone()))
        return F.when(text.rlike(ZONED), utc).otherwise(F.to_date(text.try_cast("timestamp_ntz")))
    if df.sparkSession.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
        instant = F.to_utc_timestamp(instant, F.current_timezone())
    return F.to_date(instant)


def finite(col: Column) -> Column:
    """Null out NaN and both infinities."""
    return F.when((F.abs(col) < F.lit(float("inf"))) & ~F.isnan(col), col)


def to_number(col: Column) -> Column:
    """Double value of anything; what does not parse, or is not finite, becomes null."""
    return finite(col.try_cast("double"))


def nonzero(col: Column) -> Column:
    return F.nullif(col, F.lit(0.0))


def quantise(col: Column, digits: int) -> Column:
    """Round half up on the binary value; unlike ``round`` this is the same in every SQL engine."""
    scale = float(10**digits)
    return F.floor(col * scale + 0.5) / F.lit(scale)


def symbol_list(raw: str | Column) -> Column:
    """Comma-separated symbols as an array: trimmed, upper case, unique, in first-seen order."""
    text = F.lit(raw) if isinstance(raw, str) else raw
    parts = F.transform(F.split(text, ","), lambda s: F.upper(F.trim(s)))
    return F.array_distinct(F.filter(parts, lambda s: s != ""))


def interval_name(col: Column) -> Column:
    """Canonical interval of one spelling; an unknown one raises when evaluated."""
    key = F.lower(F.trim(col))
    names = F.create_map(*[F.lit(x) for pair in INTERVAL_NAMES.items() for x in pair])
    return F.coalesce(
        F.try_element_at(names, key),
        F.raise_error(F.concat(F.lit("Unsupported interval: "), col)),
    )


def interval_names(raw: str | Column) -> Column:
    text = F.lit(raw) if isinstance(raw, str) else raw
    return F.array_distinct(F.transform(F.split(text, ","), interval_name))


def feature_columns(
    df: DataFrame,
    keys: Sequence[str] = (),
    target: str = "y",
    direction: str = "y_dir",
    exclude: Iterable[str] = (),
) -> list[str]:
    """Numeric columns that may feed a model, sorted by name."""
    skip = {"date", target, direction, *keys, *exclude}
    names = sorted(
        f.name for f in df.schema.fields if f.name not in skip and isinstance(f.dataType, T.NumericType)
    )
    if not names:
        raise ValueError("the table has no numeric feature")
    return names
