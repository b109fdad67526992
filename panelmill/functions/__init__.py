from panelmill.functions.columns import (
    AMOUNT_NAMES,
    DATE_NAMES,
    DIVIDEND_DATE_NAMES,
    OHLCV,
    feature_columns,
    find_column,
    interval_name,
    interval_names,
    quantise,
    symbol_list,
    to_day,
    to_instant,
    to_number,
    finite,
)
from panelmill.functions.windows import full_window, ordered, running, trailing

__all__ = [
    "AMOUNT_NAMES", "DATE_NAMES", "DIVIDEND_DATE_NAMES", "OHLCV", "feature_columns", "find_column",
    "finite", "full_window", "interval_name", "interval_names", "ordered", "quantise", "running",
    "symbol_list", "to_day", "to_instant", "to_number", "trailing",
]
