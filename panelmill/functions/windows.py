"""Window specs over a panel: one partition per series, ordered in time.

Every caller has at most one row per (series, day) or (series, slot) by the time a window runs, because
the aggregations and keep-last step before it combine on the map side. A window group is therefore
bounded by the calendar whatever share of the raw rows one series holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec, functions as F


def ordered(keys: Sequence[str], order: str = "date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def trailing(keys: Sequence[str], rows: int, order: str = "date") -> WindowSpec:
    return ordered(keys, order).rowsBetween(-(rows - 1), 0)


def running(keys: Sequence[str], order: str = "date") -> WindowSpec:
    return ordered(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def full_window(agg, name: str, keys: Sequence[str], rows: int, order: str = "date") -> Column:
    """``agg(name)`` over the last ``rows`` rows, null until all of them are present and non-null."""
    w = trailing(keys, rows, order)
    return F.when(F.count(name).over(w) == rows, agg(name).over(w))
