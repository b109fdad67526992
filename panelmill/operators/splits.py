"""Time-ordered splits and walk-forward folds, always cut on dates."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from panelmill.operators.joins import by_day

MIN_ROWS = 30  # fixed value: smallest dataset that can be split


def check_ratios(ratios: Sequence[float]) -> None:
    if not math.isclose(sum(ratios), 1.0, rel_tol=1e-5, abs_tol=1e-8):
        raise ValueError("the three shares have to add up to 1")
    if min(ratios) <= 0:
        raise ValueError("every share has to be above 0")


def date_index(df: DataFrame, date: str = "date") -> DataFrame:
    """Distinct dates with a 0-based position; one row per calendar day, so one ordered task is enough."""
    return df.select(date).distinct().select(
        date, (F.row_number().over(Window.orderBy(date)) - 1).alias("idx")
    )


def time_split(
    df: DataFrame, date: str = "date", ratios: Sequence[float] = (0.70, 0.15, 0.15), per_key: Sequence[str] = (),
) -> DataFrame:
    """Add ``split`` = train / val / test.

    By default the panel is cut at two dates, so no date is on both sides. They are a one-row scalar
    subquery: the panel itself is neither shuffled nor joined. The subquery reads the ``date`` column of
    ``df``, so pass a stored table and not a long unfinished plan. ``per_key`` cuts each series by its
    own row positions instead.
    """
    check_ratios(ratios)
    n = F.col("n")
    train_end = F.floor(n * F.lit(float(ratios[0])))
    val_end = train_end + F.floor(n * F.lit(float(ratios[1])))
    bad = (train_end <= 0) | (val_end <= train_end) | (val_end >= n)

    if per_key:
        w = Window.partitionBy(*per_key)
        pos = df.withColumn("n", F.count(F.lit(1)).over(w)).withColumn(
            "_pos", F.row_number().over(w.orderBy(date)) - 1
        )
        split = (
            F.when(n < MIN_ROWS, F.raise_error(F.lit("too few dates for three parts")))
            .when(bad, F.raise_error(F.lit("a part of the split is empty")))
            .when(F.col("_pos") < train_end, "train").when(F.col("_pos") < val_end, "val").otherwise("test")
        )
        return pos.withColumn("split", split).drop("n", "_pos")

    dates = date_index(df, date).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy()))
    cuts = dates.agg(
        F.max("n").alias("n"),
        F.min(F.when(F.col("idx") >= train_end, F.col(date))).alias("val_from"),
        F.min(F.when(F.col("idx") >= val_end, F.col(date))).alias("test_from"),
    ).select(
        F.when(F.coalesce(n, F.lit(0)) < MIN_ROWS, F.raise_error(F.lit("too few dates for three parts")))
        .when(bad, F.raise_error(F.lit("a part of the split is empty")))
        .otherwise(F.struct("val_from", "test_from")).alias("cut")
    )
    cut = cuts.scalar()
    d = F.col(date)
    return df.withColumn(
        "split",
        F.when(d < cut.getField("val_from"), "train").when(d < cut.getField("test_from"), "val").otherwise("test"),
    )


@dataclass(frozen=True)
class FoldLayout:
    train_size: int
    val_size: int
    test_size: int
    step_size: int
    folds: int


def fold_layout(
    n: int, folds: int, val_ratio: float, test_ratio: float, step_size: int | None = None, min_train: int = 252,
) -> FoldLayout:
    """Sizes of the walk-forward blocks for ``n`` dates; folds are given up until training is long enough."""
    if folds <= 0:
        raise ValueError("at least one fold is needed")
    val, test = (max(20, int(n * r)) for r in (val_ratio, test_ratio))
    step = max(5, test // folds) if step_size is None else step_size
    if step <= 0:
        raise ValueError("the step has to be at least 1")
    room = n - val - test
    # the largest fold count that still leaves min_train dates, but at least one fold
    fitting = [f for f in range(folds, 0, -1) if room - (f - 1) * step >= min_train]
    count = fitting[0] if fitting else 1
    train = room - (count - 1) * step
    if train < 60:
        raise ValueError(
            f"{n} dates leave {train} to train on beside {val} + {test} held out and {count} folds {step} apart; 60 are needed"
        )
    return FoldLayout(train, val, test, step, count)


def layout_for(n: int, folds: int, train_ratio: float, val_ratio: float, test_ratio: float, step_size: int | None = None) -> FoldLayout:
    min_train = max(120, int(n * max(0.2, train_ratio * 0.4)))
    return fold_layout(n, folds, val_ratio, test_ratio, step_size, min_train)


def fold_dates(dates: DataFrame, layout: FoldLayout, expanding: bool = True, date: str = "date") -> DataFrame:
    """``fold, split, date`` for every date of every complete fold; at most dates x folds rows."""
    if min(layout.train_size, layout.val_size, layout.test_size) <= 0:
        raise ValueError("every part needs at least one date")
    if layout.step_size <= 0:
        raise ValueError("the step has to be at least 1")
    numbered = F.explode(F.array(*[F.lit(i) for i in range(layout.folds)])).alias("_f")
    shift = F.col("_f") * layout.step_size
    start = F.lit(0) if expanding else shift
    train_end = shift + layout.train_size
    val_end = train_end + layout.val_size
    test_end = val_end + layout.test_size
    idx = F.col("idx")
    split = (
        F.when((idx >= start) & (idx < train_end), "train")
        .when((idx >= train_end) & (idx < val_end), "val")
        .when((idx >= val_end) & (idx < test_end), "test")
    )
    total = F.count(F.lit(1)).over(Window.partitionBy())
    return (
        dates.withColumn("_n", total).select(date, "idx", "_n", numbered)
        .where(test_end <= F.col("_n"))
        .select((F.col("_f") + 1).alias("fold"), split.alias("split"), date)
        .where(F.col("split").isNotNull())
    )


def walk_forward(df: DataFrame, layout: FoldLayout, expanding: bool = True, date: str = "date") -> DataFrame:
    """One copy of a row per fold and split it belongs to."""
    return df.join(by_day(fold_dates(date_index(df, date), layout, expanding, date)), date)


def split_ranges(df: DataFrame, by: Sequence[str] = ("split",), date: str = "date") -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.min(date).alias("date_start"), F.max(date).alias("date_end")
    )
