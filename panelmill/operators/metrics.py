"""Regression, direction, sanity, distribution and fold metrics as grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from panelmill.operators.ranks import FLAT, exact_quantiles, guarded_corr, rank_correlation, series_rank


def safe(value: Column) -> Column:
    """0 for an empty or non-finite aggregate."""
    return F.when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), 0.0).otherwise(value)


def safe_std(col: Column) -> Column:
    s = safe(F.stddev_pop(col))
    return F.when(s < FLAT, 0.0).otherwise(s)


def error_aggregates(y: str, pred: str) -> list[Column]:
    e = F.col(y) - F.col(pred)
    return [F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), guarded_corr(pred, y).alias("ic_pearson")]


def regression_metrics(df: DataFrame, keys: Sequence[str], y: str = "y", pred: str = "pred", daily: bool = True, parts: int | None = None) -> DataFrame:
    """MAE, RMSE and both information coefficients per group.

    ``daily`` says a group has at most one row per day, so it may be ranked in one task. Otherwise the
    ranks come from the range-partitioned form. ``parts`` deals daily groups to so many tasks; None leaves it to Spark.
    """
    if daily and keys:
        # a pair with a missing side has no rank; nulls sort first, so they move all other ranks by the same amount
        both = F.col(y).isNotNull() & F.col(pred).isNotNull()
        pairs = (df if parts is None else df.select(*keys, y, pred).repartition(parts, *keys)).select(*keys, y, pred, F.when(both, F.col(y)).alias("_y"), F.when(both, F.col(pred)).alias("_p"))
        ranked = pairs.select(*keys, y, pred, F.when(both, series_rank(keys, "_p")).alias("_rp"), F.when(both, series_rank(keys, "_y")).alias("_ry"))
        return ranked.groupBy(*keys).agg(*error_aggregates(y, pred), guarded_corr("_rp", "_ry").alias("ic_spearman"))
    errors = df.groupBy(*keys).agg(*error_aggregates(y, pred))
    ranks = rank_correlation(df, keys, pred, y, "ic_spearman")
    if keys:
        return errors.join(ranks, list(keys))
    return errors.withColumn("ic_spearman", ranks.scalar())


def direction_metrics(df: DataFrame, keys: Sequence[str], y: str = "y_dir", pred: str = "pred_dir") -> DataFrame:
    """Accuracy and the mean recall over the classes that occur."""
    hit = (F.col(y) == F.col(pred)).cast("double")
    recalls = [F.avg(F.when(F.col(y) == c, hit)) for c in (0, 1)]
    seen = sum(r.isNotNull().cast("int") for r in recalls)
    return df.groupBy(*keys).agg(
        F.avg(hit).alias("accuracy"),
        F.try_divide(sum(F.coalesce(r, F.lit(0.0)) for r in recalls), seen).alias("balanced_accuracy"),
    )


def sanity_checks(
    df: DataFrame, keys: Sequence[str], y: str = "y", pred: str = "pred", split: str = "split",
    collapse_ratio: float = 0.1, daily: bool = True,
) -> DataFrame:
    """Prediction and target moments on validation and test, and whether the prediction collapsed.

    With ``daily`` groups (one row per day) p90 is an exact percentile inside the aggregate; otherwise
    ``keys`` must be empty and it is found by narrowing.
    """
    aggs = []
    for part in ("val", "test"):
        here = F.col(split) == part
        p, t = F.when(here, F.col(pred)), F.when(here, F.col(y))
        if daily and keys:
            p90 = safe(F.percentile(F.abs(p), F.lit(0.9)))
        elif keys:
            raise ValueError("unbounded groups are supported for the pooled form only")
        else:
            p90 = F.lit(exact_quantiles(df.where(here), F.abs(F.col(pred)), [0.9])[0])
        ps, ys = safe_std(p), safe_std(t)
        aggs += [
            safe(F.avg(p)).alias(f"pred_mean_{part}"), ps.alias(f"pred_std_{part}"),
            p90.alias(f"pred_abs_p90_{part}"), safe(F.max(F.abs(p))).alias(f"pred_abs_max_{part}"),
            safe(F.avg(t)).alias(f"y_mean_{part}"), ys.alias(f"y_std_{part}"),
            F.when(ys <= 0, 0.0).otherwise(F.try_divide(ps, ys)).alias(f"pred_to_y_std_ratio_{part}"),
        ]
    low = [F.col(f"pred_to_y_std_ratio_{part}") < collapse_ratio for part in ("val", "test")]
    return df.groupBy(*keys).agg(*aggs).withColumn("pred_collapse_warning", low[0] | low[1])


def missing_ratio(df: DataFrame, top_n: int | None = 30, only_missing: bool = False) -> DataFrame:
    """Share of nulls per column, largest first; one pass over the table."""
    shares = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(c) for c in df.columns])
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("missing_ratio")) for c in df.columns])
    long = shares.select(F.explode(items).alias("i")).select("i.*")
    if only_missing:
        long = long.where("missing_ratio > 0")
    ranked = long.orderBy(F.col("missing_ratio").desc(), "column")
    return ranked if top_n is None else ranked.limit(top_n)


def histogram(df: DataFrame, name: str, bins: int = 60) -> DataFrame:
    """Equal-width bins from min to max with a closed last bin; every bin is listed, also empty ones."""
    values = df.select(F.col(name).cast("double").alias("v")).where(F.col("v").isNotNull())
    lo, hi = F.min("v"), F.max("v")
    span = values.agg(
        F.when(lo == hi, lo - 0.5).otherwise(lo).alias("lo"), F.when(lo == hi, hi + 0.5).otherwise(hi).alias("hi")
    ).select(F.struct("lo", "hi").alias("r")).scalar()
    low = span.getField("lo")
    width = (span.getField("hi") - low) / bins

    def edge(i: Column) -> Column:
        return low + i * width

    guess = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)).cast("int")
    placed = values.withColumn("g", guess)
    g = F.col("g")
    # floating point can put a value next to its bin: settle it against the edges themselves
    bin_no = F.when(F.col("v") < edge(g), g - 1).when((F.col("v") >= edge(g + 1)) & (g < bins - 1), g + 1).otherwise(g)
    counts = placed.groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin", edge(F.col("bin")).alias("left_edge"), edge(F.col("bin") + 1).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def fold_summary(folds: DataFrame, id_col: str = "fold") -> DataFrame:
    """Mean, median, population deviation, min and max of every numeric metric over the folds."""
    names = sorted(f.name for f in folds.schema.fields if f.name != id_col and isinstance(f.dataType, NumericType))
    items = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in names])
    long = folds.select(F.explode(items).alias("i")).select("i.*").where("v is not null")
    return long.groupBy("metric").agg(
        F.avg("v").alias("mean"), F.median("v").alias("median"), F.stddev_pop("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )


def target_stats(df: DataFrame, y: str = "y", y_dir: str = "y_dir") -> DataFrame:
    """Distribution of the target over a whole dataset; the quantiles are exact."""
    p01, median, p99 = exact_quantiles(df, F.col(y), [0.01, 0.5, 0.99])
    t = F.col(y)
    return df.agg(
        F.avg(t).alias("mean"), F.stddev_pop(t).alias("std"), F.lit(median).alias("median"),
        F.lit(p01).alias("p01"), F.lit(p99).alias("p99"),
        F.avg(F.when(t.isNotNull(), (t > 0).cast("double"))).alias("positive_rate"),
        F.avg((F.col(y_dir) > 0).cast("double")).alias("y_dir_positive_rate"),
    )


def signal_distribution(df: DataFrame, keys: Sequence[str] = (), signal: str = "signal") -> DataFrame:
    """Days per signal value -1, 0, 1, with zeros for values that do not occur."""
    labels = {-1: "short", 0: "flat", 1: "long"}
    counts = df.groupBy(*keys).agg(*[F.count_if(F.col(signal) == s).alias(f"_{name}") for s, name in labels.items()])
    items = F.array(*[
        F.struct(F.lit(s).alias("signal"), F.lit(name).alias("label"), F.col(f"_{name}").alias("days"))
        for s, name in labels.items()
    ])
    return counts.select(*keys, F.explode(items).alias("i")).select(*keys, "i.*")


def return_stats(curve: DataFrame, keys: Sequence[str] = (), name: str = "strategy_return") -> DataFrame:
    r = F.coalesce(F.col(name), F.lit(0.0))
    return curve.groupBy(*keys).agg(
        F.avg(r).alias("mean"), F.stddev_pop(r).alias("std"), F.count_if(r != 0).alias("non_zero_days")
    )


def table_summary(df: DataFrame, name: str, date: str = "date") -> DataFrame:
    dated = date in df.columns
    return df.agg(
        F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"),
        (F.min(date) if dated else F.lit(None).cast("date")).alias("date_start"),
        (F.max(date) if dated else F.lit(None).cast("date")).alias("date_end"),
    )
