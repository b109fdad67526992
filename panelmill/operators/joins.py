"""As-of, calendar, dividend and fold joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from panelmill.session import materialise

# Fixed value: age, in days, of a context row that does not exist.
NO_CONTEXT_AGE = 10000.0


def by_day(df: DataFrame) -> DataFrame:
    """Broadcast hint for a table with one row per calendar day.

    Such a table is bounded by its key: a decade is 3,653 rows, and the whole DATE domain 3.7 million.
    Everything else is joined without a hint, so Spark broadcasts only what it has measured.
    """
    return F.broadcast(df)


def asof_by_day(left: DataFrame, right: DataFrame, values: Sequence[str], on: str = "date", out: str = "_asof") -> DataFrame:
    """Last ``right`` row at or before each left day, for a context without keys (one row per day).

    Each context row is spread over the days it stays valid, which turns the as-of join into a broadcast
    equi-join: the left side is neither shuffled nor sorted. Days after the last context row look it up
    under its own date. The day-level context is stored: it is small, and read here twice.
    """
    right = materialise(right.select(on, *values), "context")
    carried = F.struct(F.col(on), *values)
    spread = right.select(
        F.col(on).alias("_from"), carried.alias(out),
        F.lead(on).over(Window.orderBy(on)).alias("_next"),
    )
    until = F.coalesce(F.date_sub("_next", 1), F.col("_from"))
    dense = spread.select(F.explode(F.sequence("_from", until)).alias("_day"), out)
    last = right.agg(F.max(on)).scalar()
    probe = left.withColumn("_day", F.least(F.col(on), last))
    return probe.join(by_day(dense), "_day", "left").drop("_day")


def asof_by_key(
    left: DataFrame, right: DataFrame, by: Sequence[str], values: Sequence[str], on: str = "date",
    out: str = "_asof", chunk: str = "month",
) -> DataFrame:
    """As-of join inside each key, for daily or finer ``on``.

    Two levels, so that no task needs a whole key: inside a (key, chunk of time) the last context row so
    far, and across chunks the last context row of any earlier chunk.
    """
    slot = F.date_trunc(chunk, F.col(on))
    row = F.struct(F.col(on), *values)
    a = left.withColumn("_slot", slot).withColumn("_side", F.lit(1))
    b = right.select(*by, on, row.alias("_ctx")).withColumn("_slot", slot).withColumn("_side", F.lit(0))

    inside = Window.partitionBy(*by, "_slot").orderBy(on, "_side").rowsBetween(Window.unboundedPreceding, 0)
    near = (
        a.unionByName(b, allowMissingColumns=True)
        .withColumn("_near", F.last("_ctx", ignorenulls=True).over(inside))
        .where("_side = 1").drop("_ctx", "_side")
    )

    slots = a.select(*by, "_slot").distinct().join(
        b.groupBy(*by, "_slot").agg(F.max_by("_ctx", on).alias("_last")), [*by, "_slot"], "full_outer"
    )
    earlier = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carry = slots.select(*by, "_slot", F.last("_last", ignorenulls=True).over(earlier).alias("_far"))
    return (
        near.join(carry, [*by, "_slot"], "left")
        .withColumn(out, F.coalesce("_near", "_far")).drop("_near", "_far", "_slot")
    )


def merge_context(
    base: DataFrame, context: DataFrame, prefix: str, values: Sequence[str], by: Sequence[str] = (), on: str = "date",
) -> DataFrame:
    """As-of merge of context columns plus ``context_age_days_<prefix>``.

    The context row travels as one struct: a null feature of the latest row stays null instead of being
    filled from an older row.
    """
    joined = (
        asof_by_key(base, context, by, values, on) if by else asof_by_day(base, context, values, on)
    )
    age = F.datediff(F.col(on), F.col("_asof").getField(on)).cast("double")
    return joined.select(
        *base.columns,
        *[F.col("_asof").getField(v).alias(v) for v in values],
        F.coalesce(age, F.lit(NO_CONTEXT_AGE)).alias(f"context_age_days_{prefix}"),
    )


def trading_days_only(df: DataFrame, calendar: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows whose date the calendar marks as trading; dates it does not know are dropped."""
    days = calendar.where("is_trading_day").select(*by, "date").distinct()
    return df.join(days if by else by_day(days), [*by, "date"], "left_semi")


def join_dividends(df: DataFrame, dividends: DataFrame | None, keys: Sequence[str] = ()) -> DataFrame:
    """Amount and flag of the day, 0 where there is none (or no dividend source at all)."""
    if dividends is None:
        return df.withColumns({"dividend_amount_t": F.lit(0.0), "dividend_flag_t": F.lit(0)})
    joined = df.join(dividends if keys else by_day(dividends), [*keys, "date"], "left")
    return joined.withColumns({
        "dividend_amount_t": F.coalesce("dividend_amount_t", F.lit(0.0)),
        "dividend_flag_t": F.coalesce("dividend_flag_t", F.lit(0)),
    })


def join_context_closes(main: DataFrame, contexts: dict[str, DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """Main close beside the close of each context on the same date; of several closes of a day the largest."""
    out = main.select(*keys, "date", F.col("close").alias("main"))
    for name, ctx in contexts.items():
        out = out.join(by_day(ctx.groupBy("date").agg(F.max("close").alias(name))), "date", "left")
    return out
