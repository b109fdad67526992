"""Physical plans that must hold at scale."""

import datetime as dt

from pyspark.sql import functions as F

from panelmill.operators import ingest as I
from panelmill.operators import tuning as T
from panelmill.operators.joins import merge_context, trading_days_only
from panelmill.operators.ranks import row_ranks
from panelmill.operators.splits import time_split
from panelmill.session import Stored, clear_scratch, materialise
from panelmill.sources import views as M

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def panel(spark):
    days = spark.range(400).select(F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("date"))
    return materialise(days.select(F.explode(F.array(*[F.lit(k) for k in "ABC"])).alias("k"), "date", F.rand(1).alias("y"), F.randn(2).alias("pred")), "panel")


def test_context_and_calendar_leave_the_panel_unshuffled(spark):
    left = panel(spark)
    ctx = left.where("k = 'A'").select("date", F.col("y").alias("v"))
    joined = trading_days_only(merge_context(left, ctx, "c", ["v"]), ctx.select("date", F.lit(True).alias("is_trading_day")))
    text = plan(joined)
    assert "hashpartitioning(k" not in text and "SortMergeJoin" not in text


def test_split_is_a_filter_free_projection(spark):
    text = plan(time_split(panel(spark)).select("k", "split"))
    assert "Join" not in text and "hashpartitioning(k" not in text


def test_search_has_one_exchange(spark):
    text = plan(T.choose_scale(panel(spark), ["k"], min_threshold=0.001, cost_bps=10.0))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_bars_prune_columns_and_combine_before_the_shuffle(spark):
    text = plan(M.bars(spark, FOLDER).select("series", "date", "volume"))
    assert "partial_sum" in text
    schema = text.split("ReadSchema:")[1].split("\n")[0]
    assert "l_tax" not in schema and "l_extendedprice" not in schema


def test_hot_key_costs_one_row_per_task(spark):
    rows = spark.range(0, 20000, 1, 8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    last = I.dedup_last(rows, ["k"], ["id"])
    assert plan(last).count("WindowGroupLimit") == 2  # once before and once after the exchange
    assert last.where("k = 0").first().id == 19998
    assert last.count() == rows.select("k").distinct().count()


def test_stored_tables_are_deleted(spark):
    one = Stored(spark.range(3).toDF("i"), "gone")
    assert one.df.count() == 3
    one.delete()
    assert one not in Stored.written
    keep = list(Stored.written)
    Stored.written[:] = []
    two = Stored(spark.range(3).toDF("i"), "gone")
    clear_scratch()
    assert two not in Stored.written
    Stored.written[:] = keep


def test_bars_combine_by_hash_without_a_sort(spark):
    for bars in (M.bars(spark, FOLDER), M.bars_5m(spark, FOLDER)):
        text = plan(bars)
        assert text.count("HashAggregate") == 2 and "SortAggregate" not in text and "Sort " not in text


def test_packed_numbers_sort_as_their_parts(spark):
    rows = spark.createDataFrame([(2, 0), (1, 99), (1, 100), (10, 5), (0, 999)], "a bigint, b bigint")
    key = M.packed((F.col("a"), 12), (F.col("b"), 3))
    assert [tuple(r) for r in rows.orderBy(key).select("a", "b").collect()] == sorted(tuple(r) for r in rows.collect())


def test_ranks_are_not_joined_on_a_value_and_split_ties(spark):
    n = 4000
    rows = materialise(spark.range(0, n, 1, 8).select(
        (F.col("id") % 2).alias("k"), F.when(F.col("id") % 10 < 9, 7.0).otherwise(F.col("id") / 3).alias("v"), "id"), "tied")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one partition
    try:
        got = row_ranks(rows, ["k"], "v", "r", "id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    joins = [x for x in plan(got).split("\n") if "Join" in x]
    assert joins and all("[v" not in x and ", v" not in x for x in joins)
    pdf = got.toPandas()
    want = pdf.groupby("k").v.rank()
    assert (pdf.r == want).all()
    stored = [s for s in Stored.written if "/ranks-" in s.path][-1].df
    sizes = [r["count"] for r in stored.groupBy("_part").count().collect()]
    assert len(sizes) > 2 and max(sizes) < 0.6 * n  # nine of ten rows have one value
