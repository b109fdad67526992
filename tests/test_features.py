import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelmill.operators import features as X
from panelmill.operators import splits as P
from panelmill.plans.dataset import build_dataset


def daily(n):
    rng = np.random.default_rng(n)
    close = 40 * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
    spread = rng.uniform(0.001, 0.03, (2, n))
    return pd.DataFrame({
        "date": pd.bdate_range("2021-03-15", periods=n).date, "open": close * (1 + rng.normal(0, 0.004, n)), "high": close * (1 + spread[0]),
        "low": close * (1 - spread[1]), "close": close, "volume": rng.integers(300, 9000, n).astype(float),
        "close_idx": 800 + np.cumsum(rng.normal(0, 7, n)), "close_fx": 1.1 + np.cumsum(rng.normal(0, 0.004, n)), "dividend_flag_t": 0, "k": "A",
    })


def test_features_match_pandas(spark):
    pdf = daily(80)
    df = X.make_target(X.make_features(spark.createDataFrame(pdf), ["k"], ["idx", "fx"]), ["k"])
    got = df.orderBy("date").toPandas()
    r = pdf.close.pct_change()
    np.testing.assert_allclose(got.ret_5.astype(float), pdf.close.pct_change(5), rtol=1e-12)
    np.testing.assert_allclose(got.volatility_10.astype(float), r.rolling(10).std(), rtol=1e-9)
    np.testing.assert_allclose(got.momentum_20.astype(float), r.rolling(20).mean(), rtol=1e-9)
    np.testing.assert_allclose(got.ret_fx_vol_20.astype(float), pdf.close_fx.pct_change().rolling(20).std(), rtol=1e-7)
    np.testing.assert_allclose(got.y.astype(float), np.log(pdf.close.shift(-1) / pdf.close), rtol=1e-12)
    assert "close_fx" not in got.columns
    dates = pd.to_datetime(pdf.date)
    assert got.day_of_week.tolist() == dates.dt.dayofweek.tolist()
    assert got.is_month_end.tolist() == dates.dt.is_month_end.astype(int).tolist()


def test_final_length_is_rows_less_21(spark):
    df = X.make_features(spark.createDataFrame(daily(80)), ["k"], ["idx", "fx"])
    out = X.finalize(X.drop_last_row(X.make_target(df, ["k"]), ["k"]))
    assert out.count() == 80 - 21
    assert out.where("y is null").count() == 0


def test_two_series_equal_one_series_each(spark):
    a, b = daily(60), daily(60)
    b["k"], b["close"] = "B", b.close[::-1].values
    both = X.make_features(spark.createDataFrame(pd.concat([a, b])), ["k"]).where("k = 'B'").orderBy("date").toPandas()
    alone = X.make_features(spark.createDataFrame(b), ["k"]).orderBy("date").toPandas()
    pd.testing.assert_frame_equal(both, alone)


def test_null_inside_window_voids_it_and_zero_price_is_null(spark):
    pdf = daily(30)
    pdf.loc[10, "close"] = 0.0
    got = X.make_features(spark.createDataFrame(pdf), ["k"]).orderBy("date").toPandas()
    assert math.isnan(got.ret_1[10]) and math.isnan(got.ret_1[11]) and not math.isnan(got.ret_1[12])
    assert all(math.isnan(v) for v in got.momentum_5[10:16]) and not math.isnan(got.momentum_5[16])
    assert math.isnan(got.hl_range[10])


def test_target_direction_of_missing_target_is_zero_and_bad_kind_raises(spark):
    df = X.make_target(spark.createDataFrame(daily(31)), ["k"], "simple")
    last = df.orderBy(F.col("date").desc()).first()
    assert last.y is None and last.y_dir == 0
    with pytest.raises(ValueError):
        X.make_target(df, ["k"], "other")


def test_windows_share_one_exchange(spark):
    df = X.make_target(X.make_features(spark.createDataFrame(daily(40)), ["k"]), ["k"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_build_dataset_end_to_end(spark, folder):
    pdf = daily(120).drop(columns=["close_idx", "close_fx", "dividend_flag_t"])
    main = spark.createDataFrame(pdf.astype({"close": str}))
    ctx = spark.createDataFrame(pdf[::3][["date", "close"]])
    cal = spark.createDataFrame(pdf[:100][["date"]])
    div = spark.createDataFrame(pd.DataFrame({"record_date": [pdf.date[60], pdf.date[60]], "amount": [0.0, None]}))
    out = build_dataset(main, ["k"], {"idx": ctx}, cal, div, output=f"{folder}/ds.parquet")
    back = spark.read.parquet(f"{folder}/ds.parquet")
    assert back.count() == out.count() > 0
    day = out.where(F.col("date") == pdf.date[60]).first()
    assert day.dividend_amount_t == 2.0 and day.dividend_flag_t == 1  # a zero and a missing amount count 1 each
    assert out.agg(F.max("date")).first()[0] == pdf.date[98]  # the calendar ends at row 99
    assert {r[0] for r in out.select("context_age_days_idx").distinct().collect()} <= {0.0, 1.0, 2.0, 3.0, 4.0, 5.0}


def test_time_split_is_ordered_and_complete(spark):
    df = spark.createDataFrame(daily(80)).select("k", "date")
    got = P.time_split(df).groupBy("split").agg(F.count("*").alias("n"), F.min("date").alias("a"), F.max("date").alias("b"))
    s = {r["split"]: r for r in got.collect()}
    assert [s[x].n for x in ("train", "val", "test")] == [56, 12, 12]
    assert s["train"].b < s["val"].a and s["val"].b < s["test"].a
    per_key = P.time_split(df, per_key=["k"]).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in per_key} == {"train": 56, "val": 12, "test": 12}


def test_time_split_errors(spark):
    df = spark.createDataFrame(daily(20)).select("k", "date")
    with pytest.raises(ValueError):
        P.time_split(df, ratios=(0.5, 0.3, 0.3))
    with pytest.raises(ValueError):
        P.time_split(df, ratios=(1.0, 0.0, 0.0))
    with pytest.raises(Exception, match="too few dates"):
        P.time_split(df).collect()


@pytest.mark.parametrize("expanding", [True, False])
def test_walk_forward_matches_slices(spark, expanding):
    df = spark.createDataFrame(daily(260)).select("date")
    layout = P.FoldLayout(100, 40, 40, 40, 6)
    got = P.walk_forward(df, layout, expanding).toPandas()
    dates = sorted(daily(260).date)
    assert sorted(got.fold.unique()) == [1, 2, 3]
    for f in (1, 2, 3):
        start = 0 if expanding else (f - 1) * 40
        cut = 100 + (f - 1) * 40
        want = {"train": dates[start:cut], "val": dates[cut:cut + 40], "test": dates[cut + 40:cut + 80]}
        for name, days in want.items():
            assert sorted(got[(got.fold == f) & (got.split == name)].date) == days


def test_fold_layout():
    assert P.fold_layout(500, 6, 0.15, 0.15, None, 120) == P.FoldLayout(290, 75, 75, 12, 6)
    assert P.fold_layout(400, 6, 0.15, 0.15, None, 252) == P.FoldLayout(260, 60, 60, 10, 3)
    for bad in (dict(n=120, folds=1, val_ratio=0.3, test_ratio=0.3), dict(n=400, folds=0, val_ratio=0.1, test_ratio=0.1),
                dict(n=400, folds=2, val_ratio=0.1, test_ratio=0.1, step_size=0)):
        with pytest.raises(ValueError):
            P.fold_layout(**bad)
