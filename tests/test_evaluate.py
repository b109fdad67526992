import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelmill.operators import metrics as E
from panelmill.operators import quality as Q
from panelmill.operators import ranks as R
from panelmill.operators import signals as G
from panelmill.operators import tuning as T


def frame(spark, y, pred, key="A"):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(len(y))]
    return spark.createDataFrame([(key, d, float(a), float(b)) for d, a, b in zip(days, y, pred)], "k string, date date, y double, pred double")


def curve(spark, y, pred, thr, cost=0.0):
    return G.strategy_curve(frame(spark, y, pred), ["k"], G.threshold_signal(F.col("pred"), thr), cost_bps=cost)


def numpy_metrics(y, signal, cost_bps):
    y, signal = np.asarray(y, float), np.asarray(signal, float)
    turnover = np.abs(np.diff(np.r_[0, signal]))
    r = signal * y - cost_bps / 1e4 * turnover
    eq = np.exp(np.cumsum(r))
    act = signal != 0
    return {
        "total_return": eq[-1] - 1, "cagr": eq[-1] ** (252 / len(r)) - 1, "sharpe": r.mean() / r.std() * math.sqrt(252) if r.std() > 0 else 0.0,
        "max_drawdown": (eq / np.maximum.accumulate(eq) - 1).min(), "exposure": act.mean(), "turnover_total": turnover.sum(),
        "turnover_avg": turnover.mean(), "transaction_cost_total": cost_bps / 1e4 * turnover.sum(),
        "hit_rate": (np.sign(y[act]) == np.sign(signal[act])).mean() if act.any() else 0.0,
    }


def test_strategy_metrics(spark):
    rng = np.random.default_rng(17)
    y, p = rng.normal(0, 0.013, 40).tolist(), rng.normal(0, 0.02, 40).tolist()
    c = curve(spark, y, p, 0.011, 7)
    got = G.strategy_metrics(c, ["k"]).first().asDict()
    want = numpy_metrics(y, [int(np.sign(v)) if abs(v) > 0.011 else 0 for v in p], 7)
    assert c.count() == 40
    for name, value in want.items():
        assert got[name] == pytest.approx(value, rel=1e-12), name


def test_turnover_and_cost(spark):
    held = [0, -3, -3, 0, 0, 4, -2, 5]  # signals 0, -1, -1, 0, 0, 1, -1, 1
    c = curve(spark, [0] * 8, held, 1.5, 25).orderBy("date").collect()
    assert [r.turnover for r in c] == [0, 1, 0, 1, 0, 1, 2, 2]
    assert [r.transaction_cost for r in c] == pytest.approx([0.0025 * r.turnover for r in c])
    flat = G.strategy_metrics(curve(spark, [0.03, -0.4, 0.2, 0.7], [0.2] * 4, 0.9), ["k"]).first()
    assert (flat.total_return, flat.sharpe, flat.hit_rate, flat.exposure) == (0, 0, 0, 0)


def test_cost_threshold():
    assert G.cost_threshold(10, 1.0) == pytest.approx(0.001)
    assert G.cost_threshold(0, -1) == 0.0
    with pytest.raises(ValueError):
        G.cost_threshold(10, 0)


def selector(spark, low, high, main, **kw):
    df = spark.createDataFrame(list(zip(range(len(main)), low, high, main)), "i int, lo double, hi double, m double")
    col = G.selector_signal(F.col("m"), F.col("lo"), F.col("hi"), **kw)
    return [r.s for r in df.select("i", col.alias("s")).orderBy("i").collect()]


def numpy_selector(low, high, main, thr=0.0, band=None, widest=None):
    out = []
    for a, b, m in zip(low, high, main):
        ok = all(v is not None and math.isfinite(v) for v in (a, b, m)) and (widest is None or b - a <= widest)
        side = 0 if not ok else 1 if m > thr else -1 if m < -thr else 0
        floor, top = (0, 0) if band is None else (-band, band)
        out.append(side if (side == 1 and a > floor) or (side == -1 and b < top) else 0)
    return out


def test_selector(spark):
    rng = np.random.default_rng(23)
    main = rng.normal(0, 0.01, 60)
    low, high = main - rng.uniform(0, 0.02, 60), main + rng.uniform(0, 0.02, 60)
    low[7], main[11], high[13] = math.nan, math.inf, math.nan
    low, high, main = low.tolist(), high.tolist(), main.tolist()
    low[19] = None
    for band, widest in ((0.004, None), (0.012, None), (0.006, 0.015), (None, None)):
        got = selector(spark, low, high, main, threshold=0.003, thr_min=(band or 0) / 2, risk_multiple=2.0, use_cost_rule=band is not None, max_width=widest)
        assert got == numpy_selector(low, high, main, 0.003, band, widest) and len(set(got)) == 3
    for bad in (dict(risk_multiple=-2.0), dict(max_width=-0.1)):
        with pytest.raises(ValueError):
            selector(spark, [0.0], [0.0], [0.0], **bad)


def numpy_tune(y, p, quantiles, cost, floor):
    found = {}
    for q in quantiles:
        found.setdefault(round(max(float(np.quantile(np.abs(p), q)), floor), 12), q)
    if floor > 0:
        for m in (1, 1.25, 1.5, 2, 3):
            found.setdefault(round(floor * m, 12), None)
    rows = []
    for t in sorted(found or {round(floor, 12): None}):
        s = np.where(p > t, 1, np.where(p < -t, -1, 0))
        m = numpy_metrics(y, s, cost)
        rows.append((round(m["sharpe"], 10), round(m["cagr"], 10), t))
    best = sorted(rows, key=lambda r: (-r[0], -r[1], r[2]))[:3]
    return min(r[2] for r in best), len(rows)


def test_thresholds_match_brute_force(spark):
    rng = np.random.default_rng(5)
    frames, want = [], {}
    for key in "ABC":
        y, p = rng.normal(0, 0.01, 60), rng.normal(0, 0.01, 60)
        frames.append(frame(spark, y, p, key))
        want[key] = numpy_tune(y, p, T.QUANTILES, 10, 0.004)
    df = frames[0].union(frames[1]).union(frames[2])
    chosen, table = T.tune_threshold(df, ["k"], cost_bps=10.0, min_threshold=0.004)
    assert {r.k: (r.threshold, 0) for r in chosen.collect()} == {k: (pytest.approx(v[0]), 0) for k, v in want.items()}
    assert {r.k: r["count"] for r in table.groupBy("k").count().collect()} == {k: v[1] for k, v in want.items()}


def test_threshold_floor(spark):
    rng = np.random.default_rng(29)
    df = frame(spark, rng.normal(0, 0.01, 25), rng.normal(0, 0.007, 25))
    chosen, table = T.tune_threshold(df, ["k"], min_threshold=0.0065)
    assert chosen.first().threshold >= 0.0065 and table.agg(F.min("threshold")).first()[0] >= 0.0065
    only = T.threshold_table(df, ["k"], quantiles=(), min_threshold=0.0).collect()
    assert [r.threshold for r in only] == [0.0]


def test_scale_choice(spark):
    rng = np.random.default_rng(31)
    y = (0.02 * np.sign(rng.normal(size=30)) + rng.normal(0, 0.002, 30)).tolist()
    weak = [math.copysign(0.0007, v) for v in y]  # right, but below every threshold unless scaled
    opts = dict(quantiles=(0.5,), cost_bps=3.0, min_threshold=0.004)
    got = T.choose_scale(frame(spark, y, weak), ["k"], (1.0, 3.0, 5.0, 7.0, 11.0), **opts).first()
    assert got.scale == 7.0 and got.val_strategy_exposure == 1  # 5 x 0.0007 is below 0.004; equal scores do not replace 7


def test_candidate_score_and_choice(spark):
    cols = ["val_strategy_sharpe", "sp", "pe", "gap", "ratio", "std", "exp"]
    df = spark.createDataFrame([(0.5, .02, .02, .01, .2, .01, .5), (0.5, .02, .02, .01, .008, .01, .5), (9.0, 0., 0., 0., .5, 1e-6, .1)], cols)
    scores = [r.s for r in df.select(T.candidate_score(*[F.col(c) for c in cols]).alias("s")).collect()]
    assert scores[0] - scores[1] == pytest.approx(0.60)
    assert scores[2] == pytest.approx(0.7 * 3 - 0.5 - 0.2)
    table = spark.createDataFrame([(0, 5.0, .001, .01), (1, 1.0, .5, .01), (2, .5, .6, .01)], "candidate_id int, score double, val_pred_to_y_std_ratio double, val_pred_std double")
    picked = T.select_candidate(table, F.lit(1.0)).where("selected").collect()
    assert [r.candidate_id for r in picked] == [1]
    none = T.select_candidate(table.withColumn("val_pred_std", F.lit(0.0)), F.lit(1.0)).where("selected").collect()
    assert [r.candidate_id for r in none] == [0]


def test_regression_metrics(spark):
    v = np.random.default_rng(37).normal(0, 0.02, 9).tolist()
    got = E.regression_metrics(frame(spark, v, v), ["k"]).first()
    assert got.ic_pearson > .99 and got.ic_spearman > .99 and got.mae == 0
    flat = E.regression_metrics(frame(spark, v, [0.3] * 9), ["k"]).first()
    assert flat.ic_pearson == 0 and flat.ic_spearman == 0
    flat = E.regression_metrics(frame(spark, v, [0.3] * 9), [], daily=False).first()
    assert flat.ic_pearson == 0 and flat.ic_spearman == 0


def test_sanity_collapse(spark):
    rng = np.random.default_rng(41)
    df = frame(spark, rng.normal(0, 0.02, 12), rng.normal(0, 1e-4, 12))
    both = df.withColumn("split", F.lit("val")).union(df.withColumn("split", F.lit("test")))
    assert E.sanity_checks(both, ["k"]).first().pred_collapse_warning is True
    assert E.sanity_checks(both, [], daily=False).first().pred_collapse_warning is True


def test_direction(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "y_dir int, pred_dir int")
    got = E.direction_metrics(df, []).first()
    assert got.accuracy == pytest.approx(0.6) and got.balanced_accuracy == pytest.approx((0.5 + 2 / 3) / 2)
    assert E.direction_metrics(df.where("y_dir = 1"), []).first().balanced_accuracy == pytest.approx(0.5)


def test_rank_correlation_of_large_groups_with_hot_ties(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": ["a"] * 600 + ["b"] * 30, "x": rng.integers(0, 4, 630).astype(float), "y": rng.normal(size=630)})
    pdf.loc[5, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.nanvl("x", F.lit(None)))
    got = {r.g: r.spearman for r in R.rank_correlation(df, ["g"], "x", "y").collect()}
    for g, part in pdf.dropna().groupby("g"):
        assert got[g] == pytest.approx(part.x.rank().corr(part.y.rank()), abs=1e-12)


def test_exact_quantiles(spark):
    rng = np.random.default_rng(2)
    v = np.r_[rng.normal(size=400), np.full(300, 0.25), np.full(5, -9.0)]
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    probs = [0, 0.01, 0.3, 0.5, 0.61, 0.9, 1]
    assert R.exact_quantiles(df, F.col("v"), probs) == pytest.approx(list(np.quantile(v, probs)))
    assert R.exact_quantiles(df.where("v > 99"), F.col("v"), [0.5]) == [0.0]


@pytest.mark.parametrize("v", [np.linspace(-1, 1, 301), np.array([2.0, 2.0]), np.array([0.1 * i for i in range(61)])])
def test_histogram_equals_numpy(spark, v):
    got = E.histogram(spark.createDataFrame(pd.DataFrame({"v": v})), "v").orderBy("bin").toPandas()
    n, edges = np.histogram(v, bins=60)
    assert got.n.tolist() == n.tolist()
    np.testing.assert_allclose(got.left_edge, edges[:-1], atol=1e-12)


def test_fold_summary_and_missing(spark):
    folds = spark.createDataFrame([(1, 1.0, None), (2, 3.0, 4.0)], "fold int, a double, b double")
    got = {r.metric: (r.mean, r.median, r.std, r.min, r.max) for r in E.fold_summary(folds).collect()}
    assert got == {"a": (2, 2, 1, 1, 3), "b": (4, 4, 0, 4, 4)}
    assert [(r["column"], r.missing_ratio) for r in E.missing_ratio(folds, 1).collect()] == [("b", 0.5)]
    assert E.missing_ratio(folds, only_missing=True).count() == 1


def test_profiles(spark):
    a = spark.createDataFrame([("2020-01-01",), ("2020-01-05",), ("2020-01-05",)], "date string")
    b = spark.createDataFrame([("2021-01-01",)], "ts string")
    rep = Q.quality_report({"a": a, "b": b, "c": None}, spark)
    prof = {r.name: r for r in rep["profiles"].collect()}
    assert prof["a"].duplicate_dates == 1 and prof["c"].status == "missing_or_unsupported" and prof["b"].date_col == "ts"
    assert rep["common_window"].first().status == "empty_intersection"
    assert Q.common_window(rep["profiles"].where("name = 'c'")).first().status == "unavailable"
    seq = spark.createDataFrame([(i, (i * 7) % 50) for i in range(50)], "s int, d int")
    want = sum(1 for i in range(1, 50) if (i * 7) % 50 < ((i - 1) * 7) % 50)
    assert Q.is_ordered(seq, "s", "d").first().out_of_order == want


@pytest.mark.parametrize("holes", [False, True])
def test_top_correlations(spark, holes):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"y": rng.normal(size=300), "flat": 1.0})
    pdf["a"] = pdf.y + rng.normal(size=300)
    pdf["b"] = (-pdf.y * 3).round()
    pdf["c"] = rng.integers(0, 2, 300)
    df = spark.createDataFrame(pdf)
    if holes:
        pdf.loc[pdf.index % 7 == 0, "a"] = np.nan
        df = spark.createDataFrame(pdf).withColumn("a", F.nanvl("a", F.lit(None)))
    got = [(r.feature, r.spearman) for r in R.top_correlations(df, "y", ["flat", "a", "b", "c"], 2).collect()]
    want = {c: pdf[[c, "y"]].dropna().rank().corr().iloc[0, 1] for c in "abc"}
    assert [c for c, _ in got] == ["b", "a"]
    assert dict(got) == pytest.approx({c: want[c] for c in "ba"})


def test_rank_forms_agree_on_missing_values(spark):
    data = [("A", 1, 0.3, 0.1), ("A", 2, None, 0.9), ("A", 3, 0.1, None), ("A", 4, 0.2, 0.05), ("A", 5, 0.5, 0.4), ("A", 6, None, None)]
    df = spark.createDataFrame(data, "k string, day int, y double, pred double")
    daily, pooled = (E.regression_metrics(df, ["k"], daily=d).first().ic_spearman for d in (True, False))
    assert daily == pytest.approx(pooled) and daily == pytest.approx(1.0)
