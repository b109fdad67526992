import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelmill.functions import feature_columns
from panelmill.models import Forest, Spec, add_direction, bin_rows, candidate_grid, feature_importance, fit_candidates, fit_forests, fit_logistic, fit_ridge, score_forests
from panelmill.models import boosting
from panelmill.queries import QUERIES, modelling
from panelmill.sources.writers import load_json
from panelmill.plans import training
from panelmill.plans.report import artifact_summary, compact_report, deep_diagnostics
from panelmill.plans.training import TrainConfig, latest_signal, signal_rows, train_and_evaluate

N = 400
RNG = np.random.default_rng(7)
X = np.c_[RNG.normal(size=N), RNG.normal(2, 5, N), np.full(N, 3.0)]
X[:, 1] += 3 * X[:, 0]
Y = X[:, 0] - 0.2 * X[:, 1] + RNG.normal(0, 1, N)


@pytest.fixture(scope="module")
def data(spark):
    pdf = pd.DataFrame({"i": range(N), "a": X[:, 0], "b": X[:, 1], "c": X[:, 2], "y": Y, "y_dir": (Y > 0).astype(int)})
    return spark.createDataFrame(pdf).repartition(3).cache()


def standard():
    z = X[:, :2]
    return (z - z.mean(0)) / z.std(0)


@pytest.mark.parametrize("alpha", [1.0, 100.0])
def test_ridge_equals_closed_form(data, alpha):
    z = standard()
    w = np.linalg.solve(z.T @ z + alpha * np.eye(2), z.T @ (Y - Y.mean()))
    got = fit_ridge(data, ["a", "b", "c"], alpha=alpha).transform(data).orderBy("i").toPandas()
    np.testing.assert_allclose(got.pred_ridge, z @ w + Y.mean(), atol=1e-9)


def test_logistic_equals_newton(data):
    z = np.c_[np.ones(N), standard()]
    d, w = (Y > 0).astype(float), np.zeros(3)
    pen = np.diag([0.0, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + pen, z.T @ (p - d) + pen @ w)
    got = add_direction(fit_logistic(data, ["a", "b", "c"]).transform(data)).orderBy("i").toPandas()
    np.testing.assert_allclose(got.pred_logreg_score, 1 / (1 + np.exp(-z @ w)) - 0.5, atol=1e-4)
    assert (got.pred_logreg_dir == (got.pred_logreg_score > 0)).all()


def test_missing_feature_fails(spark, data):
    with pytest.raises(Exception):
        fit_ridge(data.withColumn("a", F.when(F.col("i") > 3, F.col("a"))), ["a", "b"])


def test_grid():
    grid = candidate_grid()
    assert len(grid) == 12
    assert {g["learning_rate"] for g in grid} == {0.03, 0.02} and {g["min_child_rows"] for g in grid} == {15, 30, 60}


def binned(df, features, held=None, bins=64):
    held = F.lit(0) if held is None else held.cast("int")
    return bin_rows(df, features, "y", 1 - held, held, bins)


def test_trees_and_importance(spark, data):
    rows = data.withColumn("is_val", F.col("i") % 5 == 0)
    grid = [{"learning_rate": 0.3, "max_depth": d, "min_child_rows": 15, "num_leaves": 6} for d in (2, 3)]
    models = fit_candidates(rows, ["a", "b", "c"], grid, rounds=5)
    assert sorted(models) == [0, 1]
    top = feature_importance(models[1], ["a", "b", "c"], spark, 2).collect()
    assert len(top) == 2 and {r.feature for r in top} == {"a", "b"} and models[1].importance().sum() == pytest.approx(1)
    assert feature_importance(models[1], ["a"], spark) is None and feature_importance(object(), ["a"], spark) is None


def plain_tree(codes, grad, spec):
    """(prediction of each row, leaves) of one tree: every split of every node tried, the best one taken, until no leaf is left to split."""
    leaves = [(np.arange(len(grad)), 0)]

    def best(rows, depth):
        found = (0, None)
        if depth < spec.depth:
            g, n = grad[rows].sum(), len(rows)
            for f in range(codes.shape[1]):
                for b in range(codes.max()):
                    left = codes[rows, f] <= b
                    m = left.sum()
                    if m >= spec.least and n - m >= spec.least:
                        gl = grad[rows][left].sum()
                        gain = gl**2 / (m + spec.penalty) + (g - gl) ** 2 / (n - m + spec.penalty) - g**2 / (n + spec.penalty)
                        if gain > found[0] + 1e-12:
                            found = (gain, (f, b))
        return found

    while len(leaves) < spec.leaves:
        tries = [(best(rows, depth), k) for k, (rows, depth) in enumerate(leaves)]
        (gain, cut), k = max(tries, key=lambda t: t[0][0])
        if cut is None:
            break
        rows, depth = leaves.pop(k)
        left = codes[rows, cut[0]] <= cut[1]
        leaves += [(rows[left], depth + 1), (rows[~left], depth + 1)]
    out = np.zeros(len(grad))
    for rows, _ in leaves:
        out[rows] = -spec.rate * grad[rows].sum() / (len(rows) + spec.penalty)
    return out, len(leaves)


@pytest.mark.parametrize(("leaves", "depth"), [(3, 9), (31, 2), (7, 4)])
def test_trees_equal_a_plain_search(data, leaves, depth):
    spec = Spec(0.5, depth, 12, leaves, rounds=3, column_share=1.0, penalty=2.0)
    rows = binned(data, ["a", "b", "c"], bins=12)
    forest = fit_forests(rows, [spec])[0]
    x = X.copy()
    codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(rows.cuts)], 1)
    score = np.full(N, Y.mean())
    for t in range(3):
        step, count = plain_tree(codes, score - Y, spec)
        end = forest.roots[t + 1] if t + 1 < forest.trees else len(forest.feature)
        assert (forest.feature[forest.roots[t]: end] < 0).sum() == count <= leaves
        score += step
    np.testing.assert_allclose(forest.predict(x), score, atol=1e-9)


def test_lockstep_equals_one_task_per_model(data, monkeypatch):
    monkeypatch.setattr(boosting, "CHUNK", 37)
    monkeypatch.setattr(boosting, "ADVANCE", 2)
    held = F.col("i") % 4 == 0
    rows = binned(data, ["a", "b", "c"], held)
    specs = [Spec(0.3, 3, 15, 6, rounds=7, patience=2), Spec(0.2, 2, 30, rounds=5, row_share=0.7, column_share=0.6), Spec(0.3, 2, 20, alpha=0.9, rounds=4)]
    for one, two in zip(fit_forests(rows, specs), fit_forests(rows, specs, block=1)):
        assert one.trees == two.trees > 0
        np.testing.assert_allclose(one.loss, two.loss, rtol=1e-9)
        np.testing.assert_allclose(one.predict(X), two.predict(X), atol=1e-9)


def test_masks_fit_only_their_rows(data):
    """Two sets of rows over one binned table give what each gives on a table of its own."""
    early, late = F.col("i") < 200, F.col("i") >= 150
    both = bin_rows(data, ["a", "b"], "y", early.cast("int") + 2 * late.cast("int"), F.lit(0))
    got = fit_forests(both, [Spec(0.3, 2, 15, bit=b, rounds=3, column_share=1.0) for b in (0, 1)])
    assert got[0].base == pytest.approx(Y[:200].mean()) and got[1].base == pytest.approx(Y[150:].mean())
    codes = np.stack([np.searchsorted(c, X[:, j], side="left") for j, c in enumerate(both.cuts)], 1)
    for forest, rows in zip(got, (np.arange(200), np.arange(150, N))):
        score = np.full(len(rows), Y[rows].mean())
        for _ in range(3):
            score += plain_tree(codes[rows], score - Y[rows], Spec(0.3, 2, 15))[0]
        np.testing.assert_allclose(forest.predict(X[rows]), score, atol=1e-9)


def test_quantile_coverage_and_reload(spark, data, folder):
    low, high = fit_forests(binned(data, ["a", "b", "c"]), [Spec(0.3, 3, 20, alpha=a, rounds=12) for a in (0.1, 0.9)])
    scored = score_forests(data, {"low": low, "high": high})
    got = scored.agg(*[F.avg((F.col("y") <= F.col(c)).cast("double")) for c in ("low", "high")]).first()
    assert 0.05 <= got[0] <= 0.15 and 0.85 <= got[1] <= 0.95
    high.save(spark, f"{folder}/q")
    again = Forest.load(spark, f"{folder}/q")
    assert again.features == ["a", "b", "c"] and (again.predict(X) == high.predict(X)).all()
    assert again.transform(scored, "q2").where("high <> q2").count() == 0


def test_a_missing_value_fails_the_fit_and_the_score(data):
    torn = data.withColumn("a", F.when(F.col("i") > 3, F.col("a")))
    with pytest.raises(Exception, match="a feature is missing"):
        binned(torn, ["a", "b"])
    forest = fit_forests(binned(data, ["a", "b"]), [Spec(0.3, 2, 20, rounds=1)])[0]
    with pytest.raises(Exception, match="a feature is missing"):
        forest.transform(torn).collect()


def test_plan_of_a_score_does_not_grow_with_the_trees(spark, data):
    few, many = fit_forests(binned(data, ["a", "b"]), [Spec(0.05, 2, 10, rounds=r) for r in (2, 60)])
    plans = [f.transform(data)._jdf.queryExecution().executedPlan().toString() for f in (few, many)]
    assert many.trees == 60 and len(plans[0].split("\n")) == len(plans[1].split("\n"))


def test_feature_columns(data):
    assert feature_columns(data, ["i"]) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        feature_columns(data.select("i", "y"), ["i"])


def test_trees_do_not_depend_on_the_unit_of_the_target(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 2))
    y = 0.01 * (x[:, 0] + np.sin(3 * x[:, 1]))
    base = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y, "is_val": np.arange(400) % 4 == 0}))
    grid = [{"learning_rate": 0.3, "max_depth": 3, "min_child_rows": 5}]
    small, large = (fit_candidates(base.withColumn("y", F.col("y") * u), ["a", "b"], grid, rounds=12)[0] for u in (1.0, 1e4))
    assert small.trees == large.trees > 3
    np.testing.assert_allclose(small.predict(x) * 1e4, large.predict(x), rtol=1e-6)


def test_a_noisy_rise_does_not_end_a_fit_but_patience_does(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(500, 3))
    y = 0.01 * (0.3 * x[:, 0] + rng.normal(size=500))
    rows = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y, "is_val": np.arange(500) % 3 == 0}))
    grid = [{"learning_rate": 0.05, "max_depth": 2, "min_child_rows": 15}]
    long = fit_candidates(rows, list("abc"), grid, rounds=300, patience=300)[0]
    rise = next(i for i in range(1, 300) if long.loss[i] > min(long.loss[:i]))
    best = int(np.argmin(long.loss)) + 1
    assert rise < best == long.trees < 300 == len(long.loss)
    held = x[np.arange(500) % 3 == 0]
    assert ((y[np.arange(500) % 3 == 0] - long.predict(held)) ** 2).mean() == pytest.approx(min(long.loss))
    short = fit_candidates(rows, list("abc"), grid, rounds=300, patience=10)[0]
    assert len(short.loss) == short.trees + 10 and short.loss == pytest.approx(long.loss[: len(short.loss)])


def test_registered_queries_run_the_full_search(spark, monkeypatch):
    """Nothing is fitted: every query is stopped where it hands its settings to the models."""
    class Seen(Exception):
        pass

    def stop(data, specs, block=None):
        raise Seen(specs)

    days = pd.bdate_range("2020-01-01", periods=400)
    panel = spark.createDataFrame(pd.DataFrame({"series": "A", "date": days.date, "y": 0.1, "y_dir": 1, "f1": 1.0}))
    monkeypatch.setattr(modelling, "dataset", lambda *_: panel)
    monkeypatch.setattr(training, "fit_forests", stop)
    monkeypatch.setattr(modelling, "fit_forests", stop)
    for name in ("gbt_select", "quantile_gbt", "feature_importance", "train_evaluate", "walk_forward_run", "model_latest_signal"):
        with pytest.raises(Seen) as seen:
            QUERIES[name](spark, "/root/testdata/sf0.001")
        specs = seen.value.args[0]
        assert {(s.rounds, s.patience, s.penalty, s.column_share) for s in specs} == {(2500, 120, 0.5, 0.85)}, name
        assert len(specs) == 12 * (6 if name == "walk_forward_run" else 1) and len({s.bit for s in specs}) == len(specs) // 12, name
        assert {(s.rate, s.leaves, s.depth, s.least) for s in specs} == {tuple(g.values()) for g in candidate_grid()}
    assert len(modelling.CONFIG.scales) == 6 and modelling.CONFIG.folds == 6


def test_config_checks():
    for bad in (dict(alpha_low=0.9), dict(risk_multiple=0), dict(max_width=-1.0)):
        with pytest.raises(ValueError):
            TrainConfig(**bad).check()


def test_latest_signal_uses_scale(spark):
    row = spark.createDataFrame([("A", "2026-02-19", 0.3, 2.0, 0.5)], "k string, date string, prediction_raw double, prediction_scale double, threshold double")
    got = signal_rows(row, ["k"]).first()
    assert got.prediction == pytest.approx(0.6) and got.signal == 1 and got.signal_label == "long"


def test_full_run_saves_and_reloads(spark, folder):
    days = pd.bdate_range("2020-01-01", periods=220)
    rng = np.random.default_rng(3)
    parts = []
    for k in ("A", "B"):
        f1, f2 = rng.normal(size=220), rng.normal(size=220)
        y = 0.01 * f1 + rng.normal(0, 0.01, 220)
        parts.append(pd.DataFrame({"k": k, "date": days.date, "f1": f1, "f2": f2, "y": y, "y_dir": (y > 0).astype(int)}))
    df = spark.createDataFrame(pd.concat(parts))
    grid = ({"learning_rate": 0.3, "max_depth": 2, "min_child_rows": 15},)
    cfg = TrainConfig(cost_bps=1.0, rounds=3, grid=grid, folds=2, scales=(1.0, 2.0), walk_forward=True)
    out = train_and_evaluate(df, ["k"], cfg, folder)
    assert out.folds.count() == 2 and out.summary.where("metric = 'strategy_main_test_sharpe'").count() == 1
    assert out.split.predictions.count() == 2 * 33
    assert out.split.selection.where("selected").count() == 1
    assert out.split.quality.count() == 2 * 10
    ic = out.split.quality.where("model = 'ridge' and split = 'test'").agg(F.avg("ic_pearson")).first()[0]
    assert ic > 0.4
    got = latest_signal(df, folder).collect()
    assert {r.k for r in got} == {"A", "B"} and all(r.date == days[-1].date() for r in got)
    saved = {r.k: r for r in spark.read.parquet(f"{folder}/data/strategy").collect()}
    for model, threshold, scaled in (
            ("main", "threshold_main", True), ("ridge", "threshold_main", False), ("logreg", "threshold_logreg", False), ("quantile_lower", "threshold_main", False)):
        rows = latest_signal(df, folder, model).collect()
        assert len(rows) == 2 and all(r.threshold == saved[r.k][threshold] for r in rows)
        assert all(r.prediction_scale == (saved[r.k]["prediction_scale"] if scaled else 1.0) for r in rows)
    assert spark.read.option("header", True).csv(f"{folder}/reports/model_quality").count() == 20
    report = load_json(spark, f"{folder}/run_report")
    assert set(report) == {"data", "metrics", "strategy", "selector_config", "sanity_checks", "walk_forward", "feature_columns", "config", "saved_models"}
    assert report["data"]["rows_total"] == 440 and report["config"]["selected_params"] == grid[0] and report["feature_columns"] == ["f1", "f2"]
    assert report["walk_forward"]["actual_folds"] == 2 and "strategy_main_test_sharpe" in report["walk_forward"]["summary"]
    assert load_json(spark, f"{folder}/strategy_config") == report["strategy"] and load_json(spark, f"{folder}/metrics") == report["metrics"]
    assert report["strategy"]["threshold_min"] == pytest.approx(cfg.min_threshold) and report["metrics"]["regression"]["ridge"]["test"]["ic_pearson"] == pytest.approx(ic)
    short = compact_report(spark, folder)
    assert {r.section for r in short.collect()} == {"data", "range", "models", "sanity", "walk_forward", "selector", "quality"}
    assert {r.item for r in short.where("section = 'walk_forward'").collect()} == {"sharpe_median", "sharpe_std", "ic_median", "ic_std", "folds"}
    deep = {(r.section, r.item): r.value for r in deep_diagnostics(spark, {"data": df, "none": None}, folder, f"{folder}/deep").collect()}
    assert deep["artifacts", "predictions_rows"] == "66" and deep["artifacts", "model_quality_rows"] == "20" and deep["table", "none.status"] == "missing_or_unsupported"
    assert sum(int(v) for (s, _), v in deep.items() if s == "signals") == 66 and ("prediction_corr", "spearman") in deep
    assert load_json(spark, f"{folder}/deep")["artifacts"]["equity_curve_rows"] == "66"
    gone = {r.item: r.value for r in artifact_summary(spark, f"{folder}/nothing").collect()}
    assert gone == {"model_quality_rows": "0", "predictions_rows": "0", "equity_curve_rows": "0"}


def test_a_report_of_no_run_raises(spark, folder):
    with pytest.raises(Exception):
        compact_report(spark, folder)
