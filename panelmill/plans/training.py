"""Fit, select, tune and evaluate the models on time splits; walk-forward runs and the latest signal.

A panel figure is the mean over its series, so that a panel of one series gives that series' figure.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from panelmill.functions.columns import feature_columns
from panelmill.models.boosting import ROUNDS, Binned, Forest, Spec, bin_rows, fit_forests, score_forests
from panelmill.models.linear import add_direction, fit_logistic, fit_ridge
from panelmill.models.trees import candidate_grid
from panelmill.operators import metrics as E
from panelmill.operators import signals as G
from panelmill.operators import splits as P
from panelmill.operators import tuning as T
from panelmill.operators.features import latest_rows
from panelmill.operators.ingest import union_all
from panelmill.operators.joins import by_day
from panelmill.operators.reports import model_quality
from panelmill.plans.report import run_report, save_report
from panelmill.session import Stored, materialise
from panelmill.sources.writers import load_json, save_json, save_models, save_tables


@dataclass(frozen=True)
class TrainConfig:
    ratios: tuple[float, float, float] = (0.70, 0.15, 0.15)
    quantiles: tuple[float, ...] = T.QUANTILES
    scales: tuple[float, ...] = T.SCALES
    seed: int = 42
    cost_bps: float = 0.0
    selection_cost_bps: float | None = None
    cost_multiplier: float = 1.0
    walk_forward: bool = True
    folds: int = 6
    expanding: bool = True
    step_size: int | None = None
    use_cost_rule: bool = True
    alpha_low: float = 0.10
    alpha_high: float = 0.90
    risk_multiple: float = 1.0
    max_width: float | None = None
    rounds: int = ROUNDS
    quantile_rounds: int | None = None
    grid: tuple[dict, ...] = field(default_factory=lambda: tuple(candidate_grid()))
    parallelism: int = 3

    def check(self) -> None:
        if not 0 < self.alpha_low < self.alpha_high < 1:
            raise ValueError("alpha_low and alpha_high must satisfy 0 < low < high < 1")
        if self.risk_multiple <= 0:
            raise ValueError("risk_multiple must be > 0")
        if self.max_width is not None and self.max_width <= 0:
            raise ValueError("max_width must be > 0 when provided")

    @property
    def min_threshold(self) -> float:
        return G.cost_threshold(self.cost_bps, self.cost_multiplier)

    @property
    def selection_bps(self) -> float:
        return self.cost_bps if self.selection_cost_bps is None else self.selection_cost_bps


@dataclass
class SplitRun:
    """Models and result tables of one train / validation / test split."""

    features: list[str]
    models: dict[str, object]
    selection: DataFrame | None
    series: DataFrame  # keys, prediction scale, thresholds
    predictions: DataFrame
    curves: dict[str, DataFrame]
    threshold_tables: dict[str, DataFrame]
    quality: DataFrame
    sanity: DataFrame


def _mean(df: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.avg(n).alias(n) for n in names])


def selection_table(stacked: DataFrame, keys: Sequence[str], cfg: TrainConfig, info: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(table, scales)``: scored candidates, and the scale of every (candidate, series).

    ``stacked`` has every candidate's predictions on train and val, so all candidates and series are
    measured in the same few jobs. ``info`` has one row per candidate.
    """
    by = ["candidate_id", "split", *keys]
    quality = E.regression_metrics(stacked, by)
    spread = stacked.groupBy(*by).agg(E.safe_std(F.col("pred")).alias("pred_std"), E.safe_std(F.col("y")).alias("y_std"))
    ratio = F.when(F.col("y_std") <= 0, 0.0).otherwise(F.try_divide("pred_std", "y_std"))
    parts = quality.join(spread, by).withColumn("ratio", ratio)
    minimum = G.cost_threshold(cfg.selection_bps, cfg.cost_multiplier)
    scales = materialise(T.choose_scale(
        stacked.where("split = 'val'"), ["candidate_id", *keys], cfg.scales, cfg.quantiles, cfg.selection_bps, minimum
    ), "scales")
    parts = parts.join(scales, ["candidate_id", *keys])
    on = F.col("split")
    def of(split: str, col: str):  # noqa: E306
        return F.avg(F.when(on == split, F.col(col)))
    per_series = parts.groupBy("candidate_id", *keys).agg(
        of("train", "ic_spearman").alias("train_ic_spearman"), of("val", "ic_spearman").alias("val_ic_spearman"),
        of("val", "ic_pearson").alias("val_ic_pearson"), of("val", "rmse").alias("val_rmse"),
        F.first("val_strategy_sharpe").alias("val_strategy_sharpe"), F.first("val_strategy_exposure").alias("val_strategy_exposure"),
        F.first("threshold").alias("val_strategy_threshold"), F.first("scale").alias("selected_scale"),
        *[(of(s, "pred_std") * F.first("scale")).alias(f"{s}_pred_std") for s in ("train", "val")],
        *[(of(s, "ratio") * F.first("scale")).alias(f"{s}_pred_to_y_std_ratio") for s in ("train", "val")],
        of("val", "y_std").alias("val_y_std"),
    ).withColumn("overfit_gap", F.abs(F.col("train_ic_spearman") - F.col("val_ic_spearman")))
    names = [c for c in per_series.columns if c not in ("candidate_id", *keys)]
    table = _mean(per_series, ["candidate_id"], names)
    score = T.candidate_score(*[F.col(c) for c in (
        "val_strategy_sharpe", "val_ic_spearman", "val_ic_pearson", "overfit_gap", "val_pred_to_y_std_ratio",
        "val_pred_std", "val_strategy_exposure")])
    table = materialise(table.withColumn("score", score).join(info, "candidate_id"), "selection")
    return T.select_candidate(table, F.col("val_y_std")).drop("val_y_std"), scales


def bin_split(df: DataFrame, features: Sequence[str]) -> Binned:
    """Binned rows of one split: bit 0 marks train to fit and val to end the fits."""
    split = F.col("split")
    return bin_rows(df.where("split in ('train', 'val')"), features, "y", (split == "train").cast("int"), (split == "val").cast("int"))


def candidate_specs(cfg: TrainConfig, bit: int = 0) -> list[Spec]:
    return [Spec.of(p, bit=bit, rounds=cfg.rounds, seed=cfg.seed) for p in cfg.grid]


def quantile_specs(cfg: TrainConfig, chosen: int, bit: int = 0) -> list[Spec]:
    """Lower and upper quantile with the settings of the chosen candidate."""
    return [Spec.of(cfg.grid[chosen], bit=bit, rounds=cfg.quantile_rounds or cfg.rounds, seed=cfg.seed, alpha=a) for a in (cfg.alpha_low, cfg.alpha_high)]


def select_model(fit_rows: DataFrame, keys: Sequence[str], cfg: TrainConfig, candidates: Sequence[Forest]) -> tuple[DataFrame, DataFrame]:
    """``(table, scales)``: the scored candidates with the best one first, and the prediction scale of every
    (candidate, series). ``fit_rows`` are the train and val rows."""
    spark = fit_rows.sparkSession
    scored = score_forests(fit_rows, {f"_c{i}": f for i, f in enumerate(candidates)})
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("candidate_id"), F.col(f"_c{i}").alias("pred")) for i in range(len(candidates))]))
    stacked = Stored(scored.select("split", *keys, "date", "y", each.alias("x")).select("x.candidate_id", "split", *keys, "date", "y", "x.pred"), "stacked")
    info = spark.createDataFrame(
        [(i, f.trees, json.dumps(cfg.grid[i])) for i, f in enumerate(candidates)], "candidate_id int, n_iterations int, params string")
    table, scales = selection_table(stacked.df, keys, cfg, info)
    table = materialise(table, "selected")
    stacked.delete()
    return table, scales


def best_first(table: DataFrame) -> DataFrame:
    return table.orderBy(F.col("selected").desc(), F.col("score").desc())


@dataclass
class Choice:
    """The chosen candidate of a split, the scored table and the scales."""

    chosen: int
    table: DataFrame
    scales: DataFrame


def choose(df: DataFrame, keys: Sequence[str], cfg: TrainConfig, candidates: Sequence[Forest]) -> Choice:
    table, scales = select_model(df.where("split in ('train', 'val')"), keys, cfg, candidates)
    return Choice(best_first(table).head()["candidate_id"], best_first(table), scales)


def run_split(df: DataFrame, keys: Sequence[str], cfg: TrainConfig, features: Sequence[str] | None = None) -> SplitRun:
    """Everything on one split. ``df`` has ``split``, ``date``, ``y``, ``y_dir`` and numeric features."""
    keys = list(keys)
    features = list(features or feature_columns(df, keys))
    stored = Stored(df.select(*keys, "date", "split", "y", "y_dir", *features), "split")
    data = bin_split(stored.df, features)
    candidates = fit_forests(data, candidate_specs(cfg))
    choice = choose(stored.df, keys, cfg, candidates)
    lower, upper = fit_forests(data, quantile_specs(cfg, choice.chosen))
    data.chunks.delete()
    run = finish_split(stored.df, keys, cfg, features, choice, {"main": candidates[choice.chosen], "quantile_lower": lower, "quantile_upper": upper})
    stored.delete()
    return run


def finish_split(
    df: DataFrame, keys: Sequence[str], cfg: TrainConfig, features: Sequence[str], choice: Choice, forests: Mapping[str, Forest],
) -> SplitRun:
    """The linear models, thresholds, signals and result tables of a split whose forests are fitted. Reads ``df`` before it returns."""
    train = df.where("split = 'train'")
    models = {"ridge": fit_ridge(train, features), "logreg": fit_logistic(train, features), **forests}
    scale = choice.scales.where(F.col("candidate_id") == choice.chosen).select(*keys, F.col("scale").alias("prediction_scale"))
    scored = score_rows(df.where("split in ('val', 'test')"), models, features, keys).join(scale, keys)
    scored = scored.withColumn("pred_main", F.col("pred_main_raw") * F.col("prediction_scale"))
    scored = materialise(scored, "scored")
    return evaluate_split(scored, keys, cfg, features, models, choice.table)


def evaluate_split(
    scored: DataFrame, keys: Sequence[str], cfg: TrainConfig, features: Sequence[str], models: Mapping[str, object], selection: DataFrame | None = None,
) -> SplitRun:
    """Thresholds, signals, curves and tables of stored predictions on val and test."""
    scale = scored.select(*keys, "prediction_scale").distinct()
    val, test = (scored.where(F.col("split") == s) for s in ("val", "test"))

    tuned, tables = {}, {}
    for name, col in (("main", "pred_main"), ("logreg", "pred_logreg_score")):
        tuned[name], tables[name] = T.tune_threshold(
            val, keys, quantiles=cfg.quantiles, cost_bps=cfg.cost_bps, min_threshold=cfg.min_threshold, pred=col
        )
    series = scale
    for name, table in tuned.items():
        series = series.join(table.withColumnRenamed("threshold", f"threshold_{name}"), keys)
    series = materialise(series.withColumn("threshold_min", F.lit(cfg.min_threshold)), "series")

    test = test.join(series.drop("prediction_scale"), keys)
    test = test.withColumn("selector_signal", G.selector_signal(
        F.col("pred_main"), F.col("pred_quantile_lower"), F.col("pred_quantile_upper"), F.col("threshold_main"),
        cfg.min_threshold, cfg.use_cost_rule, cfg.risk_multiple, cfg.max_width,
    ))
    test = materialise(test, "test")
    rules = {
        "main": ("pred_main", G.threshold_signal(F.col("pred_main"), F.col("threshold_main"))),
        "logreg": ("pred_logreg_score", G.threshold_signal(F.col("pred_logreg_score"), F.col("threshold_logreg"))),
        "selector": ("pred_main", F.col("selector_signal")),
    }
    curves = {
        name: materialise(G.strategy_curve(test, keys, signal, pred=col, cost_bps=cfg.cost_bps), f"curve-{name}")
        for name, (col, signal) in rules.items()
    }
    both = scored.select(*keys, "date", "split", "y", F.col("pred_main").alias("pred"))
    predictions = test.select(
        *keys, "date", "y", "y_dir", "pred_ridge", "pred_main", "pred_main_raw", "pred_logreg_score", "pred_logreg_dir",
        "pred_quantile_upper", "pred_quantile_lower", "selector_signal",
    )
    return SplitRun(
        list(features), models, selection, series, predictions, curves, tables, materialise(quality_table(val, test, curves, keys), "quality"),
        materialise(E.sanity_checks(both, keys), "sanity"),  # both are read by several reports
    )


def score_rows(df: DataFrame, models: Mapping[str, object], features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Predictions of every model in one pass."""
    out = add_direction(models["logreg"].transform(df)).drop("raw_features", "scaled_features")
    out = models["ridge"].transform(out).drop("raw_features", "scaled_features")
    out = score_forests(out, {"pred_main_raw": models["main"], "pred_quantile_lower": models["quantile_lower"], "pred_quantile_upper": models["quantile_upper"]})
    return out.drop(*features)


def quality_table(val: DataFrame, test: DataFrame, curves: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Long table of every model's metrics per split, task and series."""
    def direction(df, col):
        return E.direction_metrics(df, keys, "y_dir", col)

    up = test.withColumn("pred_main_dir", (F.col("pred_main") > 0).cast("int"))
    parts = [
        ("ridge", "val", "regression", E.regression_metrics(val, keys, pred="pred_ridge")),
        ("ridge", "test", "regression", E.regression_metrics(test, keys, pred="pred_ridge")),
        ("main", "val", "regression", E.regression_metrics(val, keys, pred="pred_main")),
        ("main", "test", "regression", E.regression_metrics(test, keys, pred="pred_main")),
        ("logreg", "val", "direction", direction(val, "pred_logreg_dir")),
        ("logreg", "test", "direction", direction(test, "pred_logreg_dir")),
        ("main", "test", "direction", direction(up, "pred_main_dir")),
        *[(f"strategy_{name}", "test", "strategy", G.strategy_metrics(curve, keys)) for name, curve in curves.items()],
    ]
    return model_quality(parts)


def fold_row(run: SplitRun, split: DataFrame, fold: int) -> DataFrame:
    """One row of panel means for a walk-forward fold."""
    q = run.quality
    def pick(model: str, part: str, task: str, names: Sequence[str], prefix: str):  # noqa: E306
        here = (F.col("model") == model) & (F.col("split") == part) & (F.col("task") == task)
        return [F.avg(F.when(here, F.col(n))).alias(f"{prefix}_{n}") for n in names]

    ics, strategy = ("ic_pearson", "ic_spearman"), ("sharpe", "cagr", "max_drawdown", "exposure")
    metrics = q.agg(
        *pick("main", "val", "regression", ics, "main_val"), *pick("main", "test", "regression", ics, "main_test"),
        *pick("strategy_main", "test", "strategy", strategy, "strategy_main_test"),
        *pick("strategy_selector", "test", "strategy", strategy, "strategy_selector_test"),
    )
    series = run.series.agg(*[F.avg(c).alias(c) for c in ("threshold_main", "threshold_min", "prediction_scale")])
    sanity = run.sanity.agg(
        F.avg("pred_std_test").alias("sanity_pred_std_test"), F.avg("y_std_test").alias("sanity_y_std_test"),
        F.avg("pred_to_y_std_ratio_test").alias("sanity_pred_to_y_std_ratio_test"),
    )
    ranges = split.agg(*[
        agg for s in ("train", "val", "test") for agg in (
            F.count_if(F.col("split") == s).alias(f"{s}_rows"),
            F.min(F.when(F.col("split") == s, F.col("date"))).alias(f"{s}_start"),
            F.max(F.when(F.col("split") == s, F.col("date"))).alias(f"{s}_end"),
        )
    ])
    row = ranges.withColumn("fold", F.lit(fold))
    for part in (metrics, series, sanity):  # each is a single row
        row = row.join(part.withColumn("fold", F.lit(fold)), "fold")
    return row


def walk_forward_run(df: DataFrame, keys: Sequence[str], cfg: TrainConfig, features: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(folds, summary)``. All folds share one binned table: a fold is a bit of two masks, and the candidates of all
    folds are fitted side by side, then the quantiles. Each fold's tables read only its own dates."""
    features, keys = list(features or feature_columns(df, keys)), list(keys)
    n = df.select("date").distinct().count()
    layout = P.layout_for(n, cfg.folds, *cfg.ratios, cfg.step_size)
    dates = materialise(P.fold_dates(P.date_index(df), layout, cfg.expanding), "folds")
    folds = list(range(1, layout.folds + 1))

    def mask(split: str):
        return F.sum(F.when(F.col("split") == split, F.expr("shiftleft(1L, cast(fold as int))")).otherwise(0))

    bits = dates.groupBy("date").agg(mask("train").alias("_fit"), mask("val").alias("_held"))  # one row a day
    data = bin_rows(df.join(by_day(bits), "date"), features, "y", F.col("_fit"), F.col("_held"))
    every = fit_forests(data, [s for f in folds for s in candidate_specs(cfg, f)])
    candidates = {f: every[k * len(cfg.grid): (k + 1) * len(cfg.grid)] for k, f in enumerate(folds)}

    def rows_of(fold: int) -> Stored:
        mine = dates.where(F.col("fold") == fold).select("date", "split")
        return Stored(df.join(by_day(mine), "date").select(*keys, "date", "split", "y", "y_dir", *features), f"fold-{fold}")

    with ThreadPool(max(1, min(cfg.parallelism, len(folds)))) as pool:
        stored = dict(zip(folds, pool.map(rows_of, folds)))
        choices = dict(zip(folds, pool.map(lambda f: choose(stored[f].df, keys, cfg, candidates[f]), folds)))
        edges = fit_forests(data, [s for f in folds for s in quantile_specs(cfg, choices[f].chosen, f)])
        data.chunks.delete()

        def finish(fold: int) -> DataFrame:
            lower, upper = edges[2 * folds.index(fold): 2 * folds.index(fold) + 2]
            forests = {"main": candidates[fold][choices[fold].chosen], "quantile_lower": lower, "quantile_upper": upper}
            run = finish_split(stored[fold].df, keys, cfg, features, choices[fold], forests)
            row = materialise(fold_row(run, stored[fold].df, fold), "fold-row")
            stored[fold].delete()
            return row

        rows = pool.map(finish, folds)
    table = union_all(*rows)
    return table, E.fold_summary(table)


@dataclass
class RunResult:
    split: SplitRun
    ranges: DataFrame
    folds: DataFrame | None
    summary: DataFrame | None


def train_and_evaluate(df: DataFrame, keys: Sequence[str], cfg: TrainConfig = TrainConfig(), folder: str | None = None) -> RunResult:
    """Main split, optional walk-forward run, and the saved models and tables when ``folder`` is given."""
    cfg.check()
    keys = list(keys)
    data = P.time_split(materialise(df, "dataset"), ratios=cfg.ratios)
    features = feature_columns(data, keys)
    run = run_split(data, keys, cfg, features)
    folds = summary = None
    if cfg.walk_forward:
        folds, summary = walk_forward_run(data.drop("split"), keys, cfg, features)
    result = RunResult(run, P.split_ranges(data), folds, summary)
    if folder is not None:
        save_run(result, cfg, keys, folder)
    return result


def save_run(result: RunResult, cfg: TrainConfig, keys: Sequence[str], folder: str) -> None:
    run = result.split
    spark = run.series.sparkSession
    save_models({n: m for n, m in run.models.items() if not isinstance(m, Forest)}, f"{folder}/models")
    for name, model in run.models.items():
        if isinstance(model, Forest):
            model.save(spark, f"{folder}/models/{name}")
    save_json(spark, {"features": run.features, "keys": list(keys), "config": asdict(replace(cfg, grid=()))}, f"{folder}/config")
    save_tables({"strategy": run.series, "predictions_test": run.predictions, **{f"equity_curve_{n}": c for n, c in run.curves.items()}}, f"{folder}/data", "parquet")
    reports = {
        "model_selection": run.selection, "model_quality": run.quality, "sanity_checks": run.sanity, "split_ranges": result.ranges,
        "threshold_search": run.threshold_tables["main"], "threshold_search_logreg": run.threshold_tables["logreg"],
        "selector_signal_rate": G.signal_rate(run.predictions, list(keys), "selector_signal"),
    }
    if result.folds is not None:
        reports |= {"walk_forward_folds": result.folds, "walk_forward_summary": result.summary}
    save_tables(reports, f"{folder}/reports")
    chosen = run.selection.where("selected").select("params").head()
    save_report(spark, run_report(
        result.ranges, run.quality, run.series, run.sanity, run.predictions, keys, asdict(replace(cfg, grid=())), run.features, list(run.models),
        result.folds, result.summary, json.loads(chosen["params"]) if chosen else None), folder)


def latest_signal(df: DataFrame, folder: str, model: str = "main") -> DataFrame:
    """Signal of every series' newest row from a saved run, by the model's own threshold and scale.

    ``prediction_scale`` belongs to the main model; the others predict in the unit of the target (``ridge`` and the
    quantiles, compared with the main threshold) or a score with a threshold of its own (``logreg``).
    """
    spark = df.sparkSession
    head = load_json(spark, f"{folder}/config")
    keys, features = head["keys"], head["features"]
    series = spark.read.parquet(f"{folder}/data/strategy")
    rows = latest_rows(df, keys)
    if model == "main" or model.startswith("quantile_"):
        scored = Forest.load(spark, f"{folder}/models/{model}").transform(rows, "prediction_raw")
    else:
        scored = PipelineModel.load(f"{folder}/models/{model}").transform(rows)
        if model == "logreg":
            scored = add_direction(scored).withColumnRenamed("pred_logreg_score", "prediction_raw")
        else:
            scored = scored.withColumnRenamed("pred_ridge", "prediction_raw")
    series = series.withColumn("threshold", F.col("threshold_logreg" if model == "logreg" else "threshold_main"))
    if model != "main":
        series = series.withColumn("prediction_scale", F.lit(1.0))
    return signal_rows(scored.join(series, keys), keys)


def signal_rows(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    prediction = F.col("prediction_raw") * F.col("prediction_scale")
    out = scored.select(
        *keys, "date", prediction.alias("prediction"), "prediction_raw", "prediction_scale",
        "threshold",
    )
    signal = G.threshold_signal(F.col("prediction"), F.col("threshold"))
    return out.withColumn("signal", signal).withColumn("signal_label", G.signal_label(F.col("signal")))
