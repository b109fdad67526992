"""Splits, metrics, diagnostics, signals, tuning and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill.operators import features as X
from panelmill.operators import metrics as E
from panelmill.operators import quality as Q
from panelmill.operators import ranks as R
from panelmill.operators import reports as H
from panelmill.operators import signals as G
from panelmill.operators import splits as P
from panelmill.operators import tuning as T
from panelmill.queries.base import BARS, CTX_A, CTX_B, PREDS, RETURNS, over, q6, query, roll, six, with_
from panelmill.queries.ingest import dirty_sql
from panelmill.plans.report import compact_report as compact, deep_diagnostics as deep, run_report, save_report
from panelmill.plans.training import TrainConfig, evaluate_split
from panelmill.session import materialise, scratch_path
from panelmill.sources import views as M
from panelmill.sources.writers import load_json, save_tables

K = M.KEYS
preds = M.predictions

# --- splits -----------------------------------------------------------------------------------------

CUTS = """days as (select date, row_number() over (order by date) - 1 as idx, count(*) over () as n from (select distinct date from preds)),
cut as (select max(n) as n, floor(max(n) * 0.7::double) as te, floor(max(n) * 0.7::double) + floor(max(n) * 0.15::double) as ve from days),
dsplit as (select date, case when idx < te then 'train' when idx < ve then 'val' else 'test' end as split from days, cut),
sp as (select p.*, split from preds p join dsplit using (date))"""


def stored_preds(spark, folder):
    """The predictions as a table: what reads them more than once should not compute them again."""
    return materialise(preds(spark, folder), "predictions")


def split_preds(spark, folder):
    return P.time_split(stored_preds(spark, folder))


@query("time_split", with_(PREDS, CUTS) + "select series, date, split from sp")
def time_split(spark, folder):
    return split_preds(spark, folder).select("series", "date", "split")


@query("time_split_by_series", with_(PREDS, """pos as (select series, date, row_number() over (partition by series order by date) - 1 as i,
  count(*) over (partition by series) as n from preds)""") + """select series, date, case when i < floor(n * 0.7::double) then 'train'
  when i < floor(n * 0.7::double) + floor(n * 0.15::double) then 'val' else 'test' end as split from pos""")
def time_split_by_series(spark, folder):
    return P.time_split(preds(spark, folder), per_key=K).select("series", "date", "split")


@query("split_ranges", with_(PREDS, CUTS) + """select split, count(*) as rows, min(date) as date_start, max(date) as date_end
  from sp group by split""")
def split_ranges(spark, folder):
    return P.split_ranges(split_preds(spark, folder))


def folds_sql(count: int, roll: int) -> str:
    """Walk-forward folds over the dates of ``preds``; ``roll`` 1 moves the start of the training dates too."""
    return f"""n as (select count(distinct date) as n from preds),
sz as (select n, greatest(20, floor(n * 0.15::double)) as v, greatest(5, greatest(20, floor(n * 0.15::double)) // {count}) as step,
  greatest(120, floor(n * greatest(0.2::double, 0.7::double * 0.4::double))) as mt from n),
lay as (select n, v, step, coalesce((select max(f) from range(1, {count + 1}) t(f) where n - 2 * v - (f - 1) * step >= mt), 1) as folds from sz),
lay2 as (select *, n - 2 * v - (folds - 1) * step as train from lay),
days as (select date, row_number() over (order by date) - 1 as idx from (select distinct date from preds)),
fd as (select cast(f + 1 as int) as fold, date, case when idx >= f * {roll} * step and idx < train + f * step then 'train'
    when idx >= train + f * step and idx < train + f * step + v then 'val'
    when idx >= train + f * step + v and idx < train + f * step + 2 * v then 'test' end as split
  from days, lay2, range(0, {count}) r(f) where f < folds)"""


def _folds(spark, folder, expanding):
    df = stored_preds(spark, folder)
    n = df.select("date").distinct().count()
    return P.walk_forward(df, P.layout_for(n, 4, 0.70, 0.15, 0.15), expanding)


@query("walk_forward_folds", with_(PREDS, folds_sql(4, 0)) + """select fold, split, p.series, p.date from preds p
  join fd on p.date = fd.date where split is not null""")
def walk_forward_folds(spark, folder):
    return _folds(spark, folder, True).select("fold", "split", "series", "date")


@query("fold_ranges", with_(PREDS, folds_sql(4, 1)) + """select fold, split, count(*) as rows, min(p.date) as date_start,
  max(p.date) as date_end from preds p join fd on p.date = fd.date where split is not null group by fold, split""")
def fold_ranges(spark, folder):
    return P.split_ranges(_folds(spark, folder, False), ["fold", "split"])


# --- metrics ----------------------------------------------------------------------------------------


def corr_sql(x, y):
    r = f"corr({x}, {y})"
    return f"case when stddev_pop({x}) < 1e-12 or stddev_pop({y}) < 1e-12 or {r} is null or isnan({r}) then 0.0 else {r} end"


def rank_sql(col, key):
    part = f"partition by {key} " if key else ""
    peers = f"partition by {key}, {col}" if key else f"partition by {col}"
    return f"rank() over ({part}order by {col}) + (count(*) over ({peers}) - 1) / 2.0::double"


def regression_sql(source, key):
    g = f"{key}, " if key else ""
    return f"""(select {g}{q6('avg(abs(y - pred))')} as mae, {q6('sqrt(avg((y - pred) * (y - pred)))')} as rmse,
  {q6(corr_sql('pred', 'y'))} as ic_pearson, {q6(corr_sql('rp', 'ry'))} as ic_spearman
  from (select *, {rank_sql('pred', key)} as rp, {rank_sql('y', key)} as ry from {source}) {'group by ' + key if key else ''})"""


@query("regression_metrics", with_(PREDS) + "select * from " + regression_sql("preds", "series"))
def regression_metrics(spark, folder):
    df = stored_preds(spark, folder)
    return six(E.regression_metrics(df, K, parts=R.parts_of(df)))


@query("rank_ic_pooled", with_(PREDS, CUTS) + "select * from " + regression_sql("sp", "split"))
def rank_ic_pooled(spark, folder):
    """Each split is one large group, so the ranks are range-partitioned."""
    return six(E.regression_metrics(split_preds(spark, folder), ["split"], daily=False))


DIRECTION = f"""select {{g}} {q6('avg(cast(hit as double))')} as accuracy,
  {q6('(coalesce(avg(case when y_dir = 0 then hit end), 0) + coalesce(avg(case when y_dir = 1 then hit end), 0)) / count(distinct y_dir)')} as balanced_accuracy
  from (select *, cast(y_dir = cast(pred > 0 as int) as int) as hit from {{s}}) group by {{k}}"""


def _direction(df, keys):
    return E.direction_metrics(df.withColumn("pred_dir", (F.col("pred") > 0).cast("int")), keys)


@query("direction_metrics", with_(PREDS) + DIRECTION.format(g="series,", s="preds", k="series"))
def direction_metrics(spark, folder):
    return six(_direction(preds(spark, folder), K))


def _sanity_sql():
    cols = []
    for part in ("val", "test"):
        p, y = f"case when split = '{part}' then pred end", f"case when split = '{part}' then y end"
        cols += [
            f"{q6(f'coalesce(avg({p}), 0)')} as pred_mean_{part}", f"coalesce(stddev_pop({p}), 0) as ps_{part}",
            f"coalesce(stddev_pop({y}), 0) as ys_{part}", f"{q6(f'coalesce(quantile_cont(abs({p}), 0.9), 0)')} as pred_abs_p90_{part}",
            f"{q6(f'coalesce(max(abs({p})), 0)')} as pred_abs_max_{part}", f"{q6(f'coalesce(avg({y}), 0)')} as y_mean_{part}",
        ]
    return ", ".join(cols)


def _sanity_out():
    out = []
    for part in ("val", "test"):
        ratio = f"case when ys_{part} < 1e-12 then 0.0 else ps_{part} / nullif(ys_{part}, 0) end"
        out += [f"pred_mean_{part}", f"{q6(f'ps_{part}')} as pred_std_{part}", f"pred_abs_p90_{part}", f"pred_abs_max_{part}",
                f"y_mean_{part}", f"{q6(f'ys_{part}')} as y_std_{part}", f"{q6(ratio)} as pred_to_y_std_ratio_{part}"]
    ratio = "case when ys_{0} < 1e-12 then 0.0 else ps_{0} / nullif(ys_{0}, 0) end < 0.1"
    return ", ".join(out) + f", ({ratio.format('val')} or {ratio.format('test')}) as pred_collapse_warning"


@query("sanity_checks", with_(PREDS, CUTS, f"agg as (select series, {_sanity_sql()} from sp group by series)") + f"select series, {_sanity_out()} from agg")
def sanity_checks(spark, folder):
    return six(E.sanity_checks(split_preds(spark, folder), K))


@query("sanity_checks_pooled", with_(PREDS, CUTS, f"agg as (select {_sanity_sql()} from sp)") + f"select {_sanity_out()} from agg")
def sanity_checks_pooled(spark, folder):
    return six(E.sanity_checks(split_preds(spark, folder), [], daily=False))


_RAW = ["ret_1", "ret_10", "volatility_20", "momentum_5", "close"]


@query("missing_ratio", with_(BARS, RETURNS, f"""raw as (select ret_1, ret_10, {roll('stddev_samp', 'ret_1', 20)} as volatility_20,
  {roll('avg', 'ret_1', 5)} as momentum_5, close from rets)""") + " union all ".join(
    f"select '{c}' as \"column\", {q6(f'avg(cast({c} is null as int))')} as missing_ratio from raw" for c in _RAW))
def missing_ratio(spark, folder):
    df = X.add_rolling_returns(X.add_returns(M.bars(spark, folder), K), K).select(*_RAW)
    return six(E.missing_ratio(df))


def _hist_sql(source, col, bins=60):
    return f"""select cast(b.bin as int) as bin, {q6('lo + b.bin * w')} as left_edge, {q6('lo + (b.bin + 1) * w')} as right_edge, coalesce(n, 0) as n
  from (select unnest(range({bins})) as bin) b, (select min({col}) as lo, (max({col}) - min({col})) / {bins} as w from {source}) r
  left join (select case when v < lo + g * w then g - 1 when v >= lo + (g + 1) * w and g < {bins - 1} then g + 1 else g end as bin, count(*) as n
    from (select {col} as v, lo, w, least(floor(({col} - lo) / w), {bins - 1}) as g from {source},
      (select min({col}) as lo, (max({col}) - min({col})) / {bins} as w from {source})) group by 1) c on b.bin = c.bin"""


@query("histogram60", with_(PREDS) + _hist_sql("preds", "y"))
def histogram60(spark, folder):
    return six(E.histogram(stored_preds(spark, folder), "y"))


@query("residual_histogram", with_(PREDS, "res as (select y - pred as residual from preds)") + _hist_sql("res", "residual"))
def residual_histogram(spark, folder):
    return six(H.residual_histogram(stored_preds(spark, folder)))


_BY_YEAR = """by_year as (select year(date) as fold, avg(y) as y_mean, stddev_pop(y) as y_std, cast(count(*) as double) as rows_used,
  case when year(date) > 1996 then avg(pred) end as pred_mean from preds group by 1)"""
_METRICS = ["y_mean", "y_std", "rows_used", "pred_mean"]


def _by_year(spark, folder):
    return preds(spark, folder).groupBy(F.year("date").alias("fold")).agg(
        F.avg("y").alias("y_mean"), F.stddev_pop("y").alias("y_std"), F.count(F.lit(1)).alias("rows_used"),
        F.avg(F.when(F.year("date") > 1996, F.col("pred"))).alias("pred_mean"),
    )


@query("fold_summary", with_(PREDS, _BY_YEAR) + " union all ".join(
    f"""select '{m}' as metric, {q6(f'avg({m})')} as mean, {q6(f'median({m})')} as median, {q6(f'stddev_pop({m})')} as std,
  {q6(f'min({m})')} as min, {q6(f'max({m})')} as max from by_year""" for m in _METRICS))
def fold_summary(spark, folder):
    return six(E.fold_summary(_by_year(spark, folder)))


@query("walk_forward_metric", with_(PREDS, _BY_YEAR) + f"select cast(fold as int) as fold, {q6('y_std')} as y_std from by_year")
def walk_forward_metric(spark, folder):
    return six(H.walk_forward_metric(_by_year(spark, folder), "y_std"))


@query("target_stats", with_(PREDS) + f"""select {q6('avg(y)')} as mean, {q6('stddev_pop(y)')} as std, {q6('median(y)')} as median,
  {q6('quantile_cont(y, 0.01)')} as p01, {q6('quantile_cont(y, 0.99)')} as p99, {q6('avg(cast(y > 0 as int))')} as positive_rate,
  {q6('avg(cast(y_dir > 0 as int))')} as y_dir_positive_rate from preds""")
def target_stats(spark, folder):
    return six(E.target_stats(stored_preds(spark, folder)))


_CORR_FEATURES = ["ret_1", "momentum_5", "volatility_20", "log_volume", "day_of_week", "hl_range", "dividend_flag_t"]


@query("top_correlations", with_(BARS, RETURNS, f"""f as (select ln(next_ratio) as y, ret_1, {roll('avg', 'ret_1', 5)} as momentum_5,
  {roll('stddev_samp', 'ret_1', 20)} as volatility_20, log_volume, cast(isodow(date) - 1 as double) as day_of_week,
  (high - low) / close as hl_range, 0.0::double as dividend_flag_t from rets)""",
  "ok as (select " + ", ".join(f"{q6(c)} as {c}" for c in ["y", *_CORR_FEATURES]) + " from f where y is not null and volatility_20 is not null)",
  f"long as (select y, unnest([{', '.join(repr(c) for c in _CORR_FEATURES)}]) as feature, unnest([{', '.join(_CORR_FEATURES)}]) as x from ok)",
  "r as (select feature, rank() over (partition by feature order by x) + (count(*) over (partition by feature, x) - 1) / 2.0::double as rx, "
  "rank() over (partition by feature order by y) + (count(*) over (partition by feature, y) - 1) / 2.0::double as ry, x from long)")
  + f"select feature, {q6('corr(rx, ry)')} as spearman from r group by feature having min(x) < max(x) order by abs(corr(rx, ry)) desc limit 5")
def top_correlations(spark, folder):
    df = X.make_target(X.make_features(M.bars(spark, folder), K), K).dropna()
    return six(R.top_correlations(six(df.select("y", *_CORR_FEATURES)), "y", _CORR_FEATURES, 5))


# --- diagnostics ------------------------------------------------------------------------------------


def _profiles(spark, folder):
    bars = materialise(M.bars(spark, folder), "bars")  # each profile reads its table several times
    return {
        "bars": bars, "dirty": M.dirty_bars(spark, folder, bars),
        "context": M.context(spark, folder, urgent_only=True), "suppliers": M.table(spark, folder, "supplier"), "absent": None,
    }


def _profile_sql():
    def row(name, source, cols, date, dated, faults):
        return f"""select '{name}' as name, 'ok' as status, count(*) as rows, {cols}::int as columns, {date} as date_col, count({dated}) as date_non_null,
  cast(min({dated}) as timestamp) as date_min, cast(max({dated}) as timestamp) as date_max, {faults} from {source}"""

    def faults(v, o, h, l, c):
        num = lambda s: f"try_cast({s} as double)"
        low = " or ".join(f"coalesce({num(s)} <= 0, false)" for s in (o, h, l, c))
        return f"""count(*) filter ({num(v)} = 0) as volume_zero_count, count(*) filter ({num(v)} < 0) as volume_negative_count,
  count(*) filter ({low}) as ohlc_non_positive_rows, count(*) filter ({num(h)} < {num(l)}) as high_below_low_rows"""

    none = "null::bigint as volume_zero_count, null::bigint as volume_negative_count, null::bigint as ohlc_non_positive_rows, null::bigint as high_below_low_rows"
    dup = lambda d: f"count({d}) - count(distinct {d}) as duplicate_dates, "
    return " union all ".join([
        row("bars", "bars", 7, "'date'", "date", dup("date") + faults("volume", "open", "high", "low", "close")),
        row("dirty", "dirty", 8, "'Date'", "try_cast(d as date)", dup("try_cast(d as date)") + faults("v", "o", "h", "l", "c")),
        row("context", "ctx_b", 2, "'date'", "date", dup("date") + none),
        row("suppliers", "supplier", 4, "null", "null::date", "null::bigint as duplicate_dates, " + none),
        "select 'absent', 'missing_or_unsupported', null, null, null, null, null, null, null, null, null, null, null",
    ])


@query("table_profile", with_(BARS, dirty_sql(), CTX_B) + _profile_sql())
def table_profile(spark, folder):
    report = Q.quality_report(_profiles(spark, folder), spark)["profiles"]
    return report.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("date_min", "date_max")})


@query("common_window", with_(BARS, dirty_sql(), CTX_B) + """select case when start > "end" then 'empty_intersection' else 'ok' end as status, start, "end" from (
  select greatest((select min(date) from bars), (select min(date) from ctx_b), (select min(try_cast(d as date)) from dirty))::timestamp as start,
         least((select max(date) from bars), (select max(date) from ctx_b), (select max(try_cast(d as date)) from dirty))::timestamp as "end")""")
def common_window(spark, folder):
    out = Q.quality_report(_profiles(spark, folder), spark)["common_window"]
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query("out_of_order", """select 'events' as name, count(*) as out_of_order from (select ts < lag(ts) over (order by event_id) as bad from events) where bad
  union all select 'orders', count(*) from (select o_orderdate < lag(o_orderdate) over (order by o_orderkey) as bad from orders) where bad""")
def out_of_order(spark, folder):
    ev = Q.is_ordered(M.table(spark, folder, "events"), "event_id", "ts")
    od = Q.is_ordered(M.table(spark, folder, "orders"), "o_orderkey", "o_orderdate")
    return ev.select(F.lit("events").alias("name"), "*").union(od.select(F.lit("orders").alias("name"), "*"))


@query("ohlcv_anomalies", with_(BARS, dirty_sql()) + """select series, count(*) filter (try_cast(v as double) = 0) as volume_zero_count,
  count(*) filter (try_cast(v as double) < 0) as volume_negative_count,
  count(*) filter (coalesce(try_cast(o as double) <= 0, false) or coalesce(try_cast(h as double) <= 0, false)
    or coalesce(try_cast(l as double) <= 0, false) or coalesce(try_cast(c as double) <= 0, false)) as ohlc_non_positive_rows,
  count(*) filter (try_cast(h as double) < try_cast(l as double)) as high_below_low_rows from dirty group by series""")
def ohlcv_anomalies(spark, folder):
    return Q.ohlcv_anomalies(M.dirty_bars(spark, folder), K)


@query("return_outliers", with_(BARS, RETURNS) + f"""select series, date, {q6('ret_1')} as ret_1 from rets
  qualify abs(ret_1) > 2 * stddev_samp(ret_1) over (partition by series)""")
def return_outliers(spark, folder):
    return six(Q.return_outliers(X.add_returns(M.bars(spark, folder), K).select("series", "date", "ret_1"), K, 2.0))


# --- signals ----------------------------------------------------------------------------------------

THR, COST = 0.01, 10.0


def signal_sql(p, t):
    return f"case when {p} > {t} then 1 when {p} < -{t} then -1 else 0 end"


def curve_sql(source, signal, key="series", name="curve"):
    w = f"over (partition by {key} order by date)"
    cum = f"over (partition by {key} order by date rows between unbounded preceding and current row)"
    return f"""{name}_s as (select *, {signal} as signal from {source}),
{name}_t as (select *, cast(abs(signal - coalesce(lag(signal) {w}, 0)) as double) as turnover from {name}_s),
{name}_c as (select *, {COST}::double / 10000 * turnover as transaction_cost, signal * y - {COST}::double / 10000 * turnover as strategy_return from {name}_t),
{name}_e as (select *, sum(strategy_return) {cum} as log_equity from {name}_c),
{name} as (select *, exp(log_equity) / max(exp(log_equity)) {cum} - 1 as drawdown, max(exp(log_equity)) {cum} as equity_peak from {name}_e)"""


def strategy_sql(source, key):
    sharpe = "case when stddev_pop(strategy_return) <= 0 then 0.0 else avg(strategy_return) / stddev_pop(strategy_return) * sqrt(252.0::double) end"
    return f"""select {key}, {q6('exp(arg_max(log_equity, date)) - 1')} as total_return, {q6('exp(arg_max(log_equity, date) * 252 / count(*)) - 1')} as cagr,
  {q6(sharpe)} as sharpe, {q6('min(drawdown)')} as max_drawdown, {q6('avg(cast(signal <> 0 as int))')} as exposure,
  sum(turnover) as turnover_total, {q6('avg(turnover)')} as turnover_avg, {q6('sum(transaction_cost)')} as transaction_cost_total,
  {q6('coalesce(avg(case when signal <> 0 then cast(sign(y) = sign(signal) as int) end), 0)')} as hit_rate from {source} group by {key}"""


def _curve(spark, folder):
    return G.strategy_curve(preds(spark, folder), K, G.threshold_signal(F.col("pred"), THR), cost_bps=COST)


CURVE = curve_sql("preds", signal_sql("pred", THR))


@query("threshold_signal", with_(PREDS) + f"select series, date, {signal_sql('pred', THR)} as signal from preds")
def threshold_signal(spark, folder):
    return preds(spark, folder).select("series", "date", G.threshold_signal(F.col("pred"), THR).alias("signal"))


@query("selector_signal", with_(PREDS) + f"""select series, date,
  case when pred > {THR} and q_low > -0.002 and q_high - q_low <= 0.02 then 1 when pred < -{THR} and q_high < 0.002 and q_high - q_low <= 0.02 then -1 else 0 end as cost_rule,
  case when pred > {THR} and q_low > 0 then 1 when pred < -{THR} and q_high < 0 then -1 else 0 end as sign_rule from preds""")
def selector_signal(spark, folder):
    p, lo, hi = F.col("pred"), F.col("q_low"), F.col("q_high")
    return preds(spark, folder).select(
        "series", "date", G.selector_signal(p, lo, hi, THR, 0.001, True, 2.0, 0.02).alias("cost_rule"),
        G.selector_signal(p, lo, hi, THR, use_cost_rule=False).alias("sign_rule"),
    )


@query("turnover_cost", with_(PREDS, CURVE) + f"""select series, date, turnover, {q6('transaction_cost')} as transaction_cost,
  {q6('strategy_return')} as strategy_return from curve""")
def turnover_cost(spark, folder):
    return six(_curve(spark, folder).select("series", "date", "turnover", "transaction_cost", "strategy_return"))


@query("equity_drawdown", with_(PREDS, CURVE) + f"""select series, date, {q6('exp(log_equity)')} as equity,
  {q6('equity_peak')} as equity_peak, {q6('drawdown')} as drawdown from curve""")
def equity_drawdown(spark, folder):
    return six(_curve(spark, folder).select("series", "date", "equity", "equity_peak", "drawdown"))


@query("strategy_metrics", with_(PREDS, CURVE) + strategy_sql("curve", "series"))
def strategy_metrics(spark, folder):
    return six(G.strategy_metrics(_curve(spark, folder), K))


@query("signal_distribution", with_(PREDS) + f"""select s.series, v.signal, v.label, count(p.series) as days
  from (select distinct series from preds) s cross join (values (-1, 'short'), (0, 'flat'), (1, 'long')) v(signal, label)
  left join (select series, {signal_sql('pred', THR)} as signal from preds) p on p.series = s.series and p.signal = v.signal
  group by s.series, v.signal, v.label""")
def signal_distribution(spark, folder):
    return E.signal_distribution(_curve(spark, folder), K)


@query("return_stats", with_(PREDS, CURVE) + f"""select series, {q6('avg(strategy_return)')} as mean, {q6('stddev_pop(strategy_return)')} as std,
  count(*) filter (strategy_return <> 0) as non_zero_days from curve group by series""")
def return_stats(spark, folder):
    return six(E.return_stats(_curve(spark, folder), K))


@query("zero_exposure", with_(PREDS) + "select series, count(*) filter (abs(pred) > 0.17) as active_days from preds group by series having count(*) filter (abs(pred) > 0.17) = 0")
def zero_exposure(spark, folder):
    return Q.zero_exposure(preds(spark, folder).withColumn("signal", G.threshold_signal(F.col("pred"), 0.17)), K)


@query("low_signal_warning", with_(PREDS) + f"""select series, {q6('quantile_cont(abs(pred), 0.9)')} as pred_abs_p90,
  quantile_cont(abs(pred), 0.9) < 0.015 as low_signal from preds group by series""")
def low_signal_warning(spark, folder):
    return six(G.low_signal_warning(preds(spark, folder), K, "pred", 0.015))


@query("signal_rate", with_(PREDS) + f"select series, {q6(f'avg(cast(abs(pred) > {THR} as int))')} as signal_rate from preds group by series")
def signal_rate(spark, folder):
    df = preds(spark, folder).withColumn("signal", G.threshold_signal(F.col("pred"), THR))
    return six(G.signal_rate(df, K, "signal"))


# --- tuning -----------------------------------------------------------------------------------------

MIN_T = G.cost_threshold(COST, 4.0)


def grid_sql(scales):
    items = ", ".join([f"{{'ord': {i}, 'quantile': {q}::double, 'v': lv[{i + 1}] * scale}}" for i, q in enumerate(T.QUANTILES)]
                      + [f"{{'ord': {4 + i}, 'quantile': null::double, 'v': {MIN_T}::double * {m}::double}}" for i, m in enumerate(T.COST_MULTIPLES)])
    levels = ", ".join(str(q) for q in T.QUANTILES)
    return f"""th as (select series, quantile_cont(abs(pred), [{levels}]) as lv from preds group by series),
sc as (select *, unnest([{', '.join(f'{s}::double' for s in scales)}]) as scale from th),
ca as (select series, scale, unnest([{items}]) as c from sc),
cand as (select series, scale, c.quantile as quantile, round(greatest(c.v, {MIN_T}::double), 12) as threshold from ca
  qualify row_number() over (partition by series, scale, round(greatest(c.v, {MIN_T}::double), 12) order by c.ord) = 1),
gr as (select p.series, p.date, p.y, p.pred * c.scale as pred, c.scale, c.quantile, c.threshold from preds p join cand c using (series)),
{curve_sql('gr', signal_sql('pred', 'threshold'), 'series, scale, threshold', 'gc')}"""


_SHARPE = "case when stddev_pop(strategy_return) <= 0 then 0.0 else avg(strategy_return) / stddev_pop(strategy_return) * sqrt(252.0::double) end"
_RANKED = f"""tab as (select series, scale, threshold, {_SHARPE} as sharpe, sum(strategy_return) / count(*) as growth,
  avg(cast(signal <> 0 as int)) as exposure from gc group by series, scale, threshold),
top3 as (select * from tab qualify row_number() over (partition by series, scale order by round(sharpe, 10) desc, round(exp(growth * 252) - 1, 10) desc, threshold) <= 3),
pick as (select * from top3 qualify row_number() over (partition by series, scale order by threshold) = 1)"""


@query("threshold_search", with_(PREDS, grid_sql([1.0])) + strategy_sql("gc", "series, threshold").replace(
    "select series, threshold,", f"select series, {q6('threshold')} as threshold, max(quantile) as quantile,"))
def threshold_search(spark, folder):
    table = T.threshold_table(preds(spark, folder), K, cost_bps=COST, min_threshold=MIN_T)
    return six(table.drop("min_threshold", "cost_bps"))


@query("tuned_threshold", with_(PREDS, grid_sql([1.0]), _RANKED) + f"select series, {q6('threshold')} as threshold from pick")
def tuned_threshold(spark, folder):
    return six(T.tune_threshold(preds(spark, folder), K, cost_bps=COST, min_threshold=MIN_T)[0])


_NEAR = "abs({0}.{2} - {1}.{2}) <= 1e-8 + 1e-5 * abs({1}.{2})"  # the near-equality of the sequential choice


@query("scale_choice", with_(PREDS, grid_sql(T.SCALES), _RANKED, """li as (select series, list({'scale': scale, 'threshold': threshold, 'sharpe': round(sharpe, 10), 'exposure': round(exposure, 10)} order by scale) as l from pick group by series)""",
       f"""best as (select series, list_reduce(l, lambda a, b: case when b.sharpe > a.sharpe or
  ({_NEAR.format('b', 'a', 'sharpe')} and b.exposure > a.exposure) then b else a end) as b from li)""")
  + f"""select series, b.scale as scale, {q6('b.threshold')} as threshold, {q6('b.sharpe')} as val_strategy_sharpe,
  {q6('b.exposure')} as val_strategy_exposure from best""")
def scale_choice(spark, folder):
    return six(T.choose_scale(preds(spark, folder), K, cost_bps=COST, min_threshold=MIN_T))


def _candidates(spark, folder):
    df = stored_preds(spark, folder)
    quality = E.regression_metrics(df, K)
    spread = df.groupBy(*K).agg(F.stddev_pop("pred").alias("val_pred_std"), F.stddev_pop("y").alias("y_std"))
    curve = G.strategy_curve(df, K, G.threshold_signal(F.col("pred"), THR), cost_bps=COST)
    strategy = G.strategy_metrics(curve, K).select("series", "sharpe", "exposure")
    return quality.join(spread, K).join(strategy, K).select(
        F.col("series").alias("candidate_id"), (F.col("series") % 10).alias("run"), "sharpe", "exposure", "ic_pearson",
        "ic_spearman", F.abs(F.col("ic_pearson") - F.col("ic_spearman")).alias("gap"), "val_pred_std", "y_std",
        (F.col("val_pred_std") / F.col("y_std") / 10).alias("val_pred_to_y_std_ratio"),
    ).withColumn("score", T.candidate_score(*[F.col(c) for c in (
        "sharpe", "ic_spearman", "ic_pearson", "gap", "val_pred_to_y_std_ratio", "val_pred_std", "exposure")]))


_CAND = f"""rk as (select *, {rank_sql('pred', 'series')} as rp, {rank_sql('y', 'series')} as ry from preds),
cq as (select series, {corr_sql('pred', 'y')} as ic_pearson, {corr_sql('rp', 'ry')} as ic_spearman, stddev_pop(pred) as ps, stddev_pop(y) as ys from rk group by series),
cs as (select series, {_SHARPE} as sharpe, avg(cast(signal <> 0 as int)) as exposure from curve group by series),
cc as (select series as candidate_id, series % 10 as run, ps, ys, ps / ys / 10 as ratio, sharpe, exposure, ic_pearson, ic_spearman,
  0.70::double * greatest(least(sharpe, 3.0::double), -3.0::double) + 0.20::double * ic_spearman + 0.10::double * ic_pearson - 0.35::double * abs(ic_pearson - ic_spearman)
  - case when ps / ys / 10 < 0.005 then 1.0 when ps / ys / 10 < 0.01 then 0.6 when ps / ys / 10 < 0.02 then 0.35 else 0.0 end
  - case when ps < 1e-5 then 0.5 else 0.0 end - case when exposure < 0.15 then 0.2 else 0.0 end as score from cq join cs using (series))"""


@query("candidate_score", with_(PREDS, CURVE, _CAND) + f"select candidate_id, {q6('score')} as score from cc")
def candidate_score(spark, folder):
    return six(_candidates(spark, folder).select("candidate_id", "score"))


@query("candidate_choice", with_(PREDS, CURVE, _CAND) + f"""select candidate_id, run, {q6('score')} as score,
  row_number() over (partition by run order by (ratio >= 0.03 and ps >= greatest(1e-5, 0.001 * ys)) desc, score desc, candidate_id) = 1 as selected from cc""")
def candidate_choice(spark, folder):
    table = materialise(_candidates(spark, folder), "candidates")
    return six(T.select_candidate(table, F.col("y_std"), groups=["run"]).select("candidate_id", "run", "score", "selected"))


@query("latest_signal", with_(PREDS) + f"""select series, date, {q6('pred * 2')} as prediction, {signal_sql('pred * 2', THR)} as signal,
  case {signal_sql('pred * 2', THR)} when 1 then 'long' when -1 then 'short' else 'flat' end as signal_label from preds
  qualify row_number() over (partition by series order by date desc) = 1""")
def latest_signal(spark, folder):
    newest = X.latest_rows(preds(spark, folder), K).withColumn("prediction", F.col("pred") * 2.0)
    signal = G.threshold_signal(F.col("prediction"), THR)
    return six(newest.select("series", "date", "prediction", signal.alias("signal"), G.signal_label(signal).alias("signal_label")))


_QUALITY = ["mae", "rmse", "ic_pearson", "ic_spearman", "accuracy", "balanced_accuracy", "sharpe", "exposure"]


@query("model_quality", with_(PREDS, CUTS, "te as (select * from sp where split = 'test')", "va as (select * from sp where split = 'val')",
       curve_sql("te", signal_sql("pred", THR)), "dir as (" + DIRECTION.format(g="series,", s="te", k="series") + ")", "st as (" + strategy_sql("curve", "series") + ")")
  + f"""select 'momentum' as model, 'val' as split, 'regression' as task, series, mae, rmse, ic_pearson, ic_spearman, null::double as accuracy,
    null::double as balanced_accuracy, null::double as sharpe, null::double as exposure from {regression_sql('va', 'series')}
  union all select 'momentum', 'test', 'regression', series, mae, rmse, ic_pearson, ic_spearman, null, null, null, null from {regression_sql('te', 'series')}
  union all select 'momentum', 'test', 'direction', series, null, null, null, null, accuracy, balanced_accuracy, null, null from dir
  union all select 'momentum', 'test', 'strategy', series, null, null, null, null, null, null, sharpe, exposure from st""")
def model_quality(spark, folder):
    df = split_preds(spark, folder)
    val, test = (df.where(F.col("split") == s) for s in ("val", "test"))
    curve = G.strategy_curve(test, K, G.threshold_signal(F.col("pred"), THR), cost_bps=COST)
    table = H.model_quality([
        ("momentum", "val", "regression", E.regression_metrics(val, K)),
        ("momentum", "test", "regression", E.regression_metrics(test, K)),
        ("momentum", "test", "direction", _direction(test, K)),
        ("momentum", "test", "strategy", G.strategy_metrics(curve, K).select("series", "sharpe", "exposure")),
    ])
    return six(table.select("model", "split", "task", "series", *_QUALITY))


# --- report tables ----------------------------------------------------------------------------------

_FIRST = "first_value({0} ignore nulls) over (partition by series order by date rows between unbounded preceding and unbounded following)"


@query("context_index100", with_(BARS, CTX_A, CTX_B, """j as (select b.series, b.date, b.close as main, a.close as idx, f.close as fx from bars b
  left join ctx_a a on a.date = b.date left join ctx_b f on f.date = b.date)""") + "select series, date, " + ", ".join(
    f"{q6(f'{c} / {_FIRST.format(c)} * 100')} as {c}" for c in ("main", "idx", "fx")) + " from j")
def context_index100(spark, folder):
    ctx = {"idx": M.context(spark, folder), "fx": M.context(spark, folder, urgent_only=True)}
    return six(H.context_index(M.bars(spark, folder), ctx, K))


@query("price_volume", with_(BARS) + "select series, date, close, volume from bars")
def price_volume(spark, folder):
    return H.price_volume(M.bars(spark, folder), K)


@query("scatter_limit", with_(PREDS) + f"select {q6('greatest(max(abs(pred)), max(abs(y)))')} as \"limit\" from preds")
def scatter_limit(spark, folder):
    return six(H.scatter_limit(preds(spark, folder)))


@query("prediction_summary", with_(PREDS) + f"""select count(*) as predictions_rows, {q6(corr_sql('pred', 'y'))} as pearson,
  {q6(corr_sql('rp', 'ry'))} as spearman from (select *, {rank_sql('pred', '')} as rp, {rank_sql('y', '')} as ry from preds)""")
def prediction_summary(spark, folder):
    return six(Q.prediction_summary(stored_preds(spark, folder)))


@query("table_summary", with_(BARS) + """select 'bars' as name, count(*) as rows, 7::int as columns, min(date) as date_start, max(date) as date_end from bars
  union all select 'supplier', count(*), 4, null, null from supplier""")
def table_summary(spark, folder):
    return E.table_summary(M.bars(spark, folder), "bars").union(E.table_summary(M.table(spark, folder, "supplier"), "supplier"))


def saved_run(spark, folder):
    """A run saved without fitting anything: the model-free predictions stand for the main, linear and quantile models."""
    split = split_preds(spark, folder)
    rows = split.select(
        "series", "date", "split", "y", "y_dir", F.col("pred").alias("pred_main_raw"), F.col("pred").alias("pred_ridge"), F.col("pred").alias("pred_logreg_score"),
        (F.col("pred") > 0).cast("int").alias("pred_logreg_dir"), F.col("q_low").alias("pred_quantile_lower"), F.col("q_high").alias("pred_quantile_upper"),
        F.lit(1.0).alias("prediction_scale"), F.col("pred").alias("pred_main"))
    cfg = TrainConfig(cost_bps=10.0)
    both = materialise(rows.where("split <> 'train'"), "scored")
    held = both.groupBy("series").agg(F.count_if(F.col("split") == "val").alias("v"), F.count_if(F.col("split") == "test").alias("t")).where("v > 0 and t > 0")
    run = evaluate_split(both.join(held.select("series"), "series", "left_semi"), K, cfg, [], {})
    ranges = P.split_ranges(split)
    path = scratch_path(spark, "run")
    save_tables({"predictions_test": run.predictions, "equity_curve_main": run.curves["main"]}, f"{path}/data", "parquet")
    save_tables({"model_quality": run.quality}, f"{path}/reports")
    report = run_report(ranges, run.quality, run.series, run.sanity, run.predictions, K, {"cost_bps": 10.0, "alpha_low": 0.1, "alpha_high": 0.9}, ["a"], ["ridge", "main"])
    save_report(spark, report, path)
    return path


_TUNED = """ok as (select series from sp group by series having count(*) filter (split = 'val') > 0 and count(*) filter (split = 'test') > 0),
held as (select sp.* from sp join ok using (series) where split <> 'train'),
quality as (
  select split, avg(mae) as mae, avg(rmse) as rmse from (
    select split, series, avg(abs(y - pred)) as mae, sqrt(avg((y - pred) * (y - pred))) as rmse from held group by all) group by split),
spread as (select avg(s) as s, avg(t) as t from (
  select series, stddev_pop(pred) as s, stddev_pop(y) as t from held where split = 'test' group by series))"""


@query("compact_report", with_(PREDS, CUTS, _TUNED) + f"""
  select 'data' as section, 'rows' as item, cast(count(*) as varchar) as value from sp
  union all select 'data', split, cast(count(*) as varchar) from sp group by split
  union all select 'range', 'first', cast(min(date) as varchar) from sp union all select 'range', 'last', cast(max(date) as varchar) from sp
  union all select 'models', unnest(['main', 'ridge']), 'saved'
  union all select 'sanity', 'pred_std_test', cast({q6('s')} as varchar) from spread union all select 'sanity', 'y_std_test', cast({q6('t')} as varchar) from spread
  union all select 'selector', 'alpha_low', '0.1' union all select 'selector', 'alpha_high', '0.9' union all select 'selector', 'thr_min', '0.001'
  union all select 'quality', m || '.' || split || '.regression.mae', cast({q6('mae')} as varchar) from quality, (values ('main'), ('ridge')) m(m)
  union all select 'quality', m || '.' || split || '.regression.rmse', cast({q6('rmse')} as varchar) from quality, (values ('main'), ('ridge')) m(m)""")
def compact_report(spark, folder):
    """The short report read back from a saved run; of its figures those that SQL states directly."""
    out = compact(spark, saved_run(spark, folder))
    short = F.when(F.col("section").isin("sanity", "quality"), F.floor(F.col("value").cast("double") * 1000000 + 0.5) / 1000000).cast("string")
    known = ~F.col("section").isin("sanity", "quality", "selector") | F.col("item").isin("pred_std_test", "y_std_test", "alpha_low", "alpha_high", "thr_min") | (
        F.col("item").rlike("regression.(mae|rmse)$"))
    return out.where(known).select("section", "item", F.coalesce(short, F.col("value")).alias("value"))


_COUNTS = ["rows", "columns", "date_non_null", "duplicate_dates", "volume_zero_count", "volume_negative_count", "ohlc_non_positive_rows", "high_below_low_rows"]


@query("deep_diagnostics", with_(PREDS, dirty_sql(), CTX_B, CUTS, _TUNED, f"prof as ({_profile_sql()})") + " union all ".join(
    f"""select 'table' as section, name || '.{c}' as item, cast("{c}" as varchar) as value, true as written from prof where "{c}" is not null""" for c in _COUNTS) + """
  union all select 'artifacts', unnest(['predictions_rows', 'equity_curve_rows']), cast(count(*) as varchar), true from held where split = 'test'
  union all select 'artifacts', 'model_quality_rows', cast(10 * count(*) as varchar), true from ok""")
def deep_diagnostics(spark, folder):
    """The counts of profiles and artifacts of a saved run, and whether what was written out reads back the same."""
    path = saved_run(spark, folder)
    out = deep(spark, _profiles(spark, folder), path, f"{path}/reports/diagnostics_deep")
    stored = load_json(spark, f"{path}/reports/diagnostics_deep")
    flat = spark.createDataFrame([(a, b, c) for a, part in stored.items() for b, c in part.items()], "section string, item string, back string")
    known = (F.col("section") == "artifacts") | F.substring_index("item", ".", -1).isin(_COUNTS) & (F.col("section") == "table") & (F.col("value") != "null")
    return out.where(known).join(flat, ["section", "item"], "left").select(
        "section", "item", "value", F.coalesce(F.col("back") == F.col("value"), F.lit(False)).alias("written"))
