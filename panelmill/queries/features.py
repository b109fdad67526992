"""Bars, features, targets, joins and the flagship dataset."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill.functions import feature_columns, quantise
from panelmill.operators import features as X
from panelmill.operators import joins as J
from panelmill.operators import ranks as R
from panelmill.operators.prepare import prepare_calendar, prepare_dividends, prepare_bars
from panelmill.plans.dataset import build_dataset
from panelmill.queries.base import (
    BARS, BARS_5M, CALENDAR, CTX_A, CTX_B, DIVIDENDS, RETURNS, features_sql, over, q6, query, roll, six, with_,
)
from panelmill.sources import views as M

K = M.KEYS


@query("daily_bars", with_(BARS) + "select * from bars")
def daily_bars(spark, folder):
    return M.bars(spark, folder)


@query("returns_lags", with_(BARS, RETURNS) + f"""select series, date, {q6('ret_1')} as ret_1, {q6('ret_2')} as ret_2,
  {q6('ret_5')} as ret_5, {q6('ret_10')} as ret_10 from rets""")
def returns_lags(spark, folder):
    return six(X.add_returns(M.bars(spark, folder), K).select("series", "date", "ret_1", "ret_2", "ret_5", "ret_10"))


_VM = [(a, n) for n in X.RETURN_WINDOWS for a in ("volatility", "momentum")]


@query("rolling_vol_mom", with_(BARS, RETURNS) + "select series, date, " + ", ".join(
    f"{q6(roll('stddev_samp' if a == 'volatility' else 'avg', 'ret_1', n))} as {a}_{n}" for a, n in _VM) + " from rets")
def rolling_vol_mom(spark, folder):
    df = X.add_rolling_returns(X.add_returns(M.bars(spark, folder), K), K)
    return six(df.select("series", "date", *[f"{a}_{n}" for a, n in _VM]))


_SHAPE = f"{q6('(high - low) / nullif(close, 0)')} as hl_range, {q6('(close - open) / nullif(open, 0)')} as co_move"


@query("candle_shape", with_(BARS) + f"select series, date, {_SHAPE} from bars")
def candle_shape(spark, folder):
    return six(X.add_candle_shape(M.bars(spark, folder)).select("series", "date", "hl_range", "co_move"))


_VOL = f"""{q6('log_volume')} as log_volume, {q6(roll('avg', 'log_volume', 5))} as log_volume_mean_5,
  {q6(roll('avg', 'log_volume', 20))} as log_volume_mean_20,
  {q6(f"(log_volume - {roll('avg', 'log_volume', 20)}) / nullif({roll('stddev_samp', 'log_volume', 20)}, 0)")} as volume_zscore_20"""


@query("volume_features", with_(BARS, RETURNS) + f"select series, date, {_VOL} from rets")
def volume_features(spark, folder):
    df = X.add_volume_features(M.bars(spark, folder), K)
    return six(df.select("series", "date", "log_volume", "log_volume_mean_5", "log_volume_mean_20", "volume_zscore_20"))


_PARTS = """cast(isodow(date) - 1 as int) as day_of_week, cast(month(date) as int) as month,
  cast(day(date) as int) as day_of_month, cast(date = last_day(date) as int) as is_month_end"""


@query("calendar_parts", with_(BARS) + f"select series, date, {_PARTS} from bars")
def calendar_parts(spark, folder):
    df = X.add_calendar_parts(M.bars(spark, folder).select("series", "date"))
    return df.select("series", "date", "day_of_week", "month", "day_of_month", "is_month_end")


@query("targets_log", with_(BARS, RETURNS) + f"""select series, date, {q6('ln(next_ratio)')} as y,
  cast(coalesce(ln(next_ratio) > 0, false) as int) as y_dir from rets""")
def targets_log(spark, folder):
    return six(X.make_target(M.bars(spark, folder), K).select("series", "date", "y", "y_dir"))


@query("targets_simple", with_(BARS, RETURNS) + f"""select series, date, {q6('next_ratio - 1')} as y,
  cast(coalesce(next_ratio - 1 > 0, false) as int) as y_dir from rets
  qualify lead(date) {over()} is not null""")
def targets_simple(spark, folder):
    df = X.make_target(M.bars(spark, folder), K, "simple")
    return six(X.drop_last_row(df, K).select("series", "date", "y", "y_dir"))


_DIV = """b.*, coalesce(dividend_amount_t, 0.0) as amount, cast(coalesce(dividend_amount_t > 0, false) as int) as flag
  from bars b left join divs d on b.series = d.series and b.date = d.date"""


@query("dividend_join", with_(BARS, DIVIDENDS) + f"""select series, date, {q6('amount')} as dividend_amount_t,
  flag as dividend_flag_t from (select {_DIV})""")
def dividend_join(spark, folder):
    paid = prepare_dividends(M.dividends(spark, folder), K)
    df = J.join_dividends(M.bars(spark, folder), paid, K)
    return six(df.select("series", "date", "dividend_amount_t", "dividend_flag_t"))


@query("dividend_flags", with_(BARS, DIVIDENDS) + f"""select series, date, flag as dividend_flag_t,
  coalesce(lead(flag) {over()}, 0) as dividend_flag_t_plus_1 from (select {_DIV})""")
def dividend_flags(spark, folder):
    paid = prepare_dividends(M.dividends(spark, folder), K)
    df = X.add_dividend_flags(J.join_dividends(M.bars(spark, folder), paid, K), K, lead=True)
    return df.select("series", "date", "dividend_flag_t", "dividend_flag_t_plus_1")


@query("calendar_filter", with_(BARS, CALENDAR) + """select b.series, b.date, b.close from bars b
  where exists (select 1 from cal where cal.date = b.date and is_trading_day)""")
def calendar_filter(spark, folder):
    cal = prepare_calendar(M.calendar(spark, folder))
    return J.trading_days_only(M.bars(spark, folder), cal).select("series", "date", "close")


@query("context_features", with_(CTX_B, features_sql("ctx_b", "fx")) + f"""select date, {q6('ret_fx_1')} as ret_fx_1,
  {q6('ret_fx_mom_5')} as ret_fx_mom_5, {q6('ret_fx_vol_20')} as ret_fx_vol_20 from ctx_b_f""")
def context_features(spark, folder):
    ctx = M.context(spark, folder, urgent_only=True).withColumnRenamed("close", "close_fx")
    return six(X.context_features(ctx, "fx"))


_ASOF_B = """select b.series, b.date, c.close as ctx_close,
  coalesce(cast(date_diff('day', c.date, b.date) as double), 10000.0) as context_age_days_fx
  from bars b asof left join ctx_b c on b.date >= c.date"""


@query("asof_context", with_(BARS, CTX_B) + _ASOF_B)
def asof_context(spark, folder):
    ctx = M.context(spark, folder, urgent_only=True).withColumnRenamed("close", "ctx_close")
    df = J.merge_context(M.bars(spark, folder), ctx, "fx", ["ctx_close"])
    return df.select("series", "date", "ctx_close", "context_age_days_fx")


@query("asof_keyed", with_(BARS, """ret as (select l_suppkey as series, cast(l_shipdate as date) as date,
  sum(l_quantity) as returned_qty, max(case when l_linenumber > 2 then l_quantity end) as late_line_qty
  from lineitem where l_returnflag = 'R' group by 1, 2)""") + """select b.series, b.date, r.returned_qty, r.late_line_qty,
  coalesce(cast(date_diff('day', r.date, b.date) as double), 10000.0) as context_age_days_ret
  from bars b asof left join ret r on b.series = r.series and b.date >= r.date""")
def asof_keyed(spark, folder):
    ctx = M.keyed_context(spark, folder)
    df = J.merge_context(M.bars(spark, folder), ctx, "ret", ["returned_qty", "late_line_qty"], by=K)
    return df.select("series", "date", "returned_qty", "late_line_qty", "context_age_days_ret")


@query("context_from_joined_close", with_(BARS, CTX_A, """j as (select b.series, b.date, c.close as ctx from bars b
  left join ctx_a c on b.date = c.date)""", f"""r as (select *, ctx / nullif(lag(ctx) {over()}, 0) - 1 as ret_idx_1 from j)""")
  + f"""select series, date, {q6('ret_idx_1')} as ret_idx_1, {q6(roll('avg', 'ret_idx_1', 5))} as ret_idx_mom_5,
  {q6(roll('stddev_samp', 'ret_idx_1', 20))} as ret_idx_vol_20 from r""")
def context_from_joined_close(spark, folder):
    ctx = M.context(spark, folder).withColumnRenamed("close", "close_idx")
    joined = M.bars(spark, folder).join(J.by_day(ctx), "date", "left")
    df = X.make_features(joined, K, ["idx"])
    return six(df.select("series", "date", *X.context_columns("idx")))


_FEATURES = ["ret_1", "ret_2", "ret_5", "ret_10", *[f"{a}_{n}" for a, n in _VM], "hl_range", "co_move", "log_volume",
             "log_volume_mean_5", "log_volume_mean_20", "volume_zscore_20"]
_ALL_DAILY = with_(
    BARS, CTX_A, CTX_B, CALENDAR, DIVIDENDS, features_sql("ctx_a", "idx"), features_sql("ctx_b", "fx"),
    """joined as (
  select b.*, a.* exclude (date), coalesce(cast(date_diff('day', a.date, b.date) as double), 10000.0) as context_age_days_idx
  from bars b asof left join ctx_a_f a on b.date >= a.date)""",
    """joined2 as (
  select j.*, f.* exclude (date), coalesce(cast(date_diff('day', f.date, j.date) as double), 10000.0) as context_age_days_fx
  from joined j asof left join ctx_b_f f on j.date >= f.date)""",
    """kept as (
  select j.*, coalesce(d.dividend_amount_t, 0.0) as dividend_amount_t, cast(coalesce(d.dividend_amount_t > 0, false) as int) as dividend_flag_t
  from joined2 j semi join (select date from cal where is_trading_day) c on j.date = c.date
  left join divs d on j.series = d.series and j.date = d.date)""",
    RETURNS.replace("select series, date, open, high, low, nullif(close, 0) as close, volume from bars",
                    "select * replace (nullif(close, 0) as close) from kept"),
    "feat as (select series, date, open, high, low, close, volume, dividend_amount_t, dividend_flag_t, "
    "ret_1, ret_2, ret_5, ret_10, " + ", ".join(
        f"{roll('stddev_samp' if a == 'volatility' else 'avg', 'ret_1', n)} as {a}_{n}" for a, n in _VM)
    + ", (high - low) / close as hl_range, (close - open) / nullif(open, 0) as co_move, log_volume, "
    + f"{roll('avg', 'log_volume', 5)} as log_volume_mean_5, {roll('avg', 'log_volume', 20)} as log_volume_mean_20, "
    + f"(log_volume - {roll('avg', 'log_volume', 20)}) / nullif({roll('stddev_samp', 'log_volume', 20)}, 0) as volume_zscore_20, "
    + "ret_idx_1, ret_idx_mom_5, ret_idx_vol_20, context_age_days_idx, ret_fx_1, ret_fx_mom_5, ret_fx_vol_20, "
    + f"context_age_days_fx, {_PARTS}, ln(next_ratio) as y, cast(coalesce(ln(next_ratio) > 0, false) as int) as y_dir from rets)",
)
_DOUBLES = ["open", "high", "low", "close", "volume", "dividend_amount_t", *_FEATURES, *X.context_columns("idx"),
            "context_age_days_idx", *X.context_columns("fx"), "context_age_days_fx", "y"]
_INTS = ["dividend_flag_t", "day_of_week", "month", "day_of_month", "is_month_end", "y_dir"]


def dataset(spark, folder):
    """Model-ready panel with both contexts, the calendar and dividends."""
    return build_dataset(
        M.bars(spark, folder), K, {"idx": M.context(spark, folder), "fx": M.context(spark, folder, urgent_only=True)},
        M.calendar(spark, folder), M.dividends(spark, folder), clean=False,
    )


@query("features_daily", _ALL_DAILY + "select series, date, " + ", ".join(f"{q6(c)} as {c}" for c in _DOUBLES) + ", "
       + ", ".join(_INTS) + " from feat where " + " and ".join(f"{c} is not null" for c in _DOUBLES))
def features_daily(spark, folder):
    return six(dataset(spark, folder)).select("series", "date", *_DOUBLES, *_INTS)


_RANKED = [c for c in [*_DOUBLES, *_INTS] if c not in ("y", "y_dir")]


@query("all_correlations", _ALL_DAILY.rstrip() + ", ok as (select " + ", ".join(f"{q6(c)} as {c}" for c in _DOUBLES) + ", " + ", ".join(f"{c}::double as {c}" for c in _INTS)
       + " from feat where " + " and ".join(f"{c} is not null" for c in _DOUBLES) + "), "
       + f"long as (select y, unnest([{', '.join(repr(c) for c in _RANKED)}]) as feature, unnest([{', '.join(_RANKED)}]) as x from ok), "
       + "r as (select feature, rank() over (partition by feature order by x) + (count(*) over (partition by feature, x) - 1) / 2.0::double as rx, "
       "rank() over (partition by feature order by y) + (count(*) over (partition by feature, y) - 1) / 2.0::double as ry, x from long) "
       + f"select feature, {q6('corr(rx, ry)')} as spearman from r group by feature having min(x) < max(x) order by abs(corr(rx, ry)) desc, feature limit 20")
def all_correlations(spark, folder):
    """The 20 features that follow the target most closely, of all the features of the daily panel."""
    df = six(dataset(spark, folder))
    return six(R.top_correlations(df, "y", feature_columns(df, K), 20))


# --- indicators -------------------------------------------------------------------------------------


@query("atr", with_(BARS, f"pc as (select *, lag(close) {over()} as p from bars)",
       "tr as (select *, greatest(high - low, abs(high - p), abs(low - p)) as true_range from pc)",
       f"a as (select *, {roll('avg', 'true_range', 14)} as atr_14 from tr)")
       + f"select series, date, {q6('atr_14')} as atr_14, {q6('atr_14 / nullif(close, 0)')} as atr_pct_14 from a")
def atr(spark, folder):
    return six(X.add_atr(M.bars(spark, folder), K).select("series", "date", "atr_14", "atr_pct_14"))


_RUN = "over (partition by series order by date rows between unbounded preceding and current row)"


@query("obv", with_(BARS, f"s as (select *, coalesce(cast(sign(close - lag(close) {over()}) as double), 0.0) * volume as v from bars)")
       + f"select series, date, sum(v) {_RUN} as obv from s")
def obv(spark, folder):
    return X.add_obv(M.bars(spark, folder), K).select("series", "date", "obv")


@query("ad_line", with_(BARS, """s as (select *,
  coalesce(((close - low) - (high - close)) / nullif(high - low, 0), 0.0) * volume as v from bars)""")
  + f"select series, date, {q6(f'sum(v) {_RUN}')} as ad_line from s")
def ad_line(spark, folder):
    return six(X.add_accumulation(M.bars(spark, folder), K).select("series", "date", "ad_line"))


_MFI_W = "over (partition by series order by date rows between 13 preceding and current row)"


@query("mfi", with_(BARS, "tp as (select *, (high + low + close) / 3 as tp from bars)",
       f"ch as (select *, tp - lag(tp) {over()} as c from tp)",
       f"""fl as (select series, date, count(c) {_MFI_W} as n, sum(case when c > 0 then tp * volume else 0.0 end) {_MFI_W} as up,
  sum(case when c < 0 then tp * volume else 0.0 end) {_MFI_W} as down from ch)""")
  + f"select series, date, case when n = 14 then {q6('100 * up / nullif(up + down, 0)')} end as mfi_14 from fl")
def mfi(spark, folder):
    return six(X.add_mfi(M.bars(spark, folder), K).select("series", "date", "mfi_14"))


INTRADAY = with_(BARS_5M, """r as (select *, cast(ts as date) as date, close / nullif(lag(close) over
  (partition by series, cast(ts as date) order by ts), 0) - 1 as ret from bars_5m)""") + f"""select series, date,
  {q6('sum(close * volume) / nullif(sum(volume), 0)')} as daily_vwap, {q6('max(high) - min(low)')} as intraday_range,
  {q6('stddev_samp(ret)')} as intraday_vol,
  {q6('arg_max(close, ts) / nullif(sum(close * volume) / nullif(sum(volume), 0), 0) - 1')} as close_vs_vwap
  from r group by series, date"""


@query("intraday_rollup", INTRADAY)
def intraday_rollup(spark, folder):
    return six(X.intraday_rollup(M.bars_5m(spark, folder), K))
