"""Registry: each query's Spark function next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from panelmill.functions.columns import quantise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def six(df: DataFrame) -> DataFrame:
    """Every double to six digits, the precision results are compared at."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)}
    return df.select(*[quantise(F.col(c), 6).alias(c) if c in doubles else F.col(c) for c in df.columns])


def q6(expr: str) -> str:
    return f"floor(({expr})*1000000+0.5)/1000000"


def q10(expr: str) -> str:
    return f"floor(({expr})*10000000000+0.5)/10000000000"


def q4(expr: str) -> str:
    return f"floor(({expr})*10000+0.5)/10000"


# --- shared SQL: bar views of the tables ---------------------------------------------------------

BARS = f"""trades as (
  select l_suppkey as series, cast(l_shipdate as date) as date, l_extendedprice / l_quantity as px, l_quantity as qty,
         row_number() over (partition by l_suppkey, l_shipdate
           order by l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) as rn,
         count(*) over (partition by l_suppkey, l_shipdate) as n
  from lineitem),
bars as (
  select series, date, {q4('max(case when rn = 1 then px end)')} as open, {q4('max(px)')} as high,
         {q4('min(px)')} as low, {q4('max(case when rn = n then px end)')} as close, sum(qty) as volume
  from trades group by series, date)"""


def ctx_sql(name: str, where: str = "true") -> str:
    cents = "cast(cast(sum(cast(floor(o_totalprice*100+0.5) as bigint)) as bigint) as double)"
    return f"""{name} as (
  select cast(o_orderdate as date) as date, {q4(f'{cents}/100.0/count(*)')} as close
  from orders where {where} group by 1)"""


CTX_A = ctx_sql("ctx_a")
CTX_B = ctx_sql("ctx_b", "o_orderpriority = '1-URGENT'")
CALENDAR = """cal as (
  select distinct cast(o_orderdate as date) as date, isodow(cast(o_orderdate as date)) <= 5 as is_trading_day from orders)"""
DIVIDENDS = """divs as (
  select l_suppkey as series, cast(l_shipdate as date) as date,
         sum(case when l_discount = 0 then 1.0 else l_discount end) as dividend_amount_t
  from lineitem where l_returnflag = 'R' group by 1, 2)"""
BARS_5M = """slots as (
  select event_type as series, time_bucket(interval '5 minutes', ts) as slot, ts, event_id, value from events),
bars_5m as (
  select series, slot as ts, arg_min(value, (ts, event_id)) as open, max(value) as high, min(value) as low,
         arg_max(value, (ts, event_id)) as close, cast(count(*) as double) as volume
  from slots group by series, slot)"""
INSTRUMENTS = """instruments as (
  select s_suppkey as series, 'S' || s_suppkey as symbol, upper(s_name) as ticker, 'uid-' || s_suppkey as instrument_id,
         'figi-' || s_suppkey as figi, 'C' || (s_suppkey % 4) as class_code, n_name as exchange,
         'CUR' || n_regionkey as currency, s_name as name,
         case s_suppkey % 3 when 1 then timestamp '1980-01-01' when 2 then timestamp '1996-05-01' end as first_day,
         case when s_suppkey % 2 = 0 then timestamp '2001-06-01' end as first_minute
  from supplier join nation on s_nationkey = n_nationkey)"""


def roll(agg: str, col: str, rows: int, key: str = "partition by series ") -> str:
    over = f"over ({key}order by date rows between {rows - 1} preceding and current row)"
    return f"case when count({col}) {over} = {rows} then {agg}({col}) {over} end"


def over(key: str = "partition by series ") -> str:
    return f"over ({key}order by date)"


RETURNS = f"""rets as (
  select *, close / nullif(lag(close, 1) {over()}, 0) - 1 as ret_1, close / nullif(lag(close, 2) {over()}, 0) - 1 as ret_2,
         close / nullif(lag(close, 5) {over()}, 0) - 1 as ret_5, close / nullif(lag(close, 10) {over()}, 0) - 1 as ret_10,
         lead(close) {over()} / nullif(close, 0) as next_ratio, ln(greatest(volume, 1.0)) as log_volume
  from (select series, date, open, high, low, nullif(close, 0) as close, volume from bars))"""

PREDS = f"""{BARS},
{RETURNS},
sig as (
  select series, date, {q10('ln(next_ratio) / 100')} as y, cast(coalesce(next_ratio > 1, false) as int) as y_dir,
         {q10(roll('avg', 'ret_1', 5) + ' / 100')} as pred, {q10(roll('stddev_samp', 'ret_1', 20) + ' / 200')} as half from rets),
preds as (
  select series, date, y, y_dir, pred, pred - half as q_low, pred + half as q_high
  from sig where y is not null and pred is not null and half is not null)"""


def features_sql(source: str, prefix: str, key: str = "") -> str:
    """Context features of table ``source`` on its own calendar."""
    one = f"close / nullif(lag(close) over ({key}order by date), 0) - 1"
    return f"""{source}_r as (select date, {one} as r from {source}),
{source}_f as (
  select date, r as ret_{prefix}_1, {roll('avg', 'r', 5, key)} as ret_{prefix}_mom_5,
         {roll('stddev_samp', 'r', 20, key)} as ret_{prefix}_vol_20 from {source}_r)"""


def with_(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"
