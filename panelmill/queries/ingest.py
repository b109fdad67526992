"""Keep-last, coercion, incremental ingest, nested records and instrument resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill.functions import interval_name, interval_names, symbol_list, to_number
from panelmill.operators import ingest as I
from panelmill.operators.prepare import prepare_dated, prepare_bars
from panelmill.queries.base import BARS, BARS_5M, INSTRUMENTS, q6, query, six, with_
from panelmill.session import scratch_path
from panelmill.sources import views as M
from panelmill.sources import nested as N
from panelmill.sources.readers import load_dataset, read_candles, read_if_exists
from panelmill.sources.writers import append_partitions, save_dataset, with_symbol_bucket

K = M.KEYS
DAY = ["series", "date"]

LATE = """late as (
  select * from bars where date >= date '2001-01-01'
  union all select * replace (volume + 1 as volume) from bars where year(date) = 2000),
old as (select * from bars where date < date '2001-01-01')"""


def _stored(spark, folder):
    return M.bars(spark, folder).where(F.col("date") < F.lit("2001-01-01").cast("date"))


@query("dedup_last", """select l_suppkey as series, cast(l_shipdate as date) as date, l_orderkey, l_linenumber, l_quantity, l_extendedprice
  from lineitem qualify row_number() over (partition by l_suppkey, l_shipdate
  order by l_orderkey desc, l_linenumber desc, l_partkey desc, l_extendedprice desc, l_quantity desc) = 1""")
def dedup_last(spark, folder):
    rows = M.table(spark, folder, "lineitem").withColumn("date", F.to_date("l_shipdate")).withColumnRenamed("l_suppkey", "series")
    last = I.dedup_last(rows.select("series", "date", *M.TRADE_ORDER), DAY, M.TRADE_ORDER)
    return last.select("series", "date", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


_NUM = "case when abs(v) < 'infinity'::double then v end"


def _clean(text: str) -> str:
    return _NUM.replace("v)", f"try_cast({text} as double))").replace("then v", f"then try_cast({text} as double)")


def dirty_sql() -> str:
    return """dirty as (
  select series, 1 as seq, cast(date as varchar) as d, cast(open as varchar) as o, cast(high as varchar) as h,
         cast(low as varchar) as l, cast(close as varchar) as c, cast(volume as varchar) as v from bars
  union all
  select series, 2, case when day(date) = 31 then 'not a date' else cast(date as varchar) end,
         case when day(date) = 1 then 'inf' else cast(open as varchar) end,
         cast(case when day(date) = 2 then low - 1 else high end as varchar),
         case when day(date) = 3 then 'n/a' else cast(low as varchar) end,
         case when day(date) = 4 then '-1.0' else cast(close as varchar) end,
         case day(date) when 5 then '0' when 6 then '-3' else cast(volume + 1 as varchar) end from bars)"""


@query("coerce_columns", with_(BARS, dirty_sql())
  + f"""select series, try_cast(d as date) as date, {_clean('o')} as open, {_clean('h')} as high, {_clean('l')} as low,
  {_clean('c')} as close, {_clean('v')} as volume from dirty where try_cast(d as date) is not null
  qualify row_number() over (partition by series, try_cast(d as date) order by seq desc) = 1""")
def coerce_columns(spark, folder):
    return prepare_bars(M.dirty_bars(spark, folder), K, recency=["seq"])


@query("high_water_mark", with_(BARS) + "select series, max(date) as hwm from bars group by series")
def high_water_mark(spark, folder):
    return I.high_water_mark(M.bars(spark, folder), K, "date")


_END = "timestamp '2002-01-01'"


@query("resume_points", with_(BARS, INSTRUMENTS, f"""marks as (select 'S' || series as symbol, '1d' as interval, max(date) as hwm
  from bars group by series), plan as (
  select symbol, unnest(['1d', '5m']) as interval, first_day, first_minute from instruments)""") + f"""
select * from (select p.symbol, p.interval, greatest(
  case when p.interval = '1d' then case when first_day >= timestamp '1990-01-01' and first_day < {_END} then first_day
         else {_END} - interval 3650 days end
       else case when first_minute >= timestamp '1990-01-01' and first_minute < {_END}
         then greatest({_END} - interval 730 days, first_minute) else {_END} - interval 730 days end end,
  cast(hwm as timestamp) + interval 1 day) as start
from plan p left join marks m on p.symbol = m.symbol and p.interval = m.interval) where start < {_END}""")
def resume_points(spark, folder):
    marks = I.high_water_mark(M.bars(spark, folder), K, "date").select(
        F.concat(F.lit("S"), F.col("series").cast("string")).alias("symbol"), F.lit("1d").alias("interval"), "hwm"
    )
    plan = I.resume_points(M.instruments(spark, folder), marks, "2002-01-01")
    return plan.select("symbol", "interval", F.col("start").cast("timestamp_ntz").alias("start"))


_FIRST_1D = f"""case when first_day >= timestamp '1990-01-01' and first_day < {_END} then first_day else {_END} - interval 3650 days end"""


@query("resume_dividends", with_(INSTRUMENTS, """marks as (select 'S' || l_suppkey as symbol, max(l_shipdate) as hwm from lineitem
  where l_returnflag = 'R' group by 1)""") + f"""select symbol, greatest({_FIRST_1D}, hwm + interval 1 day) as start
  from instruments left join marks using (symbol)""")
def resume_dividends(spark, folder):
    marks = I.high_water_mark(M.dividends(spark, folder), K, "record_date").select(
        F.concat(F.lit("S"), F.col("series").cast("string")).alias("symbol"), "hwm")
    plan = I.resume_dividends(M.instruments(spark, folder), marks, "2002-01-01")
    return plan.select("symbol", F.col("start").cast("timestamp_ntz").alias("start"))


@query("resume_schedules", with_(INSTRUMENTS, """marks as (select 'NATION_' || (o_custkey % 20) as exchange, max(o_orderdate) as hwm
  from orders group by 1)""") + f"""select * from (select exchange, greatest((select min({_FIRST_1D}) from instruments), hwm + interval 1 day) as start
  from (select distinct exchange from instruments) left join marks using (exchange)) where start < {_END}""")
def resume_schedules(spark, folder):
    stored = M.table(spark, folder, "orders").select(
        F.concat(F.lit("NATION_"), (F.col("o_custkey") % 20).cast("string")).alias("exchange"), "o_orderdate")
    plan = I.resume_schedules(M.instruments(spark, folder), I.high_water_mark(stored, ["exchange"], "o_orderdate"), "2002-01-01")
    return plan.select("exchange", F.col("start").cast("timestamp_ntz").alias("start"))


@query("dated_frame", """select user_id, ts as date, value from events
  qualify row_number() over (partition by user_id, ts order by event_id desc) = 1""")
def dated_frame(spark, folder):
    """Timestamps kept to the microsecond, one row per user and instant."""
    out = prepare_dated(M.table(spark, folder, "events"), ["user_id"], ["event_id"])
    return out.select("user_id", F.col("date").cast("timestamp_ntz").alias("date"), "value")


@query("saved_dataset", with_(BARS) + f"select series, date, {q6('open')} as open, {q6('close')} as close, volume from bars")
def saved_dataset(spark, folder):
    """A dataset saved as CSV and loaded again as text, then coerced."""
    path = scratch_path(spark, "saved") + ".csv"
    save_dataset(M.bars(spark, folder), path)
    back = load_dataset(spark, path)
    return six(back.select(
        F.col("series").cast("bigint").alias("series"), "date", *[to_number(F.col(c)).alias(c) for c in ("open", "close", "volume")]
    ))


@query("new_rows_anti", with_(BARS, LATE) + "select l.* from late l anti join old o on l.series = o.series and l.date = o.date")
def new_rows_anti(spark, folder):
    return I.new_rows(M.late_batch(spark, folder), _stored(spark, folder), DAY)


@query("upsert_union", with_(BARS, LATE) + """select o.* from old o anti join late l on l.series = o.series and l.date = o.date
  union all select * from late""")
def upsert_union(spark, folder):
    return I.upsert(_stored(spark, folder), M.late_batch(spark, folder), DAY)


_RELOAD = "series % 7 = 3"


@query("full_reload", with_(BARS, LATE) + f"""select o.* from old o where not ({_RELOAD}) union all
  select * from late where {_RELOAD}""")
def full_reload(spark, folder):
    batch = M.late_batch(spark, folder).where(F.col("series") % 7 == 3)
    return I.full_reload(_stored(spark, folder), batch, "series")


@query("concat_frames", with_(BARS, LATE) + """select series, date, volume, null::double as returned_qty from late
  union all select l_suppkey, cast(l_shipdate as date), null, sum(l_quantity) from lineitem where l_returnflag = 'R' group by 1, 2""")
def concat_frames(spark, folder):
    returned = M.keyed_context(spark, folder).drop("late_line_qty")
    return I.union_all(M.late_batch(spark, folder).select("series", "date", "volume"), returned)


@query("partitioned_candles", with_(BARS, BARS_5M) + """select symbol, interval, cast(year(ts) as int) as year, count(*) as bars,
  max(ts) as last_ts from (
  select 'S' || series as symbol, '1d' as interval, cast(date as timestamp) as ts from bars
  union all select series, '5m', ts from bars_5m) where interval = '5m' or year(ts) >= 2000 group by 1, 2, 3""")
def partitioned_candles(spark, folder):
    """Two intervals written to partitions and read back with pruning filters."""
    daily = M.bars(spark, folder).select(
        F.concat(F.lit("S"), F.col("series").cast("string")).alias("symbol"), F.lit("1d").alias("interval"),
        F.col("date").cast("timestamp_ntz").alias("ts"), "close", "volume",
    )
    minute = M.bars_5m(spark, folder).select(F.col("series").alias("symbol"), F.lit("5m").alias("interval"), "ts", "close", "volume")
    path = scratch_path(spark, "candles")
    parts = ["interval", "year", "symbol_bucket"]
    for frame in (daily, minute):
        append_partitions(with_symbol_bucket(frame.withColumn("year", F.year("ts")), 4), path, parts)
    layout = "symbol string, interval string, year int, symbol_bucket int, ts timestamp_ntz, close double, volume double"
    recent = read_candles(spark, path, "1d", schema=layout).where(F.col("year") >= 2000)
    stored = I.union_all(recent, read_candles(spark, path, "5m", schema=layout))
    return stored.groupBy("symbol", "interval", F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("bars"), F.max("ts").alias("last_ts")
    )


@query("incremental_ingest", with_(BARS, LATE) + """select 'S' || series as symbol, cast(date as timestamp) as ts, close, volume from old
  union all select 'S' || l.series, cast(l.date as timestamp), l.close, l.volume from late l
  anti join old o on l.series = o.series and l.date = o.date""")
def incremental_ingest(spark, folder):
    """History, then a late batch: only keys that are not stored are appended."""
    def candles(df):
        return df.select(
            F.concat(F.lit("S"), F.col("series").cast("string")).alias("symbol"), F.lit("1d").alias("interval"),
            F.col("date").cast("timestamp_ntz").alias("ts"), "close", "volume",
        )

    path = scratch_path(spark, "ingest")
    parts = ["interval", "year"]
    for batch in (_stored(spark, folder), M.late_batch(spark, folder)):
        fresh = I.ingest_candles(candles(batch), path, ["volume"], parts)
        append_partitions(fresh, path, parts)
    return spark.read.parquet(path).select("symbol", "ts", "close", "volume")


@query("partition_upsert", with_(BARS, LATE) + """select o.series, o.date, o.close, o.volume, cast(year(o.date) as int) as year from old o
  anti join late l on l.series = o.series and l.date = o.date
  union all select series, date, close, volume, cast(year(date) as int) from late""")
def partition_upsert(spark, folder):
    """Keep-last upsert that rewrites only the years the batch touches."""
    path = scratch_path(spark, "upserted")
    cols = ["series", "date", "close", "volume"]
    append_partitions(_stored(spark, folder).select(*cols, F.year("date").alias("year")), path, ["year"], sort=DAY)
    batch = M.late_batch(spark, folder).select(*cols, F.year("date").alias("year"))
    I.upsert_partitions(batch, path, DAY, ["year"])
    return spark.read.parquet(path).withColumn("year", F.col("year").cast("int"))


@query("upsert_first_load", with_(BARS, LATE) + "select series, date, volume, cast(year(date) as int) as year from late")
def upsert_first_load(spark, folder):
    """An upsert into a table that does not exist yet."""
    path = scratch_path(spark, "first")
    I.upsert_partitions(M.late_batch(spark, folder).select("series", "date", "volume", F.year("date").alias("year")), path, DAY, ["year"])
    return spark.read.parquet(path).withColumn("year", F.col("year").cast("int"))


@query("upsert_new_columns", with_(BARS, LATE) + """select o.series, o.date, o.volume, 'stored' as note, null::double as close, cast(year(o.date) as int) as year
  from old o anti join late l on l.series = o.series and l.date = o.date
  where year(o.date) in (select year(date) from late)
  union all select series, date, volume, null, close, cast(year(date) as int) from late
  union all select o.series, o.date, o.volume, 'stored', null, cast(year(o.date) as int) from old o where year(o.date) not in (select year(date) from late)""")
def upsert_new_columns(spark, folder):
    """A batch that lacks a stored column and brings another: no stored value is lost."""
    path = scratch_path(spark, "columns")
    first = _stored(spark, folder).select("series", "date", "volume", F.lit("stored").alias("note"), F.year("date").alias("year"))
    append_partitions(first, path, ["year"], sort=DAY)
    I.upsert_partitions(M.late_batch(spark, folder).select("series", "date", "volume", "close", F.year("date").alias("year")), path, DAY, ["year"])
    back = spark.read.option("mergeSchema", True).parquet(path)
    return back.select("series", "date", "volume", "note", "close", F.col("year").cast("int").alias("year"))


@query("bucket_reload", with_(BARS, LATE) + f"""select series, date, volume from old where not ({_RELOAD})
  union all select series, date, volume from late where {_RELOAD} and year(date) = 2001""")
def bucket_reload(spark, folder):
    """Some series reloaded on a layout in which all series share the partitions; years they no longer have are kept for the others."""
    path = scratch_path(spark, "buckets")
    cols = ["series", "date", "volume", F.year("date").alias("year"), (F.col("series") % 3).alias("bucket")]
    append_partitions(_stored(spark, folder).select(*cols), path, ["bucket", "year"], sort=DAY)
    batch = M.late_batch(spark, folder).where((F.col("series") % 7 == 3) & (F.year("date") == 2001)).select(*cols)
    I.reload_partitions(batch, path, ["bucket", "year"], "series")
    return spark.read.parquet(path).select("series", "date", "volume")


@query("read_if_exists", with_(BARS) + """select series, date, close from bars where year(date) = 1998""")
def read_existing(spark, folder):
    """Filtered, pruned read of a stored table, unioned with the empty result of a missing one."""
    path = scratch_path(spark, "stored")
    df = M.bars(spark, folder)
    df.write.parquet(path)
    cond = F.year("date") == 1998
    here = read_if_exists(spark, path, df.schema, ["series", "date", "close"], cond)
    gone = read_if_exists(spark, path + "-missing", df.schema, ["series", "date", "close"], cond)
    return here.unionByName(gone)


# --- nested records ---------------------------------------------------------------------------------


def _quotation(col):
    units = F.floor(col)
    return F.struct(units.cast("bigint").alias("units"), F.floor((col - units) * 1e9 + 0.5).cast("int").alias("nano"))


@query("nested_candles", with_(BARS, INSTRUMENTS) + f"""select symbol, ticker, figi, instrument_id, '1d' as interval, date as day,
  {q6('open')} as open, {q6('high')} as high, {q6('low')} as low, {q6('close')} as close, cast(volume as bigint) as volume
  from bars join instruments using (series)""")
def nested_candles(spark, folder):
    records = M.bars(spark, folder).select(
        F.concat(F.lit("uid-"), F.col("series").cast("string")).alias("instrument_id"), F.lit(" 1D ").alias("interval"),
        F.col("date").alias("time"), *[_quotation(F.col(c)).alias(c) for c in ("open", "high", "low", "close")],
        F.col("volume").cast("bigint").alias("volume"),
    )
    return six(N.flatten_candles(records, M.instruments(spark, folder)).withColumnRenamed("ts", "day"))


@query("nested_schedules", """select distinct o_orderpriority as exchange, cast(o_orderdate as date) as date,
  isodow(cast(o_orderdate as date)) <= 5 as is_trading_day from orders""")
def nested_schedules(spark, folder):
    day = F.to_date("o_orderdate")
    days = M.table(spark, folder, "orders").select(F.col("o_orderpriority").alias("exchange"), day.alias("date")).distinct()
    # one entry per calendar day, so the arrays are as long as the calendar
    nested = days.groupBy("exchange").agg(
        F.collect_list(F.struct("date", (F.weekday("date") < 5).alias("is_trading_day"))).alias("days")
    )
    response = nested.select(F.array(F.struct("exchange", "days")).alias("exchanges"))
    return N.flatten_schedules(response)


@query("nested_dividends", f"""select 'S' || l_suppkey as symbol, cast(l_shipdate as date) as record_date,
  {q6('l_discount')} as dividend_net, case when l_linenumber % 2 = 0 then 'ANNUAL' else 'QUARTERLY' end as regularity
  from lineitem where l_returnflag = 'R'""")
def nested_dividends(spark, folder):
    returned = M.table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    day = F.to_date("l_shipdate")
    none = F.lit(None).cast("struct<units:bigint,nano:int>")
    item = F.struct(
        day.alias("last_buy_date"), day.alias("record_date"), day.alias("payment_date"), day.alias("declared_date"),
        day.alias("created_at"), _quotation(F.col("l_discount")).alias("dividend_net"), none.alias("close_price"),
        none.alias("yield_value"), F.when(F.col("l_linenumber") % 2 == 0, "ANNUAL").otherwise("QUARTERLY").alias("regularity"),
        F.lit("CASH").alias("dividend_type"),
    )
    response = returned.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"), F.array(item).alias("dividends")
    )
    return six(N.flatten_dividends(response).select("symbol", "record_date", "dividend_net", "regularity"))


@query("status_lookup", with_(INSTRUMENTS) + """select case when series % 5 = 4 then null else symbol end as symbol,
  case when series % 5 < 3 then instrument_id else 'uid-unknown' end as instrument_id,
  case when series % 5 = 4 then 'figi-unknown' else figi end as figi,
  case when series % 2 = 0 then 'NORMAL' else 'BREAK' end as trading_status, series % 3 = 0 as api_trade_available_flag from instruments""")
def status_lookup(spark, folder):
    inst = M.instruments(spark, folder)
    m = F.col("series") % 5
    statuses = inst.select(
        F.when(m < 3, F.col("instrument_id")).otherwise("uid-unknown").alias("instrument_id"),
        F.when(m == 4, "figi-unknown").otherwise(F.col("figi")).alias("figi"),
        F.when(F.col("series") % 2 == 0, "NORMAL").otherwise("BREAK").alias("trading_status"),
        (F.col("series") % 3 == 0).alias("api_trade_available_flag"),
    )
    return N.label_statuses(statuses, inst).drop("loaded_at")


_HINTS = {"NATION_1": ["C2"], "USDRUB": ["CETS"]}
_BANNED = {"NATION_2": ["C1", "C3"], "NATION_3": ["C0", "C1", "C2", "C3"], "USDRUB": ["SPBFUT"]}
_CANDIDATES = """cand as (
  select * from (
    select case when series % 11 = 0 then 'USDRUB' else exchange end as symbol, series as ord, instrument_id as uid,
      case when series % 11 = 0 then case when series % 2 = 0 then 'USD000UTSTOM' else 'USDF' end
           when series % 4 = 0 then exchange when series % 4 = 1 then exchange || 'X' else ticker end as ticker,
      case when series % 3 = 0 then 'The ' || exchange || ' share' else name end as name,
      case when series % 11 = 0 then case when series % 3 = 0 then 'CETS' else 'SPBFUT' end else class_code end as class_code,
      series % 2 = 1 as tradable from instruments)),
scored as (
  select *, not ((symbol = 'NATION_2' and class_code in ('C1', 'C3')) or symbol = 'NATION_3'
               or (symbol = 'USDRUB' and class_code = 'SPBFUT')) as allowed,
    case when upper(ticker) = symbol then 100 when starts_with(upper(ticker), symbol) then 30 else 0 end
    + case when contains(upper(name), symbol) then 20 else 0 end + case when tradable then 10 else 0 end
    + case when (symbol = 'NATION_1' and class_code = 'C2') or (symbol = 'USDRUB' and class_code = 'CETS') then 25 else 0 end
    + case when symbol = 'USDRUB' and class_code in ('CETS', 'ETS') then 120 else 0 end
    + case when symbol = 'USDRUB' and ticker in ('USD000UTSTOM', 'USDRUB', 'USD000000TOD') then 80 else 0 end
    - case when symbol = 'USDRUB' and (class_code in ('SPBFUT', 'FUT') or ticker like '%F') then 100 else 0 end as score
  from cand)"""


@query("resolve_instruments", with_(INSTRUMENTS, _CANDIDATES) + """select symbol, uid, ticker, class_code, allowed, cast(score as int) as score
  from scored qualify row_number() over (partition by symbol order by allowed desc, score desc, ord) = 1""")
def resolve_instruments(spark, folder):
    s = F.col("series")
    pair = s % 11 == 0
    cand = M.instruments(spark, folder).select(
        F.when(pair, "USDRUB").otherwise(F.col("exchange")).alias("symbol"), s.alias("ord"), F.col("instrument_id").alias("uid"),
        F.when(pair, F.when(s % 2 == 0, "USD000UTSTOM").otherwise("USDF"))
        .when(s % 4 == 0, F.col("exchange")).when(s % 4 == 1, F.concat("exchange", F.lit("X"))).otherwise(F.col("ticker")).alias("ticker"),
        F.when(s % 3 == 0, F.concat(F.lit("The "), "exchange", F.lit(" share"))).otherwise(F.col("name")).alias("name"),
        F.when(pair, F.when(s % 3 == 0, "CETS").otherwise("SPBFUT")).otherwise(F.col("class_code")).alias("class_code"),
        (s % 2 == 1).alias("tradable"),
    )
    twice = cand.unionByName(cand.withColumn("ord", F.col("ord") + 1_000_000_000))
    best = I.resolve_instruments(twice, ["ord"], _HINTS, _BANNED)
    return best.select("symbol", "uid", "ticker", "class_code", "allowed", F.col("score").cast("int").alias("score"))


@query("symbol_lists", """select o_orderpriority as raw, list_aggregate(list_filter(list_transform(string_split(
  o_orderpriority || ', ' || lower(o_orderpriority) || ',,' || o_orderstatus, ','), lambda s: upper(trim(s))), lambda s: s <> ''), 'string_agg', '|') as listed,
  count(*) as n from orders group by o_orderpriority, o_orderstatus""".replace(
      "list_aggregate(list_filter(", "(select string_agg(s, '|' order by i) from (select s, min(i) as i from (select unnest(v) as s, generate_subscripts(v, 1) as i from (select list_filter("
  ).replace("lambda s: s <> ''), 'string_agg', '|') as listed", "lambda s: s <> '') as v)) group by s)) as listed"))
def symbol_lists(spark, folder):
    """Symbol list normalisation on composed text: trimmed, upper case, blanks and repeats removed."""
    p = F.col("o_orderpriority")
    raw = F.concat(p, F.lit(", "), F.lower(p), F.lit(",,"), "o_orderstatus")
    return M.table(spark, folder, "orders").groupBy(p.alias("raw"), F.array_join(symbol_list(raw), "|").alias("listed")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("interval_aliases", """select case when value < 50 then '1d' else '5m' end as interval,
  case when value < 50 then '1d' else '5m,1d' end as listed, count(*) as n from events where value is not null group by 1, 2""")
def interval_aliases(spark, folder):
    v = to_number(F.col("value").cast("string"))
    spelled = F.when(v < 25, " Day").when(v < 50, "d ").when(v < 75, "5MIN").otherwise("5m")
    listed = F.when(v < 50, "1d,day, D").otherwise("5min,1d,5m")
    ev = M.table(spark, folder, "events").where(v.isNotNull())
    return ev.groupBy(
        interval_name(spelled).alias("interval"), F.array_join(interval_names(listed), ",").alias("listed")
    ).agg(F.count(F.lit(1)).alias("n"))
