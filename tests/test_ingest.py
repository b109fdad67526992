import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelmill.functions import symbol_list, to_number
from panelmill.operators import ingest as I
from panelmill.operators.prepare import check_dates, prepare_calendar, prepare_dated, prepare_dividends, prepare_bars
from panelmill.sources import readers as R
from panelmill.sources import snapshots as S
from panelmill.sources import writers as W
from panelmill.sources.schemas import CANDLES, TABLE_KEYS, INSTRUMENTS


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_dedup_keeps_last_and_is_idempotent(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, None)], "k string, seq int, v int")
    once = I.dedup_last(df, ["k"], ["seq"])
    assert rows(once, "k", "v") == [("a", 20), ("b", None)]
    assert rows(I.dedup_last(once, ["k"], ["seq"]), "k", "v") == rows(once, "k", "v")
    assert "WindowGroupLimit" in once._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        I.dedup_last(df, ["k"], [])


def test_null_keys_match_in_anti_join_and_upsert(spark):
    old = spark.createDataFrame([("a", None, 1), ("b", 1, 2)], "k string, d int, v int")
    new = spark.createDataFrame([("a", None, 9), ("c", None, 3)], "k string, d int, v int")
    assert rows(I.new_rows(new, old, ["k", "d"]), "k", "v") == [("c", 3)]
    merged = I.upsert(old, new, ["k", "d"])
    assert rows(merged, "k", "v") == [("a", 9), ("b", 2), ("c", 3)]
    assert rows(I.upsert(merged, new, ["k", "d"]), "k", "v") == rows(merged, "k", "v")


def test_history_start_rules(spark):
    inst = spark.createDataFrame(
        [("A", dt.datetime(2000, 1, 1), dt.datetime(2019, 1, 1)), ("B", dt.datetime(1970, 1, 1), dt.datetime(2000, 1, 1)), ("C", None, None)],
        "symbol string, first_1day_candle_date timestamp, first_1min_candle_date timestamp",
    )
    marks = spark.createDataFrame([("A", "1d", dt.datetime(2019, 6, 1)), ("C", "5m", dt.datetime(2020, 1, 1))], "symbol string, interval string, hwm timestamp")
    got = {(r.symbol, r.interval): r.start for r in I.resume_points(inst, marks, "2020-01-01").collect()}
    end = dt.datetime(2020, 1, 1)
    assert got == {
        ("A", "1d"): dt.datetime(2019, 6, 2), ("A", "5m"): dt.datetime(2019, 1, 1),
        ("B", "1d"): end - dt.timedelta(days=3650), ("B", "5m"): end - dt.timedelta(days=730),
        ("C", "1d"): end - dt.timedelta(days=3650),
    }
    assert I.resume_points(inst, marks, "2020-01-01", skip_done=False).count() == 6
    fixed = I.resume_points(inst, marks, "2020-01-01", start="2018-01-01", intervals=["1d"]).collect()
    assert {r.start for r in fixed if r.symbol != "A"} == {dt.datetime(2018, 1, 1)}


def test_instrument_choice(spark):
    cand = spark.createDataFrame([
        (1, "USDRUB", "u1", "USDRUBF", "usdrub future", "SPBFUT", True), (2, "USDRUB", "u2", "USD000UTSTOM", "usd", "CETS", False),
        (3, "ONLY", "u3", "ONLY", "x", "BAD", True), (4, "TIE", "u4", "T", "x", "Z", True), (5, "TIE", "u5", "T", "x", "Z", True),
        (6, "TIE", "", "TIE", "TIE", "Z", True),
    ], "ord int, symbol string, uid string, ticker string, name string, class_code string, tradable boolean")
    best = I.resolve_instruments(cand, ["ord"], {}, {"ONLY": ["BAD"], "USDRUB": ["SPBFUT"]})
    assert rows(best, "symbol", "uid", "score") == [("ONLY", "u3", 110), ("TIE", "u4", 10), ("USDRUB", "u2", 200)]


def test_bar_frame_coerces_and_requires_columns(spark):
    df = spark.createDataFrame(
        [(1, "2020-01-01", "1", "inf", "x", "4", None), (2, "2020-01-01T10:00:00Z", "2", "3", "1", "2", "7"), (3, "bad", "1", "1", "1", "1", "1")],
        "seq int, Date string, OPEN string, high string, low string, close string, Volume string",
    )
    got = prepare_bars(df, recency=["seq"]).collect()
    assert [(r.date, r.open, r.high, r.low, r.close, r.volume) for r in got] == [(dt.date(2020, 1, 1), 2.0, 3.0, 1.0, 2.0, 7.0)]
    with pytest.raises(ValueError):
        prepare_bars(df.drop("close"))
    assert prepare_bars(df.select("Date", "close"), suffix="fx").columns == ["date", "close_fx"]
    with pytest.raises(ValueError):
        prepare_bars(df.where("seq = 3"), validate=True)
    with pytest.raises(ValueError):
        check_dates(df.where("seq > 9").withColumn("date", F.lit(None)))
    assert [r.n for r in spark.range(1).select(to_number(F.lit("inf")).alias("n")).collect()] == [None]


def test_calendar_and_dividend_frames(spark):
    cal = prepare_calendar(spark.createDataFrame([("2020-01-01", None), ("2020-01-02", False)], "ts string, is_trading_day boolean"))
    assert rows(cal, "is_trading_day") == [(False,), (True,)]
    assert rows(prepare_calendar(spark.createDataFrame([("2020-01-01",)], "date string")), "is_trading_day") == [(True,)]
    div = spark.createDataFrame([("2020-01-01", "2"), ("2020-01-01", "0"), ("2020-01-02", None), (None, "5")], "record_date string, value string")
    assert rows(prepare_dividends(div), "dividend_amount_t", "dividend_flag_t") == [(1.0, 1), (3.0, 1)]
    assert rows(prepare_dividends(div.drop("value")), "dividend_amount_t") == [(1.0,), (2.0,)]
    dated = prepare_dated(spark.createDataFrame([(1, "2020-01-01 05:00:00"), (2, "2020-01-01 05:00:00"), (3, None)], "n int, time string"), recency=["n"])
    assert rows(dated, "n") == [(2,)]


def test_symbol_list_and_unknown_interval(spark):
    one = spark.range(1)
    assert one.select(symbol_list(" b,a,,B ,c").alias("s")).first().s == ["B", "A", "C"]
    from panelmill.functions import interval_names

    assert one.select(interval_names("D, 5min,1d").alias("s")).first().s == ["1d", "5m"]
    with pytest.raises(Exception, match="Unsupported interval"):
        spark.createDataFrame([("1h",)], "s string").select(interval_names(F.col("s"))).collect()


def candles(spark, days, volume, symbols=("A", "B")):
    data = [(s, "1d", dt.datetime(2020, 1, 1) + dt.timedelta(days=d), 1.0, volume) for s in symbols for d in days]
    return spark.createDataFrame(data, "symbol string, interval string, ts timestamp, close double, volume bigint")


def test_ingest_twice_is_ingest_once(spark, folder):
    path, parts = f"{folder}/candles", ["symbol", "interval", "year"]
    for batch in (candles(spark, range(300, 400), 1), candles(spark, range(350, 420), 2), candles(spark, range(350, 420), 3)):
        W.append_partitions(I.ingest_candles(batch, path, ["volume"]), path)
    schema = CANDLES
    back = R.read_candles(spark, path, "1d", ["A"], schema)
    assert rows(back.groupBy("volume").count(), "volume", "count") == [(1, 100), (2, 20)]
    assert "PartitionFilters: [isnotnull(interval" in back._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        R.read_candles(spark, path, "5m", schema=schema, require_rows=True)

    I.upsert_partitions(candles(spark, range(410, 415), 9).withColumn("year", F.year("ts")), path, TABLE_KEYS["candles"], parts)
    back = R.read_candles(spark, path, "1d", None, schema)
    assert rows(back.groupBy("volume").count(), "volume", "count") == [(1, 200), (2, 30), (9, 10)]

    I.reload_partitions(candles(spark, range(400, 402), 5, ["A"]).withColumn("year", F.year("ts")), path, parts)
    back = R.read_candles(spark, path, "1d", None, schema)
    assert rows(back.groupBy("symbol").count(), "symbol", "count") == [("A", 2), ("B", 120)]


def test_partition_writes_lose_nothing(spark, folder):
    path, parts = f"{folder}/notes", ["bucket", "year"]
    one = "symbol string, ts int, note string, bucket int, year int"
    stored = spark.createDataFrame([("A", 1, "y", 0, 2020), ("B", 1, "y", 0, 2020), ("A", 2, "n", None, None), ("C", 5, "c", 1, 2019)], one)
    I.upsert_partitions(stored, path, ["symbol", "ts"], parts)  # there is no table yet
    fresh = spark.createDataFrame([("A", 3, 7.0, 0, 2020), ("A", 4, 8.0, None, None)], "symbol string, ts int, px double, bucket int, year int")
    I.upsert_partitions(fresh, path, ["symbol", "ts"], parts)
    back = spark.read.option("mergeSchema", True).parquet(path)
    assert rows(back.where("px is null"), "symbol", "ts", "note") == [("A", 1, "y"), ("A", 2, "n"), ("B", 1, "y"), ("C", 5, "c")]
    assert rows(back.where("px > 0"), "symbol", "ts") == [("A", 3), ("A", 4)]

    I.reload_partitions(spark.createDataFrame([("A", 9, "new", 2, 2021), ("C", 6, "new", 1, 2020)], one), path, parts)
    back = spark.read.option("mergeSchema", True).parquet(path)
    assert rows(back, "symbol", "ts") == [("A", 9), ("B", 1), ("C", 6)]  # the folder of year 2019 and that of nulls are gone


def test_snapshots(spark, folder):
    path = f"{folder}/instruments"
    assert S.read_current(spark, path, INSTRUMENTS).count() == 0
    new = spark.createDataFrame([("A", "t1"), ("B", "t2")], "symbol string, ticker string")
    schema = new.schema
    assert S.upsert_table(new, path, schema, ["symbol"]) == 1
    assert S.upsert_table(spark.createDataFrame([("A", "t9")], schema), path, schema, ["symbol"]) == 2
    assert rows(S.read_current(spark, path, schema), "symbol", "ticker") == [("A", "t9"), ("B", "t2")]


def test_readers_and_writers(spark, folder):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1.5)], "date date, v double")
    for name in ("a.parquet", "a.csv"):
        W.save_dataset(df, f"{folder}/{name}")
        got = R.load_dataset(spark, f"{folder}/{name}")
        assert got.first().date == dt.date(2020, 1, 1)
    with pytest.raises(ValueError):
        W.save_dataset(df, f"{folder}/a.xls")
    with pytest.raises(ValueError):
        R.read_table(spark, f"{folder}/a.xls")
    with pytest.raises(FileNotFoundError):
        R.read_table(spark, f"{folder}/none.parquet")
    assert R.try_read(spark, f"{folder}/none.parquet") is None and R.try_read(spark, f"{folder}/x.doc") is None
    empty = R.read_if_exists(spark, f"{folder}/none.parquet", df.schema, ["v"])
    assert empty.columns == ["v"] and empty.isEmpty()
    W.save_json(spark, {"a": 1, "b": None}, f"{folder}/j")
    assert W.load_json(spark, f"{folder}/j") == {"a": 1, "b": None}


def test_texts_without_a_zone_are_utc_in_any_session(spark):
    from panelmill.functions import to_day, to_instant

    rows_in = [("2020-01-01 23:00:00",), ("2020-07-01",), ("2020-01-01T23:00:00+03:00",), ("2020-01-01 01:30:00 Europe/Paris",), ("2020-03-08 02:30:00",), ("no date",), (None,)]
    df = spark.createDataFrame(rows_in, "d string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = df.select(to_day(df, "d").cast("string").alias("day"), F.unix_micros(to_instant(df, "d")).alias("at")).collect()
        start = spark.range(1).select(F.unix_micros(I.history_start("2020-01-01", F.lit("1d"), F.lit(None), F.lit(None), F.lit(None))).alias("at")).first().at
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.day for r in got] == ["2020-01-01", "2020-07-01", "2020-01-01", "2020-01-01", "2020-03-08", None, None]
    assert [r.at and r.at // 1_000_000 for r in got] == [1577919600, 1593561600, 1577908800, 1577838600, 1583634600, None, None]
    assert start == 1577836800 * 1_000_000


def test_the_last_line_of_a_file_wins_without_recency(spark, folder):
    lines = ["date,open,high,low,close,volume"] + [f"2024-01-{d:02d},{v},{v},{v},{v},{v}" for v, d in enumerate([2, 3, 2, 4, 3, 2, 5] * 300, 1)]
    with open(f"{folder}/bars.csv", "w") as out:
        out.write("\n".join(lines) + "\n")
    want = {}
    for line in lines[1:]:
        day, v = line.split(",")[:2]
        want[day] = float(v)
    csv = R.read_table(spark, f"{folder}/bars.csv")
    assert {str(r.date): r.close for r in prepare_bars(csv).collect()} == want
    csv.coalesce(1).write.parquet(f"{folder}/bars.parquet")
    for df in (R.read_table(spark, f"{folder}/bars.parquet"), R.read_table(spark, f"{folder}/bars.parquet").where("open > 0").withColumn("x", F.lit(1))):
        assert {str(r.date): r.close for r in prepare_bars(df).collect()} == want
    assert {str(r.date)[:10]: r.close for r in prepare_dated(csv).collect()} == {d: str(int(v)) for d, v in want.items()}
    small = spark.createDataFrame([("2024-01-02", 1.0), ("2024-01-02", 2.0)], "date string, close double")
    assert R.input_order(small) is None and prepare_dated(small).first().close == 2.0
