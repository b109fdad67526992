"""Keep-last, high-water marks, new-row filters, upserts and instrument resolution."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from panelmill.functions.columns import text_instant
from panelmill.session import Stored
from panelmill.sources.readers import read_if_exists
from panelmill.sources.writers import replace_partitions

# First plausible history date and the fallback lengths of "max" history, in days.
MIN_HISTORY = "1990-01-01"
FALLBACK_DAYS = {"1d": 3650, "5m": 730}

# Bar length per interval, in minutes.
INTERVAL_MINUTES = {"1d": 1440, "5m": 5}

# Instrument search hints per requested symbol.
CLASS_HINTS = {"MGNT": ["TQBR"], "X5": ["TQBR"], "IMOEX": ["INDX", "TQBR"], "USDRUB": ["CETS"]}
DISALLOWED_CLASSES = {"USDRUB": ["SPBFUT"]}

# Extra score rules of a currency pair.
PAIR_SYMBOL = "USDRUB"
PAIR_CLASSES = ["CETS", "ETS"]
PAIR_TICKERS = ["USD000UTSTOM", "USDRUB", "USD000000TOD"]
PAIR_FUTURES_CLASSES = ["SPBFUT", "FUT"]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under ``order``.

    Spark limits each group to one row before the shuffle, so a key that holds most of the rows costs
    one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedup_last(df: DataFrame, keys: Sequence[str], recency: Sequence[str]) -> DataFrame:
    """Keep the last row per key; ``recency`` names the columns that say what "last" means."""
    if not recency:
        raise ValueError("recency columns are required: rows have no order of their own in Spark")
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in recency])


def high_water_mark(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    return df.groupBy(*keys).agg(F.max(ts).alias("hwm"))


def history_start(start: str, interval: Column, first_day: Column, first_minute: Column, end: Column) -> Column:
    """Start of a series' history; ``"max"`` uses the first known candle if it is plausible."""
    if start.strip().lower() != "max":
        return text_instant(F.lit(start))

    def plausible(c: Column) -> Column:
        return c.isNotNull() & (c >= text_instant(F.lit(MIN_HISTORY))) & (c < end)

    daily = F.when(plausible(first_day), first_day).otherwise(end - F.make_dt_interval(F.lit(FALLBACK_DAYS["1d"])))
    floor = end - F.make_dt_interval(F.lit(FALLBACK_DAYS["5m"]))
    minute = F.when(plausible(first_minute), F.greatest(floor, first_minute)).otherwise(floor)
    return (
        F.when(interval == "1d", daily).when(interval == "5m", minute)
        .otherwise(F.raise_error(F.concat(F.lit("Unsupported interval: "), interval)))
    )


def interval_step(interval: Column) -> Column:
    minutes = F.create_map(*[F.lit(x) for pair in INTERVAL_MINUTES.items() for x in pair])
    step = F.coalesce(
        F.try_element_at(minutes, interval),
        F.raise_error(F.concat(F.lit("Unsupported interval: "), interval)),
    )
    return F.make_dt_interval(F.lit(0), F.lit(0), step)


def resume_points(
    instruments: DataFrame, marks: DataFrame, end: str, start: str = "max",
    intervals: Sequence[str] = ("1d", "5m"), skip_done: bool = True,
) -> DataFrame:
    """Where each (symbol, interval) continues: the later of history start and mark + one bar."""
    end_ts = text_instant(F.lit(end))
    plan = instruments.withColumn("interval", F.explode(F.array(*[F.lit(i) for i in intervals])))
    plan = plan.join(marks.select("symbol", "interval", "hwm"), ["symbol", "interval"], "left")
    first = history_start(start, F.col("interval"), F.col("first_1day_candle_date"), F.col("first_1min_candle_date"), end_ts)
    following = F.col("hwm").cast("timestamp") + interval_step(F.col("interval"))
    plan = plan.select("symbol", "interval", F.greatest(first, following).alias("start"), end_ts.alias("end"))
    return plan.where(F.col("start") < F.col("end")) if skip_done else plan


def resume_dividends(instruments: DataFrame, marks: DataFrame, end: str, start: str = "max") -> DataFrame:
    """Where each symbol's dividends continue: a day after the last record date. No symbol is skipped,
    because announced dividends lie after ``end``. ``marks`` has ``symbol, hwm``."""
    daily = marks.withColumn("interval", F.lit("1d"))
    return resume_points(instruments, daily, end, start, ("1d",), skip_done=False).drop("interval")


def resume_schedules(instruments: DataFrame, marks: DataFrame, end: str, start: str = "max") -> DataFrame:
    """Where each exchange's schedule continues: the earliest daily start of any instrument, or a day
    after the last stored date. ``marks`` has ``exchange, hwm``."""
    end_ts = text_instant(F.lit(end))
    first = history_start(start, F.lit("1d"), F.col("first_1day_candle_date"), F.col("first_1min_candle_date"), end_ts)
    earliest = instruments.agg(F.min(first)).scalar()
    exchanges = instruments.where("exchange <> ''").select("exchange").distinct()
    following = F.col("hwm").cast("timestamp") + F.make_dt_interval(F.lit(1))
    plan = exchanges.join(marks.select("exchange", "hwm"), "exchange", "left")
    plan = plan.select("exchange", F.greatest(earliest, following).alias("start"), end_ts.alias("end"))
    return plan.where(F.col("start") < F.col("end"))


def new_rows(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not stored yet."""
    stored = existing.select(*keys).alias("stored")
    incoming = df.alias("incoming")
    cond = reduce(
        lambda a, b: a & b,
        [F.col(f"incoming.{k}").eqNullSafe(F.col(f"stored.{k}")) for k in keys],
    )
    return incoming.join(stored, cond, "left_anti")


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], recency: Sequence[str] = ()) -> DataFrame:
    """Existing and new rows, keeping the new one (and the latest new one) for a repeated key."""
    both = union_all(existing.withColumn("_src", F.lit(0)), new.withColumn("_src", F.lit(1)))
    return dedup_last(both, keys, ["_src", *recency]).drop("_src")


def stored_table(spark: SparkSession, path: str, like: StructType, partitions: Sequence[str]) -> DataFrame:
    """The table at ``path`` with all columns its files have; a missing one is an empty frame like ``like``.

    The types of the partition columns come from ``like``, because inference reads ``interval=1d`` as a number.
    """
    try:
        found = spark.read.option("mergeSchema", True).parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], like)
    fields = [like[f.name] if f.name in partitions else f for f in found]
    return spark.read.schema(StructType(fields)).parquet(path)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on keys in which a null equals a null."""
    a, b = left.alias("_left"), right.select(*keys).distinct().alias("_right")
    return a.join(b, reduce(lambda x, y: x & y, [F.col(f"_left.{k}").eqNullSafe(F.col(f"_right.{k}")) for k in keys]), how)


def upsert_partitions(
    new: DataFrame, path: str, keys: Sequence[str], partitions: Sequence[str], recency: Sequence[str] = (),
) -> None:
    """Upsert into a partitioned table, reading and rewriting only the partitions the batch touches.

    Stored columns that the batch lacks stay in all rows the batch does not replace, and a table that does not exist
    yet is created. The merged rows are written to the shared scratch folder first, so no task reads files that the
    overwrite replaces.
    """
    existing = stored_table(new.sparkSession, path, new.schema, partitions)
    merged = Stored(upsert(same_keys(existing, new, partitions, "left_semi"), new, keys, recency), "upsert")
    replace_partitions(merged.df, path, partitions)
    merged.delete()


def full_reload(existing: DataFrame, new: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Forget every stored row of the reloaded symbols, then add the new rows."""
    return union_all(new_rows(existing, new.select(symbol).distinct(), [symbol]), new)


def _delete_folders(folders: DataFrame) -> None:
    """Delete the folders in column ``folder``, each in the task that holds its row; one that is gone is no fault."""

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                where, root = fs.FileSystem.from_uri(uri)
                if where.get_file_info(root).type == fs.FileType.Directory:
                    where.delete_dir(root)
            yield batch

    folders.select("folder").mapInArrow(delete, "folder string").write.format("noop").mode("overwrite").save()


def reload_partitions(new: DataFrame, path: str, partitions: Sequence[str], symbol: str = "symbol") -> None:
    """Full reload of the batch's symbols, whatever the layout.

    Partitions that the symbols had or have are rewritten with the rows of all other symbols in them and the new ones;
    a partition that is left without rows is deleted.
    """
    existing = stored_table(new.sparkSession, path, new.schema, partitions)
    symbols = new.select(symbol).distinct()
    old = same_keys(existing.withColumn("_file", F.col("_metadata.file_path")) if existing.inputFiles() else existing.withColumn("_file", F.lit("")), symbols, [symbol], "left_semi")
    old = Stored(old.select(*partitions, F.regexp_replace("_file", "/[^/]*$", "").alias("folder")).distinct(), "reload-old")
    touched = old.df.select(*partitions).union(new.select(*partitions)).distinct()
    others = same_keys(same_keys(existing, touched, partitions, "left_semi"), symbols, [symbol], "left_anti")
    merged = Stored(union_all(others, new), "reload")
    stale = Stored(same_keys(old.df, merged.df, partitions, "left_anti"), "reload-stale")
    replace_partitions(merged.df, path, partitions)
    _delete_folders(stale.df)
    for table in (old, merged, stale):
        table.delete()


def ingest_candles(
    batch: DataFrame, path: str, recency: Sequence[str], partitions: Sequence[str] = ("symbol", "interval", "year"),
    keys: Sequence[str] = ("symbol", "interval", "ts"),
) -> DataFrame:
    """De-duplicate a landing batch and drop rows already stored; the result is ready to append."""
    batch = dedup_last(batch.withColumn("year", F.year("ts")), keys, recency)
    stored = read_if_exists(batch.sparkSession, path, batch.schema, columns=[*dict.fromkeys([*keys, *partitions])])
    stored = stored.join(batch.select(*partitions).distinct(), list(partitions), "left_semi")
    return new_rows(batch, stored, keys)


def _codes(hints: Mapping[str, Sequence[str]], symbol: Column) -> Column:
    empty = F.array().cast("array<string>")
    if not hints:
        return empty
    table = F.create_map(
        *[x for name, codes in hints.items() for x in (F.lit(name), F.array(*[F.lit(c.upper()) for c in codes]))]
    )
    return F.coalesce(F.try_element_at(table, symbol), empty)


def instrument_score(preferred: Mapping[str, Sequence[str]]) -> Column:
    """Fitness of a candidate (``ticker, name, class_code, tradable``) for the symbol asked for."""
    symbol, ticker = F.col("symbol"), F.upper(F.coalesce("ticker", F.lit("")))
    name, code = F.upper(F.coalesce("name", F.lit(""))), F.upper(F.coalesce("class_code", F.lit("")))

    def points(rule: Column, value: int) -> Column:
        return F.when(rule, value).otherwise(0)

    is_pair = symbol == PAIR_SYMBOL
    return (
        F.when(ticker == symbol, 100).when(ticker.startswith(symbol), 30).otherwise(0)
        + points(name.contains(symbol), 20)
        + points(F.coalesce("tradable", F.lit(False)), 10)
        + points(F.array_contains(_codes(preferred, symbol), code), 25)
        + points(is_pair & code.isin(PAIR_CLASSES), 120)
        + points(is_pair & ticker.isin(PAIR_TICKERS), 80)
        + points(is_pair & (code.isin(PAIR_FUTURES_CLASSES) | ticker.endswith("F")), -100)
    )


def resolve_instruments(
    candidates: DataFrame, order: Sequence[str],
    preferred: Mapping[str, Sequence[str]] = CLASS_HINTS,
    disallowed: Mapping[str, Sequence[str]] = DISALLOWED_CLASSES,
) -> DataFrame:
    """Best candidate per symbol.

    A disallowed class code is used only when the symbol has no other candidate, which is the same as
    ranking allowed candidates first. Ties go to the earliest candidate in ``order``.
    """
    found = candidates.where(F.col("uid").isNotNull() & (F.col("uid") != "")).withColumn(
        "symbol", F.upper(F.trim("symbol"))
    )
    found = keep_first(found, ["symbol", "uid"], [F.col(c) for c in order])
    code = F.upper(F.coalesce("class_code", F.lit("")))
    found = found.withColumn("allowed", ~F.array_contains(_codes(disallowed, F.col("symbol")), code)).withColumn(
        "score", instrument_score(preferred)
    )
    best = [F.col("allowed").desc(), F.col("score").desc(), *[F.col(c) for c in order]]
    return keep_first(found, ["symbol"], best)
