"""Ranks, rank correlation and exact quantiles for groups of any size."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelmill.session import Stored, materialise

FLAT = 1e-12  # fixed value: a deviation below this counts as constant
PART = 500_000  # rows that a task ranks
RUN = 1 << 18  # rows whose values a task counts before it sends them
AT_ONCE = 6  # features whose values are on disk at the same time
SAMPLE = 100_000  # rows that choose the cuts between tasks; results do not depend on them


def parts_of(stored: DataFrame) -> int:
    """Tasks that rank a stored table, PART rows each."""
    return max(1, math.ceil(stored.count() / PART))


def series_rank(keys: Sequence[str], name: str) -> Column:
    """Average rank inside a group that is bounded by the calendar (one row per key and day)."""
    peers = F.count(F.lit(1)).over(Window.partitionBy(*keys, name))
    return F.rank().over(Window.partitionBy(*keys).orderBy(name)) + (peers - 1) / 2


def row_ranks(df: DataFrame, keys: Sequence[str], name: str, out: str, row: str, parts: int | None = None) -> DataFrame:
    """``df`` with ``out``, the average rank of ``name`` in its group, however large a group or how frequent a value.

    Rows are range-partitioned by (keys, value, ``row``), a column that no two rows of a group share, so that ties are
    split like everything else. A rank is the count of smaller values in the partition, plus the rows of the group in
    earlier partitions, plus half the ties. Ties that go over an edge are settled by a table of the first and last value
    of each (partition, group); nothing is joined on a value. ``parts``: the number of partitions, which bounds what a task
    sorts; None leaves it to Spark.
    """
    kept = [c for c in df.columns]
    ranges = df.repartitionByRange(*keys, name, row) if parts is None else df.repartitionByRange(parts, *keys, name, row)
    laid = materialise(ranges.withColumn("_part", F.spark_partition_id()), "ranks")
    here = ["_part", *keys]
    edges = laid.groupBy(*here, name).agg(F.count(F.lit(1)).alias("_c")).withColumns({
        "_first": F.min(name).over(Window.partitionBy(*here)), "_last": F.max(name).over(Window.partitionBy(*here)),
        "_n": F.sum("_c").over(Window.partitionBy(*here)),
    }).where(F.col(name).isin(F.col("_first"), F.col("_last")))  # two rows at most for each (partition, group)
    value = Window.partitionBy(*keys, name)
    earlier = value.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumns({"_ties": F.sum("_c").over(value), "_equal": F.coalesce(F.sum("_c").over(earlier), F.lit(0))})
    at = {n: F.col(name) == F.col(n) for n in ("_first", "_last")}
    table = edges.groupBy(*here).agg(
        F.first("_first").alias("_first"), F.first("_last").alias("_last"), F.first("_n").alias("_n"),
        *[F.max(F.when(at[e], F.col(c))).alias(f"{e}{c}") for e in at for c in ("_ties", "_equal")])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    table = materialise(table.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "rank-edges")
    inside = Window.partitionBy(*here)
    ranked = (laid if parts is None else laid.repartition(parts, "_part")).withColumns({
        "_smaller": F.rank().over(inside.orderBy(name)) - 1, "_own": F.count(F.lit(1)).over(Window.partitionBy(*here, name))})
    # a table of one row for each (partition, group); Spark broadcasts it if it is small
    joined = ranked.join(table, here)
    ties = F.when(at["_first"], F.col("_first_ties")).when(at["_last"], F.col("_last_ties")).otherwise(F.col("_own"))
    equal = F.when(at["_first"], F.col("_first_equal")).otherwise(F.lit(0))
    rank = F.col("_before") - equal + F.col("_smaller") + (ties + 1) / 2
    return joined.select(*kept, rank.alias(out))


def guarded_corr(x: str, y: str) -> Column:
    """Pearson correlation of complete pairs; 0 when either side is constant or the result is not finite.

    Written as covariance over deviations because ``corr`` fails on a constant column in ANSI mode.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    sx, sy = (F.stddev_pop(F.when(both, F.col(c))) for c in (x, y))
    r = F.try_divide(F.covar_pop(x, y), sx * sy)
    return F.when((sx < FLAT) | (sy < FLAT) | r.isNull() | F.isnan(r), 0.0).otherwise(F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))


def rank_correlation(
    df: DataFrame, keys: Sequence[str], x: str, y: str, out: str = "spearman",
) -> DataFrame:
    """Spearman correlation per group over complete pairs; a group may hold any share of the rows.

    A pair is ranked by one side, then, with that rank beside it, by the other: its ranks need not find each other again.
    """
    pairs = df.select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    pairs = pairs.where(F.col("_x").isNotNull() & F.col("_y").isNotNull()).withColumn("_row", F.monotonically_increasing_id())
    pairs = materialise(pairs, "pairs")
    parts = parts_of(pairs)
    first = materialise(row_ranks(pairs, keys, "_y", "_y_rank", "_row", parts).drop("_y"), "first-ranks")
    both = row_ranks(first, keys, "_x", "_x_rank", "_row", parts)
    return both.groupBy(*keys).agg(guarded_corr("_x_rank", "_y_rank").alias(out))


def _merged(x: np.ndarray, n: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted different values with the sums of ``n`` and ``s``; all NaN are one value, the largest."""
    if not len(x):
        return x, n, s
    order = np.argsort(x, kind="stable")
    x = x[order]
    new = np.r_[True, (x[1:] != x[:-1]) & ~(np.isnan(x[1:]) & np.isnan(x[:-1]))]
    at = np.flatnonzero(new)
    return x[at], np.add.reduceat(n[order], at), np.add.reduceat(s[order], at)


def _pack(v: np.ndarray) -> bytes:
    """First bytes of all numbers, then their second bytes and so on: neighbours share the high ones, which then take no room on disk."""
    return v.view(np.uint8).reshape(len(v), v.itemsize).T.tobytes()


def _unpack(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def _rank_sums(ranked: DataFrame, features: Sequence[str], cuts: Sequence[np.ndarray], middle: float, parts: int) -> DataFrame:
    """``feature, cov, var``: sums of products of the centred ranks, of each feature with ``ry`` (centred by ``middle``) and itself.

    The covariance needs of each value of a feature only its rows and the sum of their ``ry``. Tasks send these by runs, sorted and
    cut at ``cuts``; the runs of one (feature, range) meet in one task, where a frequent value is one entry a run.
    """
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= RUN:
                yield from runs(held)
                held, rows = [], 0
        if rows:
            yield from runs(held)

    def runs(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held)
        r = whole.column(0).to_numpy() - middle
        for j, cut in enumerate(cuts):
            x, n, s = _merged(whole.column(j + 1).to_numpy(), np.ones(len(r), np.int64), r)
            edges = np.r_[0, np.searchsorted(x, cut, side="right"), len(x)]
            some = np.flatnonzero(np.diff(edges))
            pieces = [[_pack(v[edges[k]: edges[k + 1]]) for k in some] for v in (x, n.astype(np.int32), s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), j, np.int32)), pa.array(some.astype(np.int32)), *(pa.array(p, pa.binary()) for p in pieces)],
                ["feature", "range", "x", "n", "s"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for b in batches:
            for j, k, *data in zip(*(c.to_pylist() for c in b.columns)):
                if (j, k) != key:
                    if held:
                        yield close(key, held)
                    key, held = (j, k), []
                held.append(data)
        if held:
            yield close(key, held)

    def close(key: tuple[int, int], held: list) -> pa.RecordBatch:
        x, n, s = (np.concatenate([_unpack(d[i], t) for d in held]) for i, t in enumerate((np.float64, np.int32, np.float64)))
        x, n, s = _merged(x, n.astype(np.int64), s)
        rank = np.cumsum(n) - (n - 1) / 2  # inside the range
        out = (n.sum(), s.sum(), (rank * s).sum(), (n * rank).sum(), (n * rank * rank).sum())
        return pa.RecordBatch.from_pylist([dict(zip(("feature", "range", "n", "s", "rs", "r", "rr"), (*key, *map(float, out))))], schema=kind)

    kind = pa.schema([("feature", pa.int32()), ("range", pa.int32()), *((c, pa.float64()) for c in ("n", "s", "rs", "r", "rr"))])
    sent = ranked.select("ry", *[F.col(f"`{c}`") for c in features]).mapInArrow(send, "feature int, range int, x binary, n binary, s binary")
    ranges = sent.repartition(parts, "feature", "range").sortWithinPartitions("feature", "range").mapInArrow(
        meet, "feature int, range int, n double, s double, rs double, r double, rr double")
    before = Window.partitionBy("feature").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    u = F.coalesce(F.sum("n").over(before), F.lit(0.0)) - middle
    terms = ranges.withColumn("u", u).select(
        "feature", (F.col("u") * F.col("s") + F.col("rs")).alias("cov"),
        (F.col("n") * F.col("u") * F.col("u") + 2 * F.col("u") * F.col("r") + F.col("rr")).alias("var"))
    names = F.array(*[F.lit(c) for c in features])
    return terms.groupBy("feature").agg(F.sum("cov").alias("cov"), F.sum("var").alias("var")).withColumn("feature", F.get(names, F.col("feature")))


def _spans(df: DataFrame) -> DataFrame:
    """``i, n, varied`` of each column by its number: values that are not null, and whether there are different ones."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for i, column in enumerate(b.columns):
                x = column.drop_null().to_numpy(zero_copy_only=False)
                if len(x):
                    found.append((i, len(x), float(np.fmin.reduce(x)), float(x.max())))  # NaN is the largest value, as in Spark
            yield pa.RecordBatch.from_pylist([dict(zip(("i", "n", "lo", "hi"), f)) for f in found], schema=kind)

    kind = pa.schema([("i", pa.int32()), ("n", pa.int64()), ("lo", pa.float64()), ("hi", pa.float64())])
    found = df.mapInArrow(look, "i int, n bigint, lo double, hi double")
    return found.groupBy("i").agg(F.sum("n").alias("n"), (F.min("lo") < F.max("hi")).alias("varied"))


def top_correlations(df: DataFrame, target: str, features: Sequence[str], top_n: int = 20) -> DataFrame:
    """Features by absolute Spearman correlation with the target; constant features are left out.

    Where no value is missing, the target is ranked once instead of once per feature, and the features are not stacked into rows.
    """
    cols = [target, *features]
    names = ["y", *[f"f{i}" for i in range(1, len(cols))]]
    stored = Stored(df.select(
        *[F.col(f"`{c}`").cast("double").alias(n) for n, c in zip(names, cols)], F.monotonically_increasing_id().alias("_row")), "ranked-features")
    base = stored.df
    n = base.count()
    stats = {r["i"]: r for r in _spans(base.select(*names)).collect()}  # a row a column
    varied = {k: cols[i] for i, k in enumerate(names) if i > 0 and stats.keys() >= {0, i} and stats[0]["varied"] and stats[i]["varied"]}
    if not varied:
        stored.delete()
        return df.sparkSession.createDataFrame([], "feature string, spearman double")
    if all(stats[i]["n"] == n for i, k in enumerate(names) if k == "y" or k in varied):
        ranges = max(1, math.ceil(n / PART))
        some = base.sample(min(1.0, SAMPLE / n), seed=1).select(*varied).toArrow()
        cuts = [np.unique(np.sort(x.to_numpy())[[len(x) * k // ranges for k in range(1, ranges)]]) if len(x) else np.zeros(0) for x in some.columns]
        target_ranks = materialise(row_ranks(base.select("y", "_row"), [], "y", "ry", "_row", ranges).select("_row", "ry"), "target-ranks")
        middle = (n + 1) / 2
        spread = target_ranks.agg(F.sum((F.col("ry") - middle) * (F.col("ry") - middle))).head()[0]
        sums = None
        for k in range(0, len(varied), AT_ONCE):  # the shuffles of some features are gone before the next ones begin
            some = list(varied)[k: k + AT_ONCE]
            ranked = base.select("_row", *some).join(target_ranks, "_row")
            part = materialise(_rank_sums(ranked, some, cuts[k: k + AT_ONCE], middle, ranges * math.ceil(len(some) / 4)), "rank-sums")
            sums = part if sums is None else sums.unionByName(part)
        r = F.try_divide("cov", F.sqrt(F.col("var") * F.lit(spread)))
        r = F.when(r.isNull() | F.isnan(r), 0.0).otherwise(F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))
        label = F.create_map(*[F.lit(v) for pair in varied.items() for v in pair])
        scored = sums.select(label[F.col("feature")].alias("feature"), r.alias("spearman"))
    else:
        stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(k).alias("x")) for k, c in varied.items()])).alias("f")
        long = base.select("y", stacked).select("f.*", "y").where("x is not null and y is not null")
        scored = rank_correlation(long, ["feature"], "x", "y")
    stored.delete()  # both ways have read it
    return scored.orderBy(F.abs("spearman").desc(), "feature").limit(top_n)


def _at_positions(values: DataFrame, ks: Sequence[int]) -> dict[int, float]:
    """Values at 0-based positions of the sorted column ``v``, all in one pass over range partitions.

    Values are counted first, so repeated ones cost one row. A running count inside each range partition plus the count
    of the partitions before it places every value; only the window over those partition totals is without a key.
    """
    laid = Stored(
        values.groupBy("v").agg(F.count(F.lit(1)).alias("c")).repartitionByRange("v").withColumn("_part", F.spark_partition_id()), "quantiles")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = laid.df.groupBy("_part").agg(F.sum("c").alias("_m")).select("_part", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_offset"))
    inside = F.sum("c").over(Window.partitionBy("_part").orderBy("v"))
    placed = laid.df.select("v", "_part", inside.alias("_run")).join(offsets, "_part")
    found = placed.agg(*[F.min(F.when(F.col("_offset") + F.col("_run") > k, F.col("v"))) for k in ks]).head()
    laid.delete()
    return dict(zip(ks, found))


def exact_quantiles(df: DataFrame, col: Column, probs: Sequence[float]) -> list[float]:
    """Linear-interpolation quantiles of a whole column, by the same method for any number of rows."""
    values = df.select(col.cast("double").alias("v")).where(F.col("v").isNotNull())
    n = values.count()
    if n == 0:
        return [0.0 for _ in probs]
    spots = [(n - 1) * p for p in probs]
    known = _at_positions(values, sorted({k for h in spots for k in (math.floor(h), math.ceil(h))}))
    low = [known[math.floor(h)] for h in spots]
    high = [known[math.ceil(h)] for h in spots]
    return [a + (b - a) * (h - math.floor(h)) for h, a, b in zip(spots, low, high)]
