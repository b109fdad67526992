import re
import time
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelmill import session
from panelmill.operators import metrics as E
from panelmill.operators import ranks as R
from panelmill.session import Stored, materialise


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def many(spark, n=3000):
    rng = np.random.default_rng(8)
    y = rng.normal(size=n).round(2)
    pdf = pd.DataFrame({"y": y, "a": y + rng.normal(size=n), "hot": np.where(rng.random(n) < 0.9, 7.0, y), "few": rng.integers(0, 3, n), "gone": np.where(rng.random(n) < 0.2, np.nan, -y)})
    return pdf, spark.createDataFrame(pdf).repartition(5)


def test_top_correlations_over_many_ranges(spark, monkeypatch):
    """Ranges, runs and ties over their edges; features are never stacked into a row a value."""
    monkeypatch.setattr(R, "PART", 200)
    monkeypatch.setattr(R, "RUN", 250)
    pdf, df = many(spark)
    out = R.top_correlations(df, "y", ["a", "hot", "few", "gone"], 9)
    assert "explode" not in plan(out)
    want = {c: pdf[c].rank().corr(pdf.y.rank()) for c in ("a", "hot", "few")}
    got = {r.feature: r.spearman for r in out.collect()}
    worst = pdf.gone.fillna(np.inf)  # NaN is a value: the largest
    assert got == pytest.approx({**want, "gone": worst.rank().corr(pdf.y.rank())}, abs=1e-12)


def test_rank_correlation_ranks_bounded_parts(spark, monkeypatch):
    """A task sorts a bounded number of rows, and no table of all rows is aggregated by row."""
    monkeypatch.setattr(R, "PART", 300)
    pdf, df = many(spark)
    out = R.rank_correlation(df, ["few"], "hot", "y")
    assert not re.search(r"Aggregate\(keys=\[[^\]]*_row", plan(out))
    assert max(r["count"] for r in out.sparkSession.read.parquet(
        [s for s in R.Stored.written if "/ranks-" in s.path][-1].path).groupBy("_part").count().collect()) < 900
    got = {r.few: r.spearman for r in out.collect()}
    assert got == pytest.approx({k: g.hot.rank().corr(g.y.rank()) for k, g in pdf.groupby("few")}, abs=1e-12)
    assert R.rank_correlation(df.where(F.lit(False)), ["few"], "hot", "y").count() == 0


def test_daily_metrics_by_parts_are_the_same(spark, monkeypatch):
    """Sorts get a number of tasks that follows the rows, not the session's setting."""
    monkeypatch.setattr(R, "PART", 300)
    df = materialise(many(spark)[1].select(F.concat_ws(".", "few", "hot").alias("k"), "y", F.col("a").alias("pred")), "daily")
    parts = R.parts_of(df)
    assert parts == 10
    out = E.regression_metrics(df, ["k"], parts=parts)
    assert f", {parts})" in plan(out).split("Exchange hashpartitioning(k")[1].split("\n")[0]
    assert {tuple(r) for r in out.select("k", F.round("ic_spearman", 12)).collect()} == {
        tuple(r) for r in E.regression_metrics(df, ["k"]).select("k", F.round("ic_spearman", 12)).collect()}


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    """They stayed until the driver's next garbage collection: all_correlations held those of the dataset beside its own."""
    was, before = spark.conf.get(session.CLEANUP, "false"), shuffle_files(spark)
    with ThreadPool(3) as pool:
        tables = pool.map(lambda k: Stored(spark.range(5000).repartition(3, "id").groupBy((F.col("id") % k).alias("k")).count(), "left"), (3, 5, 7))
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert [t.df.count() for t in tables] == [3, 5, 7]
    assert spark.conf.get(session.CLEANUP) == was
    for t in tables:
        t.delete()


def test_correlations_take_a_few_features_at_a_time(spark, monkeypatch):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.integers(0, 40, (400, 7)).astype(float), columns=[f"x{i}" for i in range(7)])
    df = spark.createDataFrame(pdf.assign(y=pdf.x0 - pdf.x3 + rng.normal(size=400)))
    real, sizes = R._rank_sums, []
    monkeypatch.setattr(R, "_rank_sums", lambda ranked, features, *rest: (sizes.append(len(features)), real(ranked, features, *rest))[1])
    found = {}
    for at_once in (2, 100):
        monkeypatch.setattr(R, "AT_ONCE", at_once)
        found[at_once] = {r["feature"]: r["spearman"] for r in R.top_correlations(df, "y", list(pdf.columns)).collect()}
    assert sizes == [2, 2, 2, 1, 7]
    want = pdf.rank().corrwith(df.toPandas().y.rank()).to_dict()
    assert found[2] == pytest.approx(found[100], abs=1e-12)
    assert found[2] == pytest.approx(want, abs=1e-9)


def test_numbers_packed_by_bytes_are_read_back():
    for v in (np.array([1.5, -0.0, np.nan, np.inf, 3e-300]), np.array([3, -1, 2**31 - 1], np.int32), np.zeros(0)):
        assert R._unpack(R._pack(v), v.dtype.type).tobytes() == v.tobytes()
