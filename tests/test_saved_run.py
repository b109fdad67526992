import datetime as dt

import numpy as np
import pandas as pd

from panelmill.queries import evaluate as V
from panelmill.session import Stored


def tables(spark, folder, days=120):
    rng = np.random.default_rng(6)
    when = [dt.datetime(1995, 1, 1) + dt.timedelta(days=i) for i in range(days)]
    lines = [(s * 1000 + i, s + i, s, 1, float(rng.integers(1, 50)), float(rng.integers(900, 90000)), 0.1, "R", when[i]) for s in (1, 2) for i in range(days)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_returnflag string, l_shipdate timestamp_ntz").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(i, "1-URGENT", 10.0 + i, d) for i, d in enumerate(when)],
                          "o_orderkey long, o_orderpriority string, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(pd.DataFrame({"s_suppkey": [1, 2]})).write.parquet(f"{folder}/supplier.parquet")


def test_profiles_and_reports_read_stored_tables(spark, folder):
    """Bars are made once for all profiles, predictions and the tables that several reports read once a run."""
    tables(spark, folder)
    made = V._profiles(spark, folder)
    for name in ("bars", "dirty"):
        assert "lineitem" not in made[name]._jdf.queryExecution().executedPlan().toString()
    assert made["dirty"].count() == 2 * made["bars"].count() == 480
    before = len(Stored.written)
    V.saved_run(spark, folder)
    labels = [s.path.rsplit("/", 1)[1].rsplit("-", 1)[0] for s in Stored.written[before:]]
    assert [labels.count(x) for x in ("predictions", "quality", "sanity")] == [1, 1, 1]
