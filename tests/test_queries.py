"""A cross-section of the registered queries against DuckDB, at the smallest scale."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_oracle import TABLES, rows

FOLDER = "/root/testdata/sf0.001"
CHECKED = [
    "features_daily", "asof_keyed", "dedup_last", "coerce_columns", "incremental_ingest", "nested_schedules", "time_split",
    "rank_ic_pooled", "sanity_checks", "threshold_search", "scale_choice", "candidate_choice", "stream_daily_rollup",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    got = rows(df.columns, df.collect())
    cur = duck.execute(oracle_sql()[name])
    assert got == rows([d[0] for d in cur.description], cur.fetchall())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
