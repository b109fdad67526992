import datetime as dt
import random

import pytest

from panelmill.operators.joins import asof_by_key, merge_context, trading_days_only

D0 = dt.date(2020, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


def brute(left, right, keyed):
    out = []
    for k, d in left:
        rows = [r for r in right if (not keyed or r[0] == k) and r[1] <= d]
        out.append((k, d, max(rows, key=lambda r: r[1])[2:] if rows else None, max(rows, key=lambda r: r[1])[1] if rows else None))
    return out


@pytest.mark.parametrize("keyed", [True, False])
def test_asof_equals_brute_force(spark, keyed):
    rng = random.Random(3)
    left = [(k, day(i)) for k in "AAAB" for i in rng.sample(range(400), 60)] + [("C", day(5))]
    left = sorted(set(left))
    if keyed:
        right = [(k, day(i), rng.choice([None, float(i)])) for k in "AB" for i in rng.sample(range(30, 300), 40)]
    else:
        right = [("-", day(i), rng.choice([None, float(i)])) for i in rng.sample(range(30, 300), 40)]
    base = spark.createDataFrame(left, "k string, date date")
    ctx = spark.createDataFrame(right, "k string, date date, v double")
    ctx = ctx if keyed else ctx.drop("k")
    got = merge_context(base, ctx, "c", ["v"], by=["k"] if keyed else []).collect()
    want = {(k, d): (row[0] if row else None, float((d - at).days) if at else 10000.0) for k, d, row, at in brute(left, right, keyed)}
    assert len(got) == len(left)
    assert {(r.k, r.date): (r.v, r.context_age_days_c) for r in got} == want


def test_asof_by_key_keeps_repeated_left_rows_and_times(spark):
    t = dt.datetime(2020, 3, 1)
    left = spark.createDataFrame([("A", t + dt.timedelta(hours=h)) for h in (1, 1, 5, 700)], "k string, ts timestamp")
    right = spark.createDataFrame([("A", t, 1), ("A", t + dt.timedelta(hours=4), 2)], "k string, ts timestamp, v int")
    got = sorted((r.ts, r.hit.v) for r in asof_by_key(left, right, ["k"], ["v"], on="ts", out="hit").collect())
    assert [v for _, v in got] == [1, 1, 2, 2]


def test_calendar_drops_unknown_and_closed_days(spark):
    df = spark.createDataFrame([(day(i),) for i in range(4)], "date date")
    cal = spark.createDataFrame([(day(0), True), (day(1), False), (day(3), True)], "date date, is_trading_day boolean")
    assert sorted(r.date for r in trading_days_only(df, cal).collect()) == [day(0), day(3)]
