from panelmill.operators import features as X


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_finalize_drops_what_is_not_finite_in_one_sum(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1, 0.0, -1e308), (2, inf, 1.0), (3, 1.0, -inf), (4, nan, 1.0), (5, None, 1.0), (None, 1.0, 1.0), (7, 1e308, 1e-320)], "k int, a double, `b c` double")
    out = X.finalize(df)
    assert [r.k for r in out.orderBy("k").collect()] == [1, 7]
    assert "isnan" not in plan(out).lower()
