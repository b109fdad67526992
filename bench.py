"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   folder of the Parquet tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 4)
    BENCH_MEMORY   driver memory (default 6g)

    BENCH_LIMIT    seconds after which a query is stopped and recorded with its limit (default 500)
    BENCH_TOTAL    seconds for all queries (default 1600); those that do not begin in time are listed as not run

Every query is built and written in full to Spark's no-op sink. After each one the figures so far are printed to the
standard error, so that a stopped bench still shows what it measured; the JSON line on the standard output comes last.
"""

from __future__ import annotations

import json
import os
import sys
import threading
import time

os.environ.setdefault("BENCH_CPUS", "4")

from panelmill.queries import QUERIES  # noqa: E402
from panelmill.session import clear_scratch, get_session  # noqa: E402

HEADLINE = [
    "daily_bars", "features_daily", "asof_context", "asof_keyed", "dedup_last", "coerce_columns", "upsert_union",
    "incremental_ingest", "time_split", "walk_forward_folds", "regression_metrics", "rank_ic_pooled", "target_stats",
    "top_correlations", "table_profile", "strategy_metrics", "threshold_search", "scale_choice", "candidate_choice",
    "model_quality", "intraday_rollup", "stream_daily_rollup", "ridge_fit", "logistic_fit", "feature_importance",
    "quantile_gbt",
]


def timed(spark, name: str, folder: str, limit: float) -> tuple[float, str | None]:
    """(seconds, what went wrong). The jobs of a query beyond its limit are cancelled."""
    late = threading.Event()

    def stop() -> None:
        late.set()
        while not done.wait(1):  # a query begins new jobs until its driver code sees the first one fail
            spark.sparkContext.cancelAllJobs()

    done, timer = threading.Event(), threading.Timer(limit, stop)
    timer.start()
    start, wrong = time.perf_counter(), None
    try:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    except Exception as e:
        wrong = f"over {limit:g} s" if late.is_set() else str(e).split("\n")[0][:200]
    finally:
        done.set()
        timer.cancel()
    return round(time.perf_counter() - start, 3), wrong


def main() -> None:
    folder, began = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), time.perf_counter()
    limit, total = (float(os.environ.get(k, d)) for k, d in (("BENCH_LIMIT", "500"), ("BENCH_TOTAL", "1600")))
    spark = get_session("bench", int(os.environ["BENCH_CPUS"]))
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["daily_bars"](spark, folder).limit(1).count()  # start the executors and load the classes
    times, wrong = {}, {}

    def report() -> str:
        return json.dumps({
            "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
            "queries": times, "cpus": int(os.environ["BENCH_CPUS"]), "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "not_finished": wrong,
        })

    for name in sys.argv[1:] or HEADLINE:
        left = total - (time.perf_counter() - began)
        if left <= 0:
            wrong[name] = "not run"
            continue
        seconds, why = timed(spark, name, folder, min(limit, left))
        if why is None:
            times[name] = seconds
        else:
            wrong[name] = why
        clear_scratch()
        spark.catalog.clearCache()
        print(report(), file=sys.stderr, flush=True)
    print(report())
    spark.stop()


if __name__ == "__main__":
    main()
