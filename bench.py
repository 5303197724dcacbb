"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and fully executed with the ``noop`` sink (the whole plan
runs, nothing is collected to the driver). One warm-up query starts the JVM
first. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "candles_1h",            # tick -> candle aggregation
    "features",              # the 20-column feature table over candles
    "tick_features",         # feature table over every tick (long series)
    "user_features",         # feature table, one series per user (many series)
    "order_features",        # feature table over orders as one series (halo blocks)
    "rsi_14",                # RSI block scan over ticks
    "ewm_mean",              # exponential mean block scan over ticks
    "growth_index",          # running-sum block scan
    "incremental_features",  # append with carried state
    "linreg_predict",        # 19-input OLS per series
    "eval_metrics",          # scores of the one-input model
    "profile_features",      # profile aggregate
    "tail_168",              # top-k per series
    "actual_vs_predicted",   # serving join
    "stream_candles",        # Structured Streaming candles
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from tidemark.plans import registry as R
    from tidemark.session import local_session

    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app="tidemark-bench",
                          scratch=tempfile.mkdtemp(prefix="tm-bench-"))
    R.QUERIES["candles_1h"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in only or HEADLINE:
        t0 = time.time()
        R.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
