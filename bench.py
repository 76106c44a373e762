"""Headline benchmark.

Runs the reference's harness queries (latest 10,000 blocks, one month of
blocks, count) plus the operators it makes speed claims about (gap
detection, as-of join, rolling z-score), the flagship gap report and a
historical load (decode RPC payloads of every block, normalise, write the
month-partitioned table) on the block table derived from ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1), on ``local[$BENCH_CPUS]``. Each query is
fully executed (``noop`` sink, or the parquet write for the load) once to
warm up and then timed; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

QUERIES = {
    # name in output: registered plan
    "latest_10000": "bench_latest_10000",
    "january_range": "bench_january",
    "count": "bench_count",
    "gap_detection": "detect_gaps",
    "gap_report": "gap_report",
    "asof_join": "asof_purchase_view",
    "rolling_zscore": "rolling_zscore",
    "rolling_stats": "rolling_stats",
    "rolling_day": "rolling_day",
    "fuse": "fuse_sources",
    "gap_lifecycle": "gap_lifecycle_events",
    "feature_matrix": "feature_matrix",
    "historical_load": "bench_historical_load",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from gapseries.plans import registry
    from gapseries.plans.bench_plans import bench_plans
    from gapseries.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="gapseries-bench")
    plans = {**registry.plans(), **bench_plans()}
    times = {}
    for out, name in QUERIES.items():
        fn = plans[name]

        def run():
            res = fn(spark, sf_dir)
            if res is not None:                 # a DataFrame plan: execute it fully
                res.write.format("noop").mode("overwrite").save()
        run()                                   # warm-up
        t0 = time.perf_counter()
        run()
        times[out] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
