"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

All queries run once to warm the session up, then each runs three times; the median counts.
The whole result is produced (``noop`` sink), so no column is pruned away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = [
    "a1_demand_15min", "w6_feature_builder", "a11_regression_metrics", "q2_batch_validation",
    "d4_feature_drift", "o7_fixed_sample", "w10_request_rates", "m2_position_split", "t2_streaming_demand",
]
RUNS = 3


def main() -> None:
    from demandlab.catalog import all_queries
    from demandlab.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def once(name: str) -> float:
        started = time.monotonic()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.monotonic() - started

    seconds = {}
    chosen = sys.argv[1:] or HEADLINE
    for name in chosen:
        once(name)
    for name in chosen:
        seconds[name] = round(statistics.median(once(name) for _ in range(RUNS)), 4)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 4), "unit": "sec",
                      "queries": seconds, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))


if __name__ == "__main__":
    main()
