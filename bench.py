"""Headline queries, timed warm; prints one JSON line.

Every query is run to its last row (``noop`` sink). The first run of each warms up and is not counted; the
value per query is the median of the counted runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = [
    "period_cube", "period_cube_all_arms", "period_cube_daily", "period_cube_three_kinds", "cumulative_metrics",
    "who_volume", "plan_daily", "longest_prefix", "longest_prefix_large_dictionary", "table_diff", "delta_keys",
    "freshness_gate", "infer_types", "parse_dates", "cdr_normalize", "tracking_long", "sales_mix_params",
    "replace_slice", "ohlcv_minute", "book_depth",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from kpimill.plans.catalog import QUERIES
    from kpimill.session import get_session

    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        # each test table is one parquet row group, so a scan is one task: joining the larger ones by shuffle spreads
        # their rows over the cores
        "spark.sql.autoBroadcastJoinThreshold": "1m",
    }
    spark = get_session("bench", f"local[{cpus}]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINES
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, sum of medians", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
