"""Time the headline queries: one JSON line, seconds per query (after one warm-up, median of BENCH_RUNS runs)."""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from catalog import QUERIES  # noqa: E402

HEADLINE = [
    "group_median", "text_normalize", "laea_inverse", "haversine", "count_within", "nearest_distance", "proximity",
    "round_dedupe", "best_match", "nearest_cell_match", "quantiles_exact", "join_chain", "join_composite", "topk_global",
    "topk_variants", "rank_all", "zone_rollup", "department_rollup", "composite_score", "live_score", "price_plan",
    "census_plan", "osm_roads", "stream_latest_state",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "7g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "1024")
        # no Python call sites in error messages: building a query takes a third less time
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            # every row and column is computed, and written nowhere
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
