"""Times the headline queries and prints one JSON line.

Every query writes all its rows to the no-op sink. A query runs once to warm the
JVM and is then timed three times, the median counts; a slower one is timed once
after its warm-up, and one that takes long on its only run. ``runs`` states the
number of timed runs of each query, 0 for the cold one.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from odflux.functions import build_session  # noqa: E402
from registry.queries import QUERIES  # noqa: E402

HEADLINE = [
    "demand_windows", "zone_flows", "surge_score", "parse_trips", "complete_grid", "rolling_features",
    "asof_snapshots", "flow_features", "training_matrix", "graph_projection", "community_profiles",
    "dominant_flows", "forecast_metrics", "upsert_demand_windows", "stream_demand", "pagerank", "betweenness", "louvain",
]
QUICK_SECONDS, LONG_SECONDS = 5.0, 15.0


def once(spark, sf_dir: str, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("odflux-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    took: dict[str, float] = {}
    counted: dict[str, int] = {}
    for name in names:
        first = once(spark, sf_dir, name)
        runs = 3 if first < QUICK_SECONDS else 1 if first < LONG_SECONDS else 0
        counted[name] = runs
        timed = [once(spark, sf_dir, name) for _ in range(runs)] or [first]
        took[name] = round(statistics.median(timed), 3)
        print(name, took[name], file=sys.stderr, flush=True)
    spark.stop()
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "runs": counted, "sf": float(scale) if scale.replace(".", "").isdigit() else scale}))


if __name__ == "__main__":
    main()
