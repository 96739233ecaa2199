"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then REPEATS times; the median counts. Results go
to the no-op sink, so every row and column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from crowdgrid.plans.queries import QUERIES  # noqa: E402
from crowdgrid.session import builder, clean_scratch  # noqa: E402

HEADLINE = [
    "w1_batch_visits",
    "a1_cell_counts",
    "a4_hotspot_report",
    "v1_heat_markers",
    "a5_pings_by_hour",
    "a6_cluster_sizes",
    "a9_overview",
    "p9_dates_between",
    "a10_device_journey",
    "a11_first_visits",
    "a12_journey_segments",
    "a12_journey_paths",
    "v2_journey_markers",
    "m1_kmeans_labels",
    "m2_fixed_centers",
    "m3_silhouette_visits",
    "m4_chosen_k",
    "m6_clustered_batches",
    "w2_closed_hours",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="crowdgrid-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        taken = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        clean_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
