"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then three times into the ``noop`` sink; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "local_chain", "local_add_layer", "focal_Mean_Square", "focal_Median_Circle", "slope",
    "hillshade", "mask", "polygonal_mean", "mean_series", "point_values", "tile_to_layout",
    "resample_Bilinear", "reproject_tiles", "pyramid_average", "aggregate_by_cell_Mean", "merge",
    "quantile_breaks_exact", "rasterize", "euclidean_distance", "cost_distance",
    "read_layer_envelope", "read_tiles_zoomed",
]


def main() -> None:
    from checks.all_queries import QUERIES
    from checks.run import session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
