"""Operators over a layer of 256 x 256 tiles that already lies in Parquet: ``python -m checks.stored_bench sf0.1``.

The layer is FX1 on a grid twice as fine (two bands), written once before the clock starts, so that the
times are those of the operators alone. Each runs once to warm up and then three times into the ``noop``
sink; printed are the median and the spread of the three.
"""

from __future__ import annotations

import statistics
import sys
import time
from dataclasses import replace


import rastertable as rt
from rastertable.plans.lineage import run_folder, through_table

from .fixtures import TALL, fx1_cells, map_edges, map_points
from .run import session

FINE = rt.Layout(TALL.extent, 1, 1 << 15, 256, 256)


def main() -> None:
    spark, sf = session(), f"/root/testdata/{sys.argv[1]}"
    fine = rt.to_tiles(rt.resample(fx1_cells(spark, sf), FINE))
    layer = fine.with_df(through_table(fine.df, run_folder(spark, "stored")))
    print("tiles", layer.df.count(), flush=True)
    edges = through_table(map_edges(spark, sf), run_folder(spark, "edges"))
    points = through_table(map_points(spark, sf), run_folder(spark, "points"))
    coarse = replace(FINE, tile_cols=192, tile_rows=192)
    utm = rt.LocalLayout(256)
    degrees = layer.with_df(layer.df, epsg=4326, layout=rt.Layout(rt.Extent(2.0, 10.0 - 0.0005 * (1 << 23), 2.128, 10.0), 1, 1 << 15, 256, 256),
                            extent=rt.Extent(2.0, 0.0, 2.128, 10.0))
    stack = rt.union_layers([layer, layer + 1, layer * 2])
    operators = {
        "chain of six": lambda: ((layer + 1) * 2 - 3) / 4 + 5 - 6,
        "mean 7x7": lambda: rt.focal(layer, "Mean", rt.Square(3)),
        "mean 81x81": lambda: rt.focal(layer, "Mean", rt.Square(40)),
        "median 29 cells": lambda: rt.focal(layer, "Median", rt.Circle(3)),
        "median 81x81": lambda: rt.focal(layer, "Median", rt.Square(40)),
        "slope": lambda: rt.slope(layer),
        "merge of two": lambda: rt.merge([0 - layer, layer]),
        "variance of three": lambda: rt.aggregate_by_cell(stack, "Variance"),
        "nearest to 6/8": lambda: rt.resample(layer, coarse),
        "bilinear to 6/8": lambda: rt.resample(layer, coarse, "Bilinear"),
        "lanczos to 6/8": lambda: rt.resample(layer, coarse, "Lanczos"),
        "reproject to UTM": lambda: rt.reproject(degrees, 32631, utm),
        "zonal sum": lambda: rt.polygonal_sum(layer, edges),
        "cost from points, limit 100": lambda: rt.cost_distance(layer, points, 100.0),
        "distance to points": lambda: rt.euclidean_distance(FINE, 3857, points=points),
    }
    for name, run in operators.items():
        if len(sys.argv) > 2 and not any(w in name for w in sys.argv[2:]):
            continue
        times = []
        for _ in range(4):
            start = time.perf_counter()
            out = run()
            (out if hasattr(out, "write") else out.df).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        kept = sorted(times[1:])
        print(f"{name:28s} {statistics.median(kept):7.2f} s  ({kept[0]:.2f} to {kept[-1]:.2f})", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
