"""Shares of cells that polygons cover, against polygons clipped to single cells."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import rastertable as rt
from rastertable.operators.geometry import EDGE_SCHEMA

from .helpers import as_array, cell_layer, layout, random_raster


def clipped_area(ring, x, y):
    """Signed area of a ring within the cell [x, x + 1) x [y, y + 1), cut at one side after the other."""
    for axis, at, keep in ((0, x, 1), (0, x + 1, -1), (1, y, 1), (1, y + 1, -1)):
        out = []
        for p, q in zip(ring, ring[1:] + ring[:1]):
            inside = [(r[axis] - at) * keep >= 0 for r in (p, q)]
            if inside[0]:
                out.append(p)
            if inside[0] != inside[1]:
                t = (at - p[axis]) / (q[axis] - p[axis])
                cut = [p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])]
                cut[axis] = at
                out.append(tuple(cut))
        ring = out
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1])) / 2 if ring else 0.0


def shares(rings, h, w):
    """Rings as (points, sign) in cell coordinates."""
    out = np.zeros((h, w))
    for ring, sign in rings:
        whole = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1]))
        for y in range(h):
            for x in range(w):
                out[y, x] += sign * np.sign(whole) * clipped_area(ring, x, y)
    return out


def star(rng, cx, cy, low, high, n, back=False):
    angle = np.sort(rng.random(n)) * 2 * np.pi
    r = rng.uniform(low, high, n)
    points = list(zip((cx + r * np.cos(angle)).tolist(), (cy + r * np.sin(angle)).tolist()))
    return points[::-1] if back else points


def south(ring):
    return [(x, -y) for x, y in ring]


def on_grid(spans, h, w):
    out = np.zeros((h, w))
    for r in spans.collect():
        assert not out[r["y"], r["x0"]:r["x1"]].any()
        out[r["y"], r["x0"]:r["x1"]] = r["share"]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_stars_with_holes_and_islands(spark, seed):
    """Rings that run either way round; a hole, an island in the hole, and a part that leaves the grid."""
    rng = np.random.default_rng(seed)
    outer, hole = star(rng, 8.3, 7.9, 6, 9, 40, seed % 2), star(rng, 8.3, 7.9, 3, 5, 25, seed // 2)
    island, part = star(rng, 8.3, 7.9, 0.1, 2, 12), star(rng, 24, 20, 2, 6, 9, True)
    rings = [(outer, 1), (hole, -1), (island, 1), (part, 1)]
    edges = rt.edges_from_rings(spark, {7: [south(r) for r, _ in rings]})
    want = shares(rings, 16, 24)
    got = on_grid(rt.coverage_spans(edges, layout(16, 24)), 16, 24)
    np.testing.assert_allclose(got, want, atol=1e-9)
    raster = np.nan_to_num(as_array(rt.rasterize_coverage(layout(16, 24), 3857, edges), 16, 24))
    np.testing.assert_allclose(raster, want, atol=1e-9)


def test_a_polygon_around_the_grid_and_far_rings(spark):
    """Cells that only rings beyond the grid's sides enclose; hundreds of corners in one cell."""
    rng = np.random.default_rng(5)
    small = star(rng, 3.5, 3.5, 0.1, 0.45, 300)
    rings = [([(-9, -9), (40, -9), (40, 40), (-9, 40)], 1), (small, -1)]
    edges = rt.edges_from_rings(spark, {1: [south(r) for r, _ in rings]})
    got = on_grid(rt.coverage_spans(edges, layout(8, 8)), 8, 8)
    np.testing.assert_allclose(got, shares(rings, 8, 8), atol=1e-9)
    assert got[3, 3] < 1 and (got == 1).sum() == 63


def test_borders_on_cell_sides_and_several_polygons(spark):
    square = lambda a, b, c, d: [(a, -b), (c, -b), (c, -d), (a, -d)]
    edges = rt.edges_from_rings(spark, {1: [square(1, 1, 3, 3)], 2: [square(2.5, 2, 4, 3)]})
    one = on_grid(rt.coverage_spans(edges.where("geom_id = 1"), layout(8, 8)), 8, 8)
    assert (one[1:3, 1:3] == 1).all() and one.sum() == 4
    both = as_array(rt.rasterize_coverage(layout(8, 8), 3857, edges, instant="2024-05-06 07:08:09"), 8, 8)
    assert both[2, 1:5].tolist()[:3] == [1.0, 1.5, 1.0] and np.isnan(both[2, 4]) and np.nansum(both) == 5.5


def test_nothing_and_flat_rings(spark):
    none = spark.createDataFrame([], EDGE_SCHEMA)
    assert rt.coverage_spans(none, layout(8, 8)).count() == 0
    assert rt.rasterize_coverage(layout(8, 8), 3857, none).df.count() == 0
    flat = rt.edges_from_rings(spark, {1: [[(1, -1), (5, -1), (3, -1)]], 2: [[(1, -1), (5, -5), (1, -1)]],
                                       3: [[(20, -1), (30, -1), (30, -9)]]})
    assert rt.coverage_spans(flat, layout(8, 8)).count() == 0


@pytest.mark.parametrize("budget", [None, 0])
def test_weighted_zones(spark, monkeypatch, budget):
    """Against shares times values, with gaps in the data, by broadcast and by shuffle."""
    if budget is not None:
        monkeypatch.setattr("rastertable.plans.joins.BROADCAST_BYTES", budget)
    rng = np.random.default_rng(9)
    values = random_raster(16, 24, seed=9)
    polygons = {g: [star(rng, *rng.uniform(4, 16, 2), 2, 6, 20)] for g in range(5)}
    edges = rt.edges_from_rings(spark, {g: [south(r) for r in rings] for g, rings in polygons.items()})
    layer = cell_layer(spark, values)
    got = {r["geom_id"]: r for r in rt.polygonal_weighted(layer, edges).collect()}
    for g, rings in polygons.items():
        share = np.where(np.isnan(values), 0, shares([(rings[0], 1)], 16, 24))
        assert got[g]["weight"] == pytest.approx(share.sum(), abs=1e-6)
        assert got[g]["sum"] == pytest.approx((share * np.nan_to_num(values)).sum(), abs=1e-6)
        assert got[g]["mean"] == pytest.approx(got[g]["sum"] / got[g]["weight"])


def test_weighted_zones_in_time(spark):
    values = random_raster(8, 8, seed=2)
    layer = cell_layer(spark, values)
    days = [layer.df.withColumn("instant", F.lit(f"2024-01-0{d} 00:00:00").cast("timestamp_ntz"))
            .withColumn("v", F.col("v") * d) for d in (1, 2)]
    both = layer.with_df(days[0].unionByName(days[1]), temporal=True)
    edges = rt.edges_from_rings(spark, {1: [[(0.5, -0.5), (7.25, -0.5), (7.25, -7), (0.5, -7)]]})
    one, two = rt.polygonal_weighted(both, edges).orderBy("instant").collect()
    assert two["sum"] == pytest.approx(2 * one["sum"]) and two["weight"] == one["weight"]
