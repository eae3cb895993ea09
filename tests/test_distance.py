import heapq

import numpy as np
import pytest

import rastertable as rt
from rastertable.plans.lineage import through_table as through

from .helpers import as_array, cell_layer, layout, random_raster


def nearest(points, h, w, cell=1.0):
    y, x = np.mgrid[0:h, 0:w] + 0.5
    d = [np.hypot(x * cell - px, y * cell + py) for px, py in points]
    return np.min(d, axis=0)


def point_table(spark, points):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)],
                                 "point_id bigint, x double, y double")


@pytest.mark.parametrize("seed,n,most", [(0, 1, 4096), (1, 5, 4096), (2, 60, 4096), (2, 60, 3)])
def test_distance_to_points(spark, monkeypatch, seed, n, most):
    """As arrays, and cell by cell where nodes hold many points."""
    monkeypatch.setattr("rastertable.operators.distance.BLOCK_POINTS", most)
    rng = np.random.default_rng(seed)
    points = [(x * 64, -y * 32) for x, y in rng.random((n, 2))] + [(0.5, -0.5), (63.5, -31.5)]
    grid = layout(16, 32, cell=2.0)
    got = as_array(rt.euclidean_distance(grid, 3857, points=point_table(spark, points)), 16, 32)
    np.testing.assert_allclose(got, nearest(points, 16, 32, 2.0), atol=1e-9)


def test_a_crowded_cell_is_still_exact(spark, monkeypatch):
    monkeypatch.setattr("rastertable.operators.distance.BLOCK_POINTS", 100)
    rng = np.random.default_rng(3)
    crowd = [(5 + x / 1000, -5 - y / 1000) for x, y in rng.random((400, 2))]
    points = crowd + crowd[:50] + [(0.1, -0.1), (15.9, -15.9)]
    got = as_array(rt.euclidean_distance(layout(16, 16), 3857,
                                         points=point_table(spark, points)), 16, 16)
    np.testing.assert_allclose(got, nearest(points, 16, 16), atol=1e-9)


def test_shuffle_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr("rastertable.operators.distance.BROADCAST_BYTES", 0)
    points = [(3.3, -2.2), (12.0, -14.0), (0.0, -9.9)]
    got = as_array(rt.euclidean_distance(layout(16, 16), 3857,
                                         points=point_table(spark, points)), 16, 16)
    np.testing.assert_allclose(got, nearest(points, 16, 16), atol=1e-9)


def test_only_the_tiles_of_the_envelope(spark):
    points = [(5.0, -6.0), (9.5, -6.5)]
    got = as_array(rt.euclidean_distance(layout(16, 16), 3857,
                                         points=point_table(spark, points)), 16, 16)
    assert np.isfinite(got[4:8, 4:12]).all() and np.isfinite(got).sum() == 32
    assert rt.euclidean_distance(layout(16, 16), 3857,
                                 points=point_table(spark, points).where("false")).df.count() == 0


def test_distance_to_polygons_uses_their_cells(spark):
    ring = [(2.0, -3.0), (9.0, -5.0), (4.0, -13.0)]
    edges = rt.edges_from_rings(spark, {1: [ring], 2: [[(14, -14), (16, -14), (16, -16)]]})
    grid = layout(16, 16)
    cells = rt.to_cells(rt.rasterize_on(grid, 3857, 1, polygons=edges)).df.collect()
    points = [(r["x"] + 0.5, -r["y"] - 0.5) for r in cells]
    got = as_array(rt.euclidean_distance(grid, 3857, polygons=edges), 16, 16)
    want = nearest(points, 16, 16)
    np.testing.assert_allclose(got[~np.isnan(got)], want[~np.isnan(got)])
    assert (got[[r["y"] for r in cells], [r["x"] for r in cells]] == 0).all()


def dijkstra(f, sources, limit, cw=1.0, ch=1.0):
    h, w = f.shape
    d = np.full(f.shape, np.inf)
    heap = [(0.0, y, x) for x, y in sources if not np.isnan(f[y, x])]
    for _, y, x in heap:
        d[y, x] = 0
    while heap:
        c, y, x = heapq.heappop(heap)
        if c > d[y, x]:
            continue
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                v, u = y + dy, x + dx
                if (dx or dy) and 0 <= v < h and 0 <= u < w and not np.isnan(f[v, u]):
                    n = c + np.hypot(dx * cw, dy * ch) * (f[y, x] + f[v, u]) / 2
                    if n < d[v, u] - 1e-12 and n <= limit:
                        d[v, u] = n
                        heapq.heappush(heap, (n, v, u))
    return np.where(np.isinf(d), np.nan, d)


@pytest.mark.parametrize("seed,gaps,limit,few,region", [
    (0, 0.35, np.inf, True, 4), (1, 0.3, 60.0, True, 8), (2, 0.45, np.inf, False, 4), (3, 0.0, 25.0, False, 256),
    (4, 0.4, np.inf, True, 12)])
def test_cost_matches_dijkstra(spark, monkeypatch, seed, gaps, limit, few, region):
    monkeypatch.setattr("rastertable.operators.cost.REGION", region)
    if not few:
        monkeypatch.setattr("rastertable.operators.cost.BROADCAST_BYTES", 0)
    f = random_raster(20, 24, seed, gaps, top=9)
    sources = [(1, 1), (20, 15), (5, 5)]
    f[1, 1] = 3
    points = point_table(spark, [(x + 0.3, -y - 0.6) for x, y in sources] + [(900, 900)])
    got = as_array(rt.cost_distance(cell_layer(spark, f), points, limit), 20, 24)
    np.testing.assert_allclose(got, dijkstra(f, sources, limit), atol=1e-9)


def test_cost_through_a_winding_corridor(spark, monkeypatch):
    """One path through all regions, in and out of some of them several times."""
    monkeypatch.setattr("rastertable.operators.cost.REGION", 4)
    f = np.full((15, 12), np.nan)
    f[::2] = 1.0
    f[1::4, -1], f[3::4, 0] = 2.0, 3.0
    got = as_array(rt.cost_distance(cell_layer(spark, f), point_table(spark, [(0.5, -0.5)])), 15, 12)
    np.testing.assert_allclose(got, dijkstra(f, [(0, 0)], np.inf), atol=1e-9)
    assert np.isfinite(got[14, 5])


@pytest.mark.parametrize("kind", ["polygons", "lines", "both"])
def test_cost_from_polygons_and_lines(spark, monkeypatch, kind):
    monkeypatch.setattr("rastertable.operators.cost.REGION", 8)
    f = random_raster(16, 16, 7, 0.3, 9)
    edges = rt.edges_from_rings(spark, {1: [[(2.0, -3.0), (9.0, -5.0), (4.0, -13.0)]]})
    given = {k: edges for k in ("polygons", "lines") if kind in (k, "both")}
    cells = rt.to_cells(rt.rasterize_on(layout(16, 16), 3857, 1, **given)).df.collect()
    got = as_array(rt.cost_distance(cell_layer(spark, f), **given), 16, 16)
    np.testing.assert_allclose(got, dijkstra(f, [(r["x"], r["y"]) for r in cells], np.inf), atol=1e-9)
    with pytest.raises(ValueError, match="points, or polygons"):
        rt.cost_distance(cell_layer(spark, f))


def test_cost_rounds_follow_regions_not_tiles(spark, monkeypatch):
    """Tiles of two cells and of sixteen take the same number of rounds."""
    from rastertable.operators import cost
    monkeypatch.setattr(cost, "REGION", 16)
    f = random_raster(32, 32, 2, 0.1, 5)
    f[1, 1] = 1
    rounds = []
    for tile in (2, 16):
        written = []
        monkeypatch.setattr(cost, "through_table", lambda df, path, w=written: w.append(path) or through(df, path))
        cost_layer = rt.cost_distance(cell_layer(spark, f, tile=tile), point_table(spark, [(1.5, -1.5)]))
        rounds.append(sum("round=" in p for p in written))
        np.testing.assert_allclose(as_array(cost_layer, 32, 32), dijkstra(f, [(1, 1)], np.inf), atol=1e-9)
    assert rounds[0] == rounds[1] <= 5


def test_unit_friction_is_never_shorter_than_straight_lines(spark):
    f = np.ones((16, 16))
    points = point_table(spark, [(4.5, -4.5)])
    cost = as_array(rt.cost_distance(cell_layer(spark, f), points), 16, 16)
    line = nearest([(4.5, -4.5)], 16, 16)
    assert (cost >= line - 1e-9).all()
    blocked = np.full((8, 8), np.nan)
    blocked[7, 7] = 1
    assert rt.to_cells(rt.cost_distance(cell_layer(spark, blocked), points)).df.count() == 0


def test_cost_per_instant(spark):
    from pyspark.sql import functions as F
    f = random_raster(12, 12, 5, 0.2, 9)
    f[2, 2] = 1
    layer = cell_layer(spark, f)
    days = [layer.df.withColumn("instant", F.lit(f"2024-01-0{d} 00:00:00").cast("timestamp_ntz"))
            .withColumn("v", F.col("v") * d) for d in (1, 2)]
    both = layer.with_df(days[0].unionByName(days[1]), temporal=True)
    out = rt.cost_distance(both, point_table(spark, [(2.5, -2.5)]))
    for d in (1, 2):
        got = as_array(rt.to_spatial(out, f"2024-01-0{d} 00:00:00"), 12, 12)
        np.testing.assert_allclose(got, dijkstra(f * d, [(2, 2)], np.inf))


def test_rasterize_lines_and_time(spark):
    grid = layout(16, 16)
    line = spark.createDataFrame([(1, 0, 0.5, -0.5, 10.5, -5.5)],
                                 "geom_id bigint, ring int, x0 double, y0 double, x1 double, y1 double")
    got = as_array(rt.rasterize_on(grid, 3857, 2, lines=line), 16, 16)
    hit = set()
    for t in np.linspace(0, 1, 5001):
        hit.add((int(0.5 + 10 * t), int(0.5 + 5 * t)))
    cells = {(x, y) for y, x in zip(*np.nonzero(~np.isnan(got)))}
    # corners the line only touches may be left out
    assert cells <= hit and len(hit - cells) <= 5
    ring = [(0.0, 0.0), (8.0, 0.0), (8.0, -8.0), (0.0, -8.0)]
    out = rt.rasterize_single(rt.Extent(0, -8, 8, 0), 3857, "2024-05-06 07:08:09", 4, 4, 3,
                              rt.edges_from_rings(spark, {1: [ring]}))
    row = out.df.first()
    assert str(row["instant"]) == "2024-05-06 07:08:09" and row["bands"] == [[3] * 16]
