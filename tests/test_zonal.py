import numpy as np
import pytest
from pyspark.sql import functions as F

import rastertable as rt
from rastertable.plans import joins

from .helpers import as_array, cell_layer, random_raster

TRIANGLE = [(1.0, -1.0), (11.0, -3.0), (5.0, -14.5)]
SQUARE = [(2.0, -2.0), (12.0, -2.0), (12.0, -12.0), (2.0, -12.0)]
HOLE = [(5.0, -5.0), (9.0, -5.0), (9.0, -9.0), (5.0, -9.0)]
GEOMETRIES = {1: [TRIANGLE], 2: [SQUARE, HOLE], 3: [[(0, 0), (4, 0), (0, -4)],
                                                    [(12, -12), (16, -12), (16, -16), (12, -16)]]}


def inside(rings, h, w):
    out = np.zeros((h, w), bool)
    for ring in rings:
        for (xa, ya), (xb, yb) in zip(ring, ring[1:] + ring[:1]):
            for y in range(h):
                cy = -(y + 0.5)
                if (-ya <= -cy < -yb) or (-yb <= -cy < -ya):
                    x = xa + (cy - ya) * (xb - xa) / (yb - ya)
                    out[y] ^= x <= np.arange(w) + 0.5
    return out


@pytest.fixture(scope="module")
def edges(spark):
    return rt.edges_from_rings(spark, GEOMETRIES)


def test_spans_and_masks(spark, edges):
    a = random_raster(16, 16, gaps=0.2)
    layer = cell_layer(spark, a)
    spans = rt.polygon_spans(edges, layer.meta.layout).collect()
    for g, rings in GEOMETRIES.items():
        got = np.zeros((16, 16), bool)
        for r in spans:
            if r["geom_id"] == g:
                got[r["y"], r["x0"]:r["x1"]] = True
        np.testing.assert_array_equal(got, inside(rings, 16, 16))
    both = inside(GEOMETRIES[1], 16, 16) | inside(GEOMETRIES[2], 16, 16)
    masked = rt.mask(layer, edges.where("geom_id < 3"))
    np.testing.assert_array_equal(as_array(masked, 16, 16), np.where(both, a, np.nan))


@pytest.mark.parametrize("tile", [4, 40])
def test_wide_tiles_use_several_mask_words(spark, tile):
    a = random_raster(40, 80, gaps=0.1)
    ring = [(3.5, -2.0), (77.2, -9.0), (60.0, -38.0), (10.0, -30.0)]
    layer = cell_layer(spark, a, tile=tile)
    masked = rt.mask(layer, rt.edges_from_rings(spark, {1: [ring]}))
    np.testing.assert_array_equal(as_array(masked, 40, 80),
                                  np.where(inside([ring], 40, 80), a, np.nan))


@pytest.mark.parametrize("limit", [None, 0])
def test_zonal_statistics_on_both_join_paths(spark, edges, monkeypatch, limit):
    if limit is not None:  # nothing fits: salted shuffle joins
        monkeypatch.setattr(joins, "fits", lambda *a, **k: False)
        monkeypatch.setattr(joins, "HOT_ROWS", 1)
    a, b = random_raster(16, 16, 1), random_raster(16, 16, 2)
    rows = {(r["geom_id"], r["band"]): r for r in rt.polygonal_summary(
        cell_layer(spark, a, b), edges).collect()}
    for g, rings in GEOMETRIES.items():
        for n, band in enumerate((a, b)):
            v = band[inside(rings, 16, 16)]
            v = v[~np.isnan(v)]
            r = rows[g, n]
            assert (r["cells"], r["min"], r["max"], r["sum"]) == (len(v), v.min(), v.max(), v.sum())
            assert r["mean"] == pytest.approx(v.mean())
    points = spark.createDataFrame([(1, 0.5, -0.5), (2, 9.2, -3.1), (3, 99.0, 0.0)],
                                   "point_id bigint, x double, y double")
    found = {r["point_id"]: r["values"] for r in rt.point_values(cell_layer(spark, a, b),
                                                                 points).collect()}
    for k, (x, y) in {1: (0, 0), 2: (9, 3)}.items():
        want = [a[y, x], b[y, x]]
        if found[k] is None:
            assert np.isnan(want).all()
        else:
            np.testing.assert_array_equal([np.nan if v is None else v for v in found[k]], want)
    assert found[3] is None


def test_hot_keys_are_split_without_losing_rows(spark):
    big = spark.range(1000).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 10)
                                   .alias("k"), "id")
    side = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = joins.split_join(big, side, ["k"], how, ["id"], hot_rows=50)
        assert got.count() == big.join(side, "k", how).count()
    salted = joins.split_join(big, side, ["k"], "inner", ["id"], hot_rows=50)
    both = joins.split_join(big, big.select("k", F.col("id").alias("w")).where("w % 3 = 0"), ["k"],
                            "inner", ["id"], ["w"], hot_rows=50)
    assert both.distinct().count() == both.count() == big.join(
        big.select("k", F.col("id").alias("w")).where("w % 3 = 0"), "k").count()
    assert joins.salted_join(big, side, ["k"], ["id"]).count() == big.join(side, "k").count()
    assert salted.agg(F.sum("w")).first()[0] == big.join(side, "k").agg(F.sum("w")).first()[0]


def test_tiles_for_geometry_match_cells_and_borders(spark, edges):
    grid = cell_layer(spark, np.ones((16, 16))).meta.layout
    got = {(r["geom_id"], r["col"], r["row"]) for r in rt.tiles_for_geometry(edges, grid).collect()}
    for g, rings in GEOMETRIES.items():
        touched = set()
        for ring in rings:  # sample the borders densely
            for (xa, ya), (xb, yb) in zip(ring, ring[1:] + ring[:1]):
                for t in np.linspace(0.001, 0.999, 400):
                    x, y = xa + t * (xb - xa), -(ya + t * (yb - ya))
                    touched.add((int(x // 4), int(y // 4)))
        mine = {(c, r) for k, c, r in got if k == g}
        reachable = {(c, r) for c, r in touched if 0 <= c < 4 and 0 <= r < 4}
        # borders that run exactly along a tile line belong to the tile south-east of it
        assert reachable <= mine
        ys, xs = np.nonzero(inside(rings, 16, 16))
        assert {(x // 4, y // 4) for x, y in zip(xs, ys)} <= mine


def test_bilinear_points_interpolate_a_plane(spark):
    y, x = np.mgrid[0:16, 0:16].astype(float)
    layer = cell_layer(spark, 2 * x + 3 * y, cell_type="float64")
    rng = np.random.default_rng(0)
    at = [(int(i), float(px), float(-py)) for i, (px, py) in enumerate(rng.uniform(4, 12, (50, 2)))]
    points = spark.createDataFrame(at, "point_id bigint, x double, y double")
    for method in ("Bilinear", "CubicConvolution", "CubicSpline"):
        for r in rt.point_values(layer, points, method).collect():
            plane = 2 * (r["x"] - 0.5) + 3 * (-r["y"] - 0.5)
            assert r["values"][0] == pytest.approx(plane, abs=1e-9)


def test_quantiles_and_histograms(spark):
    a = random_raster(16, 16, gaps=0.1, top=1000) * 997 - 400000
    layer = cell_layer(spark, a)
    v = np.sort(a[~np.isnan(a)])
    got = {r["i"]: r["value"] for r in rt.quantile_breaks_exact(layer, 7).collect()}
    for i in range(1, 8):
        assert got[i] == v[int(np.ceil(i * len(v) / 7)) - 1]
    lo, hi = rt.min_max(layer).first()
    assert (lo, hi) == (v[0], v[-1])
    assert rt.histogram_exact(layer).agg(F.sum("count")).first()[0] == len(v)
    back = rt.histogram_from_json(rt.histogram_to_json(rt.histogram_exact(layer)))
    assert {(r["value"], r["count"]) for r in back.collect()} == {
        (x, float(n)) for x, n in zip(*np.unique(v, return_counts=True))}


def test_histogram_chunks_count_values(spark):
    """Also of floats that lie close together."""
    histogram = spark.range(140000).selectExpr("CAST(id % 2 AS INT) AS band", "id / 140000 AS value", "id AS count")
    rows = rt.histogram_to_json(histogram.unionAll(spark.sql("SELECT 2, 7.5D, 3L")))
    sizes = rows.selectExpr("band", "chunk", "size(from_json(json, 'array<array<double>>')) AS n").collect()
    assert sorted(map(tuple, sizes)) == [(0, 0, 65536), (0, 1, 4464), (1, 0, 65536), (1, 1, 4464), (2, 0, 1)]
    assert rt.histogram_from_json(rows).where("band < 2").exceptAll(histogram.selectExpr(
        "band", "value", "CAST(count AS DOUBLE) AS count")).isEmpty()


def test_kernels_lose_no_point_that_bilinear_fills(spark):
    layer = cell_layer(spark, random_raster(16, 16, gaps=0.7))
    rng = np.random.default_rng(4)
    at = [(int(i), float(px), float(-py)) for i, (px, py) in enumerate(rng.uniform(0, 16, (200, 2)))]
    points = spark.createDataFrame(at, "point_id bigint, x double, y double")
    filled = {}
    for method in ("Bilinear", "CubicConvolution", "Lanczos"):
        rows = rt.point_values(layer, points, method).collect()
        filled[method] = {r["point_id"] for r in rows if r["values"] is not None and r["values"][0] is not None}
    print("filled", {m: len(x) for m, x in filled.items()})
    assert filled["Bilinear"] <= filled["CubicConvolution"] and filled["Bilinear"] <= filled["Lanczos"]
