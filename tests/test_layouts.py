from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

import rastertable as rt
from rastertable.functions.projection import transform, transform_extent

from .helpers import as_array, cell_layer, layout, random_raster


def scenes(spark, rows, temporal=False):
    """Scenes from (id, xmin, ymax, array) with unit cells."""
    data = [(n, 3857, float(x), float(y - a.shape[0]), float(x + a.shape[1]), float(y), a.shape[1],
             a.shape[0], [[None if np.isnan(v) else float(v) for v in a.ravel()]])
            for n, x, y, a in rows]
    df = spark.createDataFrame(data, "scene_id bigint, epsg int, xmin double, ymin double, "
                               "xmax double, ymax double, cols int, rows int, bands array<array<double>>")
    return rt.from_scenes(df, rt.Meta(rt.CellType.parse("float64"), None, 3857, 1))


@pytest.mark.parametrize("step", [1.0, 0.7, 1.6])
@pytest.mark.parametrize("tile", [2, 10, 50])
def test_scenes_by_nearest_neighbour(spark, step, tile):
    """The lowest id that has data, by any size of tile; of equal ids the smaller value."""
    placed = [(n // 2, 3 * n % 7 + 0.3, -2 * n % 5 - 0.2, random_raster(6, 5, n)) for n in range(8)]
    n = 50
    target = rt.Layout(rt.Extent(-1.0, -n * step, n * step - 1.0, 0.0), n // tile, n // tile, tile, tile)
    want = np.full((n, n), np.nan)
    for y in range(n):
        for x in range(n):
            found = []
            for scene, left, top, a in placed:
                i, j = int(np.floor(-1.0 + (x + 0.5) * step - left)), int(np.floor(top + (y + 0.5) * step))
                if 0 <= i < a.shape[1] and 0 <= j < a.shape[0] and not np.isnan(a[j, i]):
                    found.append((scene, a[j, i]))
            want[y, x] = min(found)[1] if found else np.nan
    for rows in (placed, placed[::-1]):
        got = rt.tile_to_layout(scenes(spark, rows), target)
        np.testing.assert_array_equal(as_array(got, n, n), want)
    assert np.isfinite(want).sum() > 20


def plain_kernel(a, target_n, method):
    """A square raster resampled to ``target_n`` cells: kernel weights over data cells, bilinear ones
    where these carry 0.3 or less."""
    from rastertable.functions.kernels import SUPPORT, kernel_array, least_weight, negative_lobes
    n, out = len(a), np.full((target_n, target_n), np.nan)
    for y in range(target_n):
        for x in range(target_n):
            u, v = ((p + 0.5) * n / target_n for p in (x, y))
            for kernel in (method, "Bilinear")[:2 if negative_lobes(method) else 1]:
                r, w, wv = SUPPORT[method], 0.0, 0.0
                for j in range(int(np.floor(v - 0.5)) + 1 - r, int(np.floor(v - 0.5)) + r + 1):
                    for i in range(int(np.floor(u - 0.5)) + 1 - r, int(np.floor(u - 0.5)) + r + 1):
                        if 0 <= i < n and 0 <= j < n and not np.isnan(a[j, i]):
                            k = kernel_array(kernel, np.array(u - 0.5 - i)) * kernel_array(kernel, np.array(v - 0.5 - j))
                            w, wv = w + k, wv + k * a[j, i]
                if w > least_weight(kernel):
                    out[y, x] = wv / w
                    break
    return out


@pytest.mark.parametrize("method", ["Bilinear", "CubicConvolution", "CubicSpline", "Lanczos"])
@pytest.mark.parametrize("tile", [5, 10, 20])
def test_kernels_with_gaps(spark, method, tile):
    """Across tile borders and beside NoData; no kernel loses a cell that Bilinear fills."""
    a = random_raster(16, 16, 8, gaps=0.3)
    layer = cell_layer(spark, a)
    target = replace(layer.meta.layout, layout_cols=20 // tile, layout_rows=20 // tile, tile_cols=tile, tile_rows=tile)
    got = as_array(rt.resample(layer, target, method), 20, 20)
    np.testing.assert_allclose(got, plain_kernel(a, 20, method), rtol=1e-9)
    assert not (np.isnan(got) & ~np.isnan(plain_kernel(a, 20, "Bilinear"))).any()
    scene = scenes(spark, [(1, 0, 0, a)])
    np.testing.assert_allclose(as_array(rt.tile_to_layout(scene, target, method), 20, 20), plain_kernel(a, 20, method), rtol=1e-9)


@pytest.mark.parametrize("method", ["NearestNeighbor", "Bilinear", "Lanczos", "Average", "Max"])
@pytest.mark.parametrize("grain", [1 << 18, 50])
def test_reprojection_against_formulas(spark, monkeypatch, method, grain):
    """Every target cell looked up on its own, from a coarse and a fine grid, in tiles and in blocks."""
    from rastertable.operators import scatter
    monkeypatch.setattr(scatter, "GRAIN", grain)
    a = random_raster(16, 16, 9)
    step = 0.01
    at = rt.Layout(rt.Extent(2.0, 50.0, 2.0 + 16 * step, 50.0 + 16 * step), 4, 4, 4, 4)
    layer = cell_layer(spark, a)
    layer = layer.with_df(layer.df, layout=at, epsg=4326)
    corners = [transform(x, y, 4326, 32631) for x in (2.0, 2.16) for y in (50.0, 50.16)]
    xs, ys = [c[0] for c in corners], [c[1] for c in corners]
    n = 24
    target = rt.Layout(rt.Extent(min(xs) - 900, min(ys) - 900, max(xs) + 900, max(ys) + 900), 3, 3, 8, 8)
    want = np.full((n, n), np.nan)
    if method in ("Average", "Max"):
        found = {}
        for j, i in zip(*np.nonzero(~np.isnan(a))):
            x, y = transform(2.0 + (i + 0.5) * step, 50.16 - (j + 0.5) * step, 4326, 32631)
            key = int((target.extent.ymax - y) // target.cell_height), int((x - target.extent.xmin) // target.cell_width)
            found.setdefault(key, []).append(a[j, i])
        for key, v in found.items():
            want[key] = np.mean(v) if method == "Average" else max(v)
    else:
        from rastertable.functions.kernels import SUPPORT, kernel_array
        for y in range(n):
            for x in range(n):
                lon, lat = transform(target.extent.xmin + (x + 0.5) * target.cell_width,
                                     target.extent.ymax - (y + 0.5) * target.cell_height, 32631, 4326)
                u, v = (lon - 2.0) / step, (50.16 - lat) / step
                if not (0 <= u < 16 and 0 <= v < 16):
                    continue
                if method == "NearestNeighbor":
                    want[y, x] = a[int(v), int(u)]
                    continue
                for kernel, least in ((method, 0.3 if method == "Lanczos" else 1e-9), ("Bilinear", 1e-9)):
                    r, w, wv = SUPPORT[method], 0.0, 0.0
                    for j in range(max(0, int(np.floor(v - 0.5)) + 1 - r), min(16, int(np.floor(v - 0.5)) + r + 1)):
                        for i in range(max(0, int(np.floor(u - 0.5)) + 1 - r), min(16, int(np.floor(u - 0.5)) + r + 1)):
                            if not np.isnan(a[j, i]):
                                k = float(kernel_array(kernel, np.array(u - 0.5 - i)) * kernel_array(kernel, np.array(v - 0.5 - j)))
                                w, wv = w + k, wv + k * a[j, i]
                    if w > least:
                        want[y, x] = wv / w
                        break
    got = as_array(rt.reproject(layer, 32631, target, method), n, n)
    np.testing.assert_allclose(got, want, rtol=1e-9)
    assert np.isfinite(want).sum() > 100


def test_resampling_plan_moves_arrays(spark):
    """No exchange whose rows are cells."""
    layer = rt.to_tiles(cell_layer(spark, random_raster(16, 16, 1)))
    target = replace(layer.meta.layout, tile_cols=3, tile_rows=3)
    plan = rt.resample(layer, target, "Lanczos").df._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    resampled = physical[:physical.rindex("MapInArrow")]
    assert resampled.count("Exchange hashpartitioning(col") == 1 and "Exchange hashpartitioning(x" not in physical


@pytest.mark.parametrize("order", [1, -1])
def test_merge_does_not_depend_on_the_order_of_rows(spark, order):
    rows = [(0, 0, 0, 5), (0, 0, 0, 3), (1, 0, 0, 2**53 + 1), (1, 0, 0, 2**53 + 2)][::order]
    meta = cell_layer(spark, np.ones((4, 4))).meta
    cells = rt.from_cells(spark.createDataFrame(rows, "x bigint, y bigint, band int, v bigint").coalesce(1), meta)
    assert {r["x"]: r["v"] for r in rt.merge(cells).df.collect()} == {0: 3, 1: 2**53 + 1}
    tiles = [[(2**53 + 1), 5], [2**53 + 2, 3]][::order]
    df = spark.createDataFrame([(0, 0, [[a, b, None, a]]) for a, b in tiles], "col int, row int, bands array<array<bigint>>")
    small = rt.from_tiles(df.coalesce(1), rt.Meta(rt.CellType.parse("int32"), layout(2, 2, 2), 3857, 1))
    merged = rt.merge(small).df.first()["bands"][0]
    assert list(merged) == [2**53 + 1, 3, None, 2**53 + 1]
    found = {op: list(rt.aggregate_by_cell(small, op).df.first()["bands"][0]) for op in ("Min", "Max", "Sum", "Mean")}
    assert found["Min"] == [2**53 + 1, 3, None, 2**53 + 1] and found["Max"][0] == 2**53 + 2
    assert found["Sum"] == [2**54 + 3, 8, None, 2**54 + 3] and found["Mean"][1] == 4.0


def test_overlapping_scenes_merge_by_id(spark):
    a, b = random_raster(6, 6, 1), random_raster(6, 6, 2)
    layer = scenes(spark, [(2, 3, -2, b), (1, 0, 0, a)])
    grid = layout(12, 12)
    got = as_array(rt.tile_to_layout(layer, grid), 12, 12)
    want = np.full((12, 12), np.nan)
    want[2:8, 3:9] = b
    want[:6, :6] = np.where(np.isnan(a), want[:6, :6], a)
    np.testing.assert_array_equal(got, want)
    split = rt.split_scenes(layer, 4)
    assert split.df.agg(F.max("cols"), F.max("rows")).first() == (4, 4)
    np.testing.assert_array_equal(as_array(rt.tile_to_layout(split, grid), 12, 12), want)


def test_metadata_needs_one_crs(spark):
    a = random_raster(4, 4)
    layer = scenes(spark, [(1, 0, 0, a), (2, 4, 0, a)])
    meta = rt.collect_metadata(layer, rt.LocalLayout(4))
    assert meta.extent == rt.Extent(0, -4, 8, 0)
    assert meta.bounds == {"minKey": {"col": 0, "row": 0}, "maxKey": {"col": 1, "row": 0}}
    mixed = layer.with_df(layer.df.withColumn("epsg", F.when(F.col("scene_id") == 1, 3857)
                                              .otherwise(4326)))
    assert rt.raster_summary(mixed).count() == 2
    with pytest.raises(ValueError, match="exactly one CRS"):
        rt.collect_metadata(mixed, rt.LocalLayout(4))


@pytest.mark.parametrize("method", ["Bilinear", "CubicConvolution", "CubicSpline", "Lanczos"])
def test_kernels_keep_constants(spark, method):
    layer = cell_layer(spark, np.full((16, 16), 7.0))
    for tile in (3, 7):
        target = replace(layer.meta.layout, tile_cols=tile, tile_rows=tile)
        got = as_array(rt.resample(layer, target, method), 4 * tile, 4 * tile)
        np.testing.assert_allclose(got, 7.0)


def test_bilinear_and_cubic_keep_planes_inside(spark):
    y, x = np.mgrid[0:16, 0:16].astype(float)
    layer = cell_layer(spark, 2 * x + 3 * y)
    target = replace(layer.meta.layout, tile_cols=6, tile_rows=6)
    ty, tx = (np.mgrid[0:24, 0:24] + 0.5) * 16 / 24 - 0.5
    for method in ("Bilinear", "CubicConvolution", "CubicSpline"):
        got = as_array(rt.resample(layer, target, method), 24, 24)
        np.testing.assert_allclose(got[4:-4, 4:-4], (2 * tx + 3 * ty)[4:-4, 4:-4])


@pytest.mark.parametrize("method", ["Average", "Mode", "Median", "Max", "Min", "NearestNeighbor",
                                    "Bilinear"])
def test_shrinking_in_place_equals_resampling(spark, method):
    a = random_raster(16, 16, 4, top=5)
    layer = cell_layer(spark, a, random_raster(16, 16, 5))
    fast = rt.pyramid(layer, method, end_zoom=1)[1]
    slow = rt.resample(layer, layer.meta.layout.zoom_out(), method)
    for band in (0, 1):
        np.testing.assert_allclose(as_array(fast, 8, 8, band), as_array(slow, 8, 8, band))


@pytest.mark.parametrize("materialize", [False, True])
def test_pyramid_reaches_one_tile_on_uneven_layouts(spark, materialize):
    a = random_raster(12, 28, 6)
    levels = rt.pyramid(cell_layer(spark, a), "Max", materialize=materialize)
    assert [t.zoom for t in levels] == [3, 2, 1, 0]
    assert [(t.meta.layout.layout_cols, t.meta.layout.layout_rows) for t in levels] == [
        (7, 3), (4, 2), (2, 1), (1, 1)]
    top = as_array(levels[-1], 4, 4)
    assert np.nanmax(top) == np.nanmax(a)
    empty = cell_layer(spark, a)
    with pytest.raises(ValueError, match="empty"):
        rt.pyramid(empty.with_df(empty.df.where("false")))


def test_global_pyramid(spark):
    a = random_raster(16, 16, 7)
    layer = cell_layer(spark, a)
    layer = layer.with_df(layer.df, layout=rt.global_level(3857, 2, 4), zoom=2)
    levels = rt.pyramid(layer, "Average")
    assert [t.zoom for t in levels] == [2, 1, 0]
    pairs = np.nanmean(a.reshape(8, 2, 8, 2).swapaxes(1, 2).reshape(8, 8, 4), axis=2)
    np.testing.assert_allclose(as_array(levels[1], 8, 8), pairs)


def test_resize_tiles(spark):
    a = random_raster(8, 8, 8)
    out = rt.resample_to_power_of_two(cell_layer(spark, a), 3, 1)
    at = out.meta.layout
    assert (at.tile_cols, at.tile_rows, at.layout_cols) == (8, 2, 2)
    got = as_array(out, 4, 16)
    np.testing.assert_array_equal(got, np.repeat(a, 2, axis=1)[1::2])


@pytest.mark.parametrize("size,dx,dy", [(6, 0, 0), (3, 5, 2), (16, -3, -1), (32, 1, 1)])
def test_other_tilings_of_the_same_cells(spark, size, dx, dy):
    a, b = random_raster(16, 16, 11), random_raster(16, 16, 12)
    layer = rt.to_tiles(cell_layer(spark, a, b))
    n = -(-(16 + 6) // size)
    target = rt.Layout(rt.Extent(-dx, dy - n * size, n * size - dx, dy), n, n, size, size)
    for method in ("NearestNeighbor", "Average", "Lanczos"):
        out = rt.tile_to_layout(layer, target, method)
        slow = rt.tile_to_layout(rt.to_cells(layer), target, method)
        for band, source in enumerate((a, b)):
            got = as_array(out, n * size, n * size, band)
            want = np.full((n * size, n * size), np.nan)
            for y in range(16):
                for x in range(16):
                    if 0 <= y + dy < n * size and 0 <= x + dx < n * size:
                        want[y + dy, x + dx] = source[y, x]
            np.testing.assert_array_equal(got, want)
            np.testing.assert_allclose(as_array(slow, n * size, n * size, band), want)
    plan = rt.tile_to_layout(layer, target).df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_crop_and_stitch(spark):
    a = random_raster(16, 16, 9)
    layer = rt.to_tiles(cell_layer(spark, a))
    part = rt.crop(layer, rt.Extent(3.0, -11.0, 9.0, -2.0))
    want = np.full_like(a, np.nan)
    want[2:11, 3:9] = a[2:11, 3:9]
    np.testing.assert_array_equal(as_array(part, 16, 16), want)
    one = rt.stitch_cells(part, rt.Extent(3.0, -11.0, 9.0, -2.0), 3, 3, "Max")
    assert one.meta.layout.layout_cols == 1
    blocks = a[2:11, 3:9].reshape(3, 3, 3, 2).swapaxes(1, 2).reshape(3, 3, 6)
    np.testing.assert_array_equal(as_array(one, 3, 3), np.nanmax(blocks, axis=2))


def test_known_coordinates():
    # published: Mercator of 180 degrees; UTM 31N of the zone's meridian at the equator
    assert transform(180.0, 0.0, 4326, 3857)[0] == pytest.approx(20037508.342789244)
    assert transform(3.0, 0.0, 4326, 32631) == pytest.approx((500000.0, 0.0))
    # CN Tower, UTM zone 17: 630084 E, 4833438 N
    x, y = transform(-79.387139, 43.642567, 4326, 32617)
    assert (x, y) == pytest.approx((630084, 4833438), abs=2)
    lon, lat = transform(630084, 4833438, 32617, 4326)
    assert (lon, lat) == pytest.approx((-79.387139, 43.642567), abs=2e-5)
    assert transform(21.0, -33.0, 4326, 32734)[1] > 6e6
    with pytest.raises(ValueError):
        transform(0, 0, 4326, 2004)


def test_there_and_back_is_within_a_cell(spark):
    a = random_raster(16, 16, 10, gaps=0.0)
    layer = cell_layer(spark, a, cell=30.0)
    area = layer.meta.layout.extent
    away = transform_extent(area, 3857, 4326)
    fine = rt.Layout(away, 4, 4, 32, 32)
    there = rt.reproject(layer, 4326, fine)
    back = rt.reproject(there, 3857, layer.meta.layout)
    np.testing.assert_array_equal(as_array(back, 16, 16), a)
    best = rt.reproject(layer, 4326, rt.GlobalLayout(8))
    assert best.zoom is not None and best.df.count() > 0
    assert rt.reproject(layer, 4326).meta.layout.tile_cols == 256


def test_utm_covers_the_source(spark):
    a = np.ones((64, 64))
    layer = cell_layer(spark, a, tile=16)
    layer = layer.with_df(layer.df, epsg=4326,
                          layout=rt.Layout(rt.Extent(2.0, 40.0, 4.0, 42.0), 4, 4, 16, 16))
    out = rt.reproject(layer, 32631, rt.LocalLayout(16))
    n = rt.to_cells(out).df.count()
    at = out.meta.layout
    area = n * at.cell_width * at.cell_height
    truth = 2 * 111320 * np.cos(np.radians(41)) * 2 * 111050
    assert area == pytest.approx(truth, rel=0.02)


def repeated(spark):
    """One tile key twice: 1 in the upper half, 2 in the lower half, NoData elsewhere."""
    upper, lower = np.full((4, 4), np.nan), np.full((4, 4), np.nan)
    upper[:2], lower[2:] = 1.0, 2.0
    tiles = [rt.to_tiles(cell_layer(spark, a)) for a in (upper, lower)]
    return rt.union_layers(tiles), np.fmax(upper, lower)


@pytest.mark.parametrize("target", [layout(4, 4, 2), layout(4, 4, 3), layout(8, 8, 8)])
def test_repeated_keys_lose_nothing_when_cut_anew(spark, target):
    layer, whole = repeated(spark)
    got = rt.tile_to_layout(layer, target)
    assert got.df.groupBy("col", "row").count().where("count > 1").isEmpty()
    np.testing.assert_array_equal(as_array(got, 8, 8)[:4, :4], whole)


def test_repeated_keys_in_a_pyramid(spark):
    layer, whole = repeated(spark)
    layer = layer.with_df(layer.df, layout=replace(layout(8, 8), tile_cols=4, tile_rows=4))
    top = rt.pyramid(layer, "Max")[-1]
    np.testing.assert_array_equal(as_array(top, 4, 4)[:2, :2], [[1, 1], [2, 2]])


def test_equal_ranks_merge_to_the_smaller_value(spark):
    tiles = [rt.to_tiles(cell_layer(spark, np.full((4, 4), v))) for v in (3.0, 2.0)]
    np.testing.assert_array_equal(as_array(rt.merge(rt.union_layers(tiles)), 4, 4), np.full((4, 4), 2.0))


def test_mixed_band_counts_keep_what_all_have(spark):
    one, two = np.full((4, 4), 1.0), np.full((4, 4), 5.0)
    mixed = rt.union_layers([rt.to_tiles(cell_layer(spark, one)), rt.to_tiles(cell_layer(spark, two, two))])
    summed = rt.aggregate_by_cell(mixed, "Sum").df.collect()
    assert [len(r["bands"]) for r in summed] == [1]
    assert list(summed[0]["bands"][0]) == [6] * 16


def test_scenes_without_data_make_no_tile(spark):
    layer = scenes(spark, [(1, 0, 0, np.full((4, 4), 3.0)), (2, 4, -4, np.full((4, 4), np.nan))])
    found = rt.tile_to_layout(layer, layout(8, 8)).df.select("col", "row").collect()
    assert [tuple(r) for r in found] == [(0, 0)]


def test_scene_ids_are_whole_numbers(spark):
    layer = scenes(spark, [(1, 0, 0, np.full((4, 4), 3.0))])
    named = layer.with_df(layer.df.withColumn("scene_id", F.lit("a")))
    with pytest.raises(ValueError, match="whole number"):
        rt.tile_to_layout(named, layout(8, 8))
