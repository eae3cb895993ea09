import numpy as np
import pytest

import rastertable as rt
from rastertable.functions.neighborhoods import neighborhood

from .helpers import as_array, cell_layer, random_raster


def brute(a, offsets, fn):
    out = np.full(a.shape, np.nan)
    h, w = a.shape
    for y in range(h):
        for x in range(w):
            near = [a[y + dy, x + dx] for dx, dy in offsets
                    if 0 <= y + dy < h and 0 <= x + dx < w and not np.isnan(a[y + dy, x + dx])]
            if near:
                out[y, x] = fn(near)
    return out


def mode(values):
    found, n = np.unique(values, return_counts=True)
    return found[n.argmax()]


STATS = {"Sum": sum, "Min": min, "Max": max, "Mean": np.mean, "Median": np.median, "Mode": mode,
         "StandardDeviation": np.std}


@pytest.mark.parametrize("area", [rt.Square(1), rt.Square(5), rt.Nesw(2), rt.Circle(2.5),
                                  rt.Annulus(1, 3), rt.Wedge(3, 350, 100)], ids=str)
@pytest.mark.parametrize("operation", STATS)
def test_statistics_match_brute_force(spark, operation, area):
    a = random_raster(12, 12, seed=3, top=6)  # tiles of 4: Square(5) reaches past a neighbour
    got = as_array(rt.focal(cell_layer(spark, a), operation, area), 12, 12)
    np.testing.assert_allclose(got, brute(a, area.offsets(), STATS[operation]), atol=1e-12)


def test_targets(spark):
    a = random_raster(8, 8, seed=5)
    every = brute(a, rt.Square(1).offsets(), max)
    get = lambda target: as_array(rt.focal(cell_layer(spark, a), "Max", rt.Square(1),
                                           target=target), 8, 8)
    np.testing.assert_array_equal(get("All"), every)
    np.testing.assert_array_equal(get("Data"), np.where(np.isnan(a), np.nan, every))
    np.testing.assert_array_equal(get("NoData"), np.where(np.isnan(a), every, a))


def test_blocks_of_rows_give_the_same(spark, monkeypatch):
    from rastertable.functions import stencils
    padded = np.pad(random_raster(20, 20)[None], ((0, 0), (2, 2), (2, 2)), constant_values=np.nan)
    run = stencils.focal_statistic("Median", rt.Square(2).offsets(), 2)
    whole = stencils.blockwise(run, padded, 2, 25)
    monkeypatch.setattr(stencils, "BLOCK_BYTES", 3 * 8 * 20 * 25)
    np.testing.assert_array_equal(stencils.blockwise(run, padded, 2, 25), whole)


def test_terrain_of_planes(spark):
    y, x = np.mgrid[0:12, 0:12].astype(float)
    inner = (slice(1, -1), slice(1, -1))
    for plane, facing in ((-x, 90), (x, 270), (y, 0), (-y, 180), (x + y, 315)):
        layer = cell_layer(spark, plane + 100, cell=2.0)
        aspect = as_array(rt.aspect(layer), 12, 12)[inner]
        np.testing.assert_allclose(aspect, facing, atol=1e-9)
        steep = np.degrees(np.arctan(3 * (np.sqrt(2) if facing == 315 else 1) / 2))
        np.testing.assert_allclose(as_array(rt.slope(layer, 3.0), 12, 12)[inner], steep, atol=1e-9)
    flat = cell_layer(spark, np.full((8, 8), 7.0))
    assert (as_array(rt.aspect(flat), 8, 8) == -1).all()
    assert (as_array(rt.focal(flat, "Slope"), 8, 8) == 0).all()
    shade = as_array(rt.hillshade(flat, 315, 45), 8, 8)
    assert (shade == round(255 * np.sin(np.radians(45)))).all()
    np.testing.assert_allclose(as_array(rt.tobler(flat), 8, 8), 6 * np.exp(-3.5 * 0.05))


def test_light_from_the_facing_side_is_brighter(spark):
    _, x = np.mgrid[0:8, 0:8].astype(float)
    layer = cell_layer(spark, x)  # rises to the east, so it faces west
    west, east = (as_array(rt.hillshade(layer, a, 45), 8, 8)[4, 4] for a in (270, 90))
    assert west == 255 and east == 0


def test_nodata_centre_has_no_slope(spark):
    a = random_raster(8, 8)
    for op in ("Slope", "Aspect"):
        got = as_array(rt.focal(cell_layer(spark, a), op), 8, 8)
        np.testing.assert_array_equal(np.isnan(got), np.isnan(a))


def test_wedge_wraps_and_names(spark):
    assert (1, 0) in rt.Wedge(1, 300, 60).offsets() and (-1, 0) not in rt.Wedge(1, 300, 60).offsets()
    assert neighborhood("Annulus", 1, 2) == rt.Annulus(1, 2)
    assert len(neighborhood("Square", 1.9).offsets()) == 9
    with pytest.raises(ValueError):
        neighborhood("Star", 1)


def test_instants_do_not_see_each_other(spark):
    from pyspark.sql import functions as F
    a = random_raster(8, 8, 1)
    layer = cell_layer(spark, a)
    days = [layer.df.withColumn("instant", F.lit(f"2024-01-0{d} 00:00:00").cast("timestamp_ntz"))
            .withColumn("v", F.col("v") * d) for d in (1, 2)]
    both = layer.with_df(days[0].unionByName(days[1]), temporal=True)
    out = rt.focal(both, "Sum", rt.Square(1))
    second = rt.to_spatial(out, "2024-01-02 00:00:00")
    np.testing.assert_array_equal(as_array(second, 8, 8), 2 * brute(a, rt.Square(1).offsets(), sum))


@pytest.mark.parametrize("area", [rt.Square(9), rt.Circle(9), rt.Nesw(40), rt.Annulus(5, 9), rt.Wedge(12, 20, 200), rt.Square(3)])
def test_wide_neighbourhoods_equal_offsets(area):
    """Rectangles cover each offset once, and give what the offsets give."""
    from rastertable.functions import stencils
    from rastertable.functions.neighborhoods import reach, rectangles
    offsets = area.offsets()
    boxes = rectangles(offsets)
    covered = [(x, y) for x0, x1, y0, y1 in boxes for x in range(x0, x1 + 1) for y in range(y0, y1 + 1)]
    assert sorted(covered) == sorted(offsets) and len(covered) == len(set(covered))
    r = reach(offsets)
    rng = np.random.default_rng(4)
    for kind in ("whole", "real", "far", "empty"):
        padded = rng.integers(0, 30, (2, 7 + 2 * r, 9 + 2 * r)).astype(float)
        padded += {"whole": 0, "real": rng.random(padded.shape), "far": 1e7 + rng.random(padded.shape), "empty": np.nan}[kind]
        padded[rng.random(padded.shape) < 0.4] = np.nan
        wide = stencils.Wide(offsets, r)
        for operation in ("Sum", "Mean", "StandardDeviation", "Min", "Max", "Median"):
            got = stencils._wide_statistic(operation, wide, padded)
            plain = _plain(operation, offsets, r, padded)
            np.testing.assert_allclose(got, plain, rtol=1e-9, atol=1e-6, err_msg=f"{operation} {kind}")


def _plain(operation, offsets, r, padded):
    h, w = padded.shape[1] - 2 * r, padded.shape[2] - 2 * r
    stack = np.stack([padded[:, r + dy:r + dy + h, r + dx:r + dx + w] for dx, dy in offsets])
    fn = {"Sum": np.nansum, "Mean": np.nanmean, "StandardDeviation": np.nanstd, "Min": np.nanmin, "Max": np.nanmax,
          "Median": np.nanmedian}[operation]
    with np.errstate(all="ignore"):
        import warnings
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            out = fn(stack, axis=0)
    return np.where(np.isnan(stack).all(axis=0), np.nan, out)
