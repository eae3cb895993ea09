import numpy as np
import pytest
from pyspark.sql import functions as F

import rastertable as rt

from .helpers import as_array, cell_layer, random_raster

BYTES = [[[0, 0], [1, 1]], [[1, 2], [3, 4]], [[5, 6], [7, 8]]]


@pytest.mark.parametrize("values", BYTES)
@pytest.mark.parametrize("kind", ["int8", "uint8", "int16", "uint16", "int32", "float32", "float64"])
def test_small_tiles_survive_both_shapes(spark, values, kind):
    a = np.array(values, float)
    layer = cell_layer(spark, a, tile=2, cell_type=kind)
    np.testing.assert_array_equal(as_array(rt.to_tiles(layer), 2, 2), a)


def test_bit_tiles(spark):
    for bit in (0, 1):
        layer = cell_layer(spark, np.array([[float(bit)]]), tile=1, cell_type="bool")
        assert as_array(rt.to_tiles(layer), 1, 1)[0, 0] == bit


def test_multiband_tiles_keep_their_bands(spark):
    a = np.array([[0.0, 0.0], [1.0, 1.0]])
    tiles = rt.to_tiles(cell_layer(spark, a, a, a, tile=2))
    assert tiles.df.first()["bands"] == [[0, 0, 1, 1]] * 3


def test_gaps_become_null_and_vanish_again(spark):
    a = random_raster(9, 11, gaps=0.5)
    layer = cell_layer(spark, a)
    tiles = rt.to_tiles(layer)
    assert all(len(r["bands"][0]) == 16 for r in tiles.df.collect())
    np.testing.assert_array_equal(as_array(tiles, 9, 11), a)
    assert rt.grid(layer).count() == 16 * tiles.df.count()


@pytest.mark.parametrize("limit", [4, 6, 40])
def test_large_tiles_are_gathered_in_strips(spark, monkeypatch, limit):
    from rastertable.operators import shape
    monkeypatch.setattr(shape, "STRIP_CELLS", limit)
    a, b = random_raster(20, 24, 1, gaps=0.6), random_raster(20, 24, 2, gaps=0.95)
    tiles = rt.to_tiles(cell_layer(spark, a, b, tile=12))
    np.testing.assert_array_equal(as_array(tiles, 20, 24, 0), a)
    np.testing.assert_array_equal(as_array(tiles, 20, 24, 1), b)
    plan = tiles.df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("tile", [2, 80])
def test_duplicate_cells_are_an_error(spark, tile):
    layer = cell_layer(spark, np.ones((2, 2)), tile=tile)
    twice = layer.with_df(layer.df.union(layer.df))
    with pytest.raises(Exception, match="duplicate cell"):
        rt.to_tiles(twice).df.collect()


def test_a_chain_runs_as_one_pass(spark):
    tiles = rt.to_tiles(cell_layer(spark, random_raster(8, 8)))
    chain = abs(((tiles + 2) * 3 - 100) / 4)
    assert chain.base is tiles.base and len(chain.pending) == 5
    plan = chain.df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction(transform(") == 1


def test_operators_and_reversed_operators(spark):
    a = random_raster(6, 6)
    t = rt.to_tiles(cell_layer(spark, a))
    get = lambda layer: as_array(layer, 6, 6)
    np.testing.assert_array_equal(get(7 + t), a + 7)
    np.testing.assert_array_equal(get(7 - t), 7 - a)
    np.testing.assert_array_equal(get(t / 4), np.trunc(a / 4))
    np.testing.assert_allclose(get(t / 4.0), a / 4)
    np.testing.assert_array_equal(get(100 / t), np.trunc(100 / a))
    np.testing.assert_array_equal(get(t ** 3), a ** 3)
    np.testing.assert_allclose(get(1.5 ** t), 1.5 ** a)
    np.testing.assert_allclose(get(t ** -1), 1 / a)


def test_division_by_zero_is_nodata(spark):
    a = np.array([[0.0, 4.0], [2.0, 0.0]])
    t = rt.to_tiles(cell_layer(spark, a, tile=2))
    expected = np.array([[np.nan, 2.0], [5.0, np.nan]])
    np.testing.assert_array_equal(as_array(10 / t, 2, 2), np.where(a == 0, np.nan, np.trunc(
        10 / np.where(a == 0, 1, a))))
    assert np.isnan(as_array(t / 0, 2, 2)).all()
    assert np.isnan(as_array(rt.local_pow(t, -1), 2, 2)[0, 0])
    assert expected.shape == (2, 2)


def test_layers_of_different_band_counts_are_cut(spark):
    a, b = random_raster(4, 4, 1), random_raster(4, 4, 2)
    one, two = rt.to_tiles(cell_layer(spark, a)), rt.to_tiles(cell_layer(spark, b, a))
    out = rt.local_multiply(one, two)
    assert out.meta.bands == 1
    np.testing.assert_array_equal(as_array(out, 4, 4), a * b)


def test_convert_wraps_like_a_narrowing_cast(spark):
    a = np.array([[300.0, -1.0], [127.0, 128.0]])
    t = rt.to_tiles(cell_layer(spark, a, tile=2))
    np.testing.assert_array_equal(as_array(rt.convert(t, "int8"), 2, 2), a.astype(int).astype(np.int8))
    np.testing.assert_array_equal(as_array(rt.convert(t, "uint8"), 2, 2),
                                  a.astype(int).astype(np.uint8))
    assert rt.convert(t, "uint8").meta.cell_type.name == "uint8"
    f = rt.to_tiles(cell_layer(spark, np.array([[-1.7, 1.7]]), tile=2, cell_type="float64"))
    np.testing.assert_array_equal(as_array(rt.convert(f, "int16"), 1, 2), [[-1, 1]])


@pytest.mark.parametrize("boundary,expected", [
    ("LessThan", [1, 2, 2, 3, None]), ("LessThanOrEqualTo", [1, 1, 2, 2, None]),
    ("GreaterThan", [None, None, 1, 1, 2]), ("GreaterThanOrEqualTo", [None, 1, 1, 2, 2]),
    ("Exact", [None, 1, None, 2, None])])
def test_class_boundaries(spark, boundary, expected):
    a = np.array([[5.0, 10.0, 15.0, 20.0, 25.0]])
    breaks = {10: 1, 20: 2}
    if boundary == "LessThan":
        breaks[25] = 3
    out = rt.reclassify(cell_layer(spark, a, tile=5), breaks, boundary)
    np.testing.assert_array_equal(as_array(out, 1, 5)[0], [np.nan if e is None else e
                                                           for e in expected])


def test_reclassify_truncates_and_fills(spark):
    a = np.array([[1.9, np.nan], [3.5, 9.0]])
    layer = cell_layer(spark, a, tile=2, cell_type="float64")
    out = rt.reclassify(layer, {1: 10, 3: 30}, "Exact", replace_nodata_with=-5)
    np.testing.assert_array_equal(as_array(out, 2, 2), [[10, -5], [30, np.nan]])
    doubles = rt.reclassify(layer, {1.9: 0.5}, "Exact", double=True)
    np.testing.assert_array_equal(as_array(doubles, 2, 2), [[0.5, np.nan], [np.nan, np.nan]])


def test_color_map_and_ramp(spark):
    from rastertable.functions.classes import ramp_stops
    assert ramp_stops([1, 2, 3, 4, 5], 3) == [1, 3, 5]
    assert ramp_stops([0x00000000, 0x10204080], 3) == [0, 0x08102040, 0x10204080]
    colors = rt.ColorMap.from_map({5: 0x11, 10: 0x22}, 0x99, 0x77)
    a = np.array([[3.0, 7.0], [np.nan, 50.0]])
    row = rt.render_rgba(cell_layer(spark, a, tile=2), colors).first()
    assert row["rgba"] == [0x11, 0x22, 0x99, 0x77]
    custom = rt.render_rgba(cell_layer(spark, a, tile=2), render=lambda v: v * 2).first()
    assert custom["rgba"] == [6, 14, None, 100]


def test_composite_and_stacking(spark):
    a, b = random_raster(8, 8, 1), random_raster(8, 8, 2)
    one, two = cell_layer(spark, a), cell_layer(spark, b)
    np.testing.assert_array_equal(as_array(rt.composite([one, two]), 8, 8),
                                  np.where(np.isnan(a), b, a))
    blended = rt.composite([one, two], blend=lambda v, w: F.greatest(v, w))
    np.testing.assert_array_equal(as_array(blended, 8, 8), np.fmax(a, b))
    both = rt.combine_bands([one, two])
    np.testing.assert_array_equal(as_array(both, 8, 8, 1), b)
    twice = rt.to_tiles(one)
    twice = twice.with_df(twice.df.union(twice.df))
    with pytest.raises(Exception, match="duplicate key"):
        rt.combine_bands([twice, two]).df.collect()


def test_times(spark):
    rows = [(0, 0, f"2024-01-{d:02d} 00:00:00", [[d]]) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "col int, row int, t string, bands array<array<bigint>>")
    df = df.withColumn("instant", F.to_timestamp_ntz("t")).drop("t")
    meta = rt.Meta(rt.CellType.parse("int32"), rt.Layout(rt.Extent(0, 0, 1, 1), 1, 1, 1, 1), 3857,
                   1, temporal=True)
    layer = rt.from_tiles(df, meta)
    days = lambda t: sorted(r["bands"][0][0] for r in t.df.collect())
    day = lambda d: f"2024-01-{d:02d} 00:00:00"
    assert days(rt.filter_by_times(layer, [day(2), day(4)])) == [2, 3, 4]
    assert days(rt.filter_by_times(layer, [day(8), day(9), day(3)])) == [3, 8, 9]
    many = [day(d) for d in (1, 1, 3, 3, 5, 5, 9, 10)]
    assert days(rt.filter_by_times(layer, many)) == [1, 3, 5, 9, 10]
    assert days(rt.to_spatial(layer, day(5))) == [5]
    assert rt.to_spatial(layer, "2023-01-01 00:00:00").df.count() == 0
    flat = rt.to_spatial(layer)
    assert flat.df.count() == 10 and not flat.meta.temporal
    for form in (flat, rt.to_cells(flat)):  # arrays and cell rows
        one = lambda op: rt.to_cells(rt.aggregate_by_cell(form, op)).df.first()["v"]
        assert one("Mean") == 5.5 and one("Sum") == 55
        assert one("Variance") == pytest.approx(np.var(range(1, 11), ddof=1))


def test_sum_absorbs_nodata_and_others_skip_it(spark):
    a, b = random_raster(8, 8, 1), random_raster(8, 8, 2)
    stack = rt.union_layers([rt.to_tiles(cell_layer(spark, x)) for x in (a, b)])
    get = lambda op: as_array(rt.aggregate_by_cell(stack, op), 8, 8)
    np.testing.assert_array_equal(get("Sum"), a + b)
    np.testing.assert_array_equal(get("Min"), np.fmin(a, b))
    with pytest.raises(ValueError):
        rt.aggregate_by_cell(stack, "Total")


def test_merge_is_idempotent_and_ordered(spark):
    a, b = random_raster(8, 8, 1), random_raster(8, 8, 2)
    one, two = cell_layer(spark, a), cell_layer(spark, b)
    np.testing.assert_array_equal(as_array(rt.merge([one, two]), 8, 8), np.where(np.isnan(a), b, a))
    np.testing.assert_array_equal(as_array(rt.merge([one, one]), 8, 8), a)


def repeated_tiles(spark, n=40, tile=4):
    """Many tiles of few keys, with gaps, and what they hold per key."""
    rng = np.random.default_rng(0)
    rows, held = [], {}
    for i in range(n):
        key = (0, 0) if i % 3 else (i % 2, 1)
        a = random_raster(tile, tile * 2, i, gaps=0.4, top=50).reshape(2, tile * tile)
        held.setdefault(key, []).append((i, a))
        rows.append((*key, int(rng.integers(0, 1000)) * 1000 + i, [
            [None if np.isnan(v) else int(v) for v in band] for band in a]))
    df = spark.createDataFrame(rows, "col int, row int, priority bigint, bands array<array<bigint>>")
    meta = rt.Meta(rt.CellType.parse("int32"), rt.Layout(rt.Extent(0, 0, 8, 8), 2, 2, tile, tile),
                   3857, 2)
    order = {r[2] % 1000: r[2] for r in rows}
    return rt.from_tiles(df.repartition(5), meta), held, order


@pytest.mark.parametrize("held_bytes", [1 << 27, 600])
@pytest.mark.filterwarnings("ignore::RuntimeWarning")
def test_folding_repeated_keys(spark, monkeypatch, held_bytes):
    """A task may pass on its accumulators once or many times."""
    from rastertable.operators import fold
    monkeypatch.setattr(fold, "HELD_BYTES", held_bytes)
    layer, held, order = repeated_tiles(spark)
    expected = {"Sum": lambda s: s.sum(axis=0), "Min": lambda s: np.nanmin(s, axis=0),
                "Max": lambda s: np.nanmax(s, axis=0), "Mean": lambda s: np.nanmean(s, axis=0),
                "Variance": lambda s: np.nanvar(s, axis=0, ddof=1),
                "StandardDeviation": lambda s: np.nanstd(s, axis=0, ddof=1)}
    for op, fn in expected.items():
        rows = rt.aggregate_by_cell(layer, op).df.collect()
        assert len(rows) == len(held)
        for r in rows:
            got = np.array(r["bands"], float)
            stack = np.stack([a for _, a in held[r["col"], r["row"]]])
            np.testing.assert_allclose(got, fn(stack))
    for r in rt.merge(layer).df.collect():
        stack = sorted(held[r["col"], r["row"]], key=lambda t: order[t[0]])
        want = stack[0][1].copy()
        for _, a in stack[1:]:
            want = np.where(np.isnan(want), a, want)
        np.testing.assert_array_equal(np.array(r["bands"], float), want)
    cells = rt.merge([layer, layer])  # several layers with priorities: cell by cell
    assert cells.kind == "cell" and cells.df.count() == rt.to_cells(rt.merge(layer)).df.count()
