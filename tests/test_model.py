import math

import pytest

import rastertable as rt
from rastertable.functions.curves import UNIT_MILLIS  # noqa: F401
from rastertable.model import INTEGER_BITS  # noqa: F401

from .helpers import cell_layer, random_raster


def test_cell_types_with_their_nodata_variants():
    assert rt.CellType.parse("int16").nodata == -32768
    assert rt.CellType.parse("uint8").nodata == 0
    assert rt.CellType.parse("uint8raw").nodata is None
    assert rt.CellType.parse("int16ud-9999").nodata == -9999
    assert math.isnan(rt.CellType.parse("float32").nodata)
    for text in ("int8", "uint16raw", "int32ud7", "float64", "float32ud-1.5", "bool"):
        assert str(rt.CellType.parse(text)) == text
    with pytest.raises(ValueError):
        rt.CellType.parse("int64")


def test_union_of_cell_types():
    u = lambda a, b: rt.CellType.parse(a).union(rt.CellType.parse(b)).name
    assert u("int8", "int16") == "int16"
    assert u("uint8", "int8") == "int16"
    assert u("uint16", "int16") == "int32"
    assert u("int32", "float32") == "float64"
    assert u("float32", "float64") == "float64"


def test_key_bounds_are_half_open():
    grid = rt.Layout(rt.Extent(0, 0, 100, 100), 10, 10, 4, 4)
    assert grid.key_bounds(rt.Extent(0, 0, 100, 100)) == (0, 0, 9, 9)
    assert grid.key_bounds(rt.Extent(10, 60, 20, 80)) == (1, 2, 1, 3)
    assert grid.key_bounds(rt.Extent(15, 55, 25, 65)) == (1, 3, 2, 4)


def test_local_layout_grows_east_and_south():
    grid, zoom = rt.LocalLayout(16).layout_for(3857, rt.Extent(0, 0, 50, 20), (1.0, 1.0))
    assert zoom is None
    assert (grid.layout_cols, grid.layout_rows) == (4, 2)
    assert grid.extent == rt.Extent(0, -12, 64, 20)
    assert grid.cell_width == 1.0


def test_global_layout_level():
    world = rt.Extent(*(-20037508.342789244,) * 2, *(20037508.342789244,) * 2)
    for z in (0, 3, 9):
        size = world.width / (256 * 2 ** z)
        assert rt.GlobalLayout(256).level_for(3857, size) == z
        assert rt.GlobalLayout(256, threshold=0.1).level_for(3857, size * 0.8) == z + 1
        assert rt.GlobalLayout(256, threshold=0.1).level_for(3857, size * 0.97) == z
    grid, zoom = rt.GlobalLayout(256, zoom=5).layout_for(3857, world, (1, 1))
    assert zoom == 5 and grid.layout_cols == 32


def test_local_pyramid_levels():
    grid = rt.Layout(rt.Extent(0, 0, 70, 30), 7, 3, 8, 8)
    assert grid.level() == 3
    sizes = []
    while grid.level():
        grid = grid.zoom_out()
        sizes.append((grid.layout_cols, grid.layout_rows))
    assert sizes == [(4, 2), (2, 1), (1, 1)]
    assert rt.Layout(rt.Extent(0, 0, 1, 1), 1 << 30, 1, 1, 1).level() == 30


def test_metadata_round_trip():
    meta = rt.Meta(rt.CellType.parse("int16ud-1"), rt.Layout(rt.Extent(0, 0, 8, 8), 2, 2, 4, 4),
                   3857, 2, True, 4, rt.Extent(1, 1, 7, 7), {"minKey": {"col": 0, "row": 1}})
    assert rt.Meta.from_json(meta.to_json()) == meta


def test_layer_properties_and_controls(spark):
    layer = cell_layer(spark, random_raster(8, 8))
    tiles = rt.to_tiles(layer)
    assert tiles.zoom is None and not tiles.is_floating
    assert tiles.key_class == "SpatialKey"
    assert rt.local_divide(tiles, 2.0).is_floating
    assert tiles.repartition(3).df.rdd.getNumPartitions() == 3
    kept = tiles.persist()
    assert kept.base.is_cached
    kept.unpersist()
    assert not kept.base.is_cached
    assert '"crs": 3857' in tiles.metadata_json()


def test_key_bounds_off_the_layout():
    grid = rt.Layout(rt.Extent(0, 0, 100, 100), 10, 10, 4, 4)
    for off in (rt.Extent(100, 0, 120, 50), rt.Extent(-9, 0, 0, 50), rt.Extent(0, 100, 9, 120), rt.Extent(0, -9, 9, 0)):
        assert grid.key_bounds(off) is None
    assert grid.key_bounds(rt.Extent(99, -5, 200, 5)) == (9, 9, 9, 9)


def test_crs_texts():
    from rastertable.functions.projection import parse_crs

    assert [parse_crs(t) for t in (None, "", 3857, "EPSG:4326", "+init=epsg:32631", "+proj=longlat +datum=WGS84",
                                   "+proj=utm +zone=31", "+proj=utm +zone=5 +south")] == [
        None, None, 3857, 4326, 32631, 4326, 32631, 32705]
    with pytest.raises(ValueError):
        parse_crs("+proj=laea +lat_0=52")
