import json

import numpy as np
import pytest
from pyspark.sql import functions as F

import rastertable as rt
from rastertable.functions import curves
from rastertable.plans.lineage import run_folder
from rastertable.sources.catalog import key_index
from rastertable.streaming.tiles import answer_requests, serve_requests

from .helpers import as_array, cell_layer, random_raster


@pytest.fixture()
def store(spark):
    return rt.Catalog(spark, run_folder(spark, "catalog"))


def test_attributes(store):
    assert store.read_attribute("a", 0, "color") is None
    store.write_attribute("a", 0, "color", '{"r": 1}')
    store.write_attribute("a", 0, "color", '{"r": 2}')
    store.write_attribute("a", 1, "color", '"blue"')
    store.write_attribute("a", 0, "color", None)
    assert json.loads(store.read_attribute("a", 0, "color")) == {"r": 2}
    with pytest.raises(ValueError):
        store.write_attribute("a", 0, "color", "{not json")
    store.delete_attribute("a", 0, "color")
    assert store.read_attribute("a", 0, "color") is None
    assert store.read_attribute("a", 1, "color") == '"blue"'


@pytest.mark.parametrize("index", ["zorder", "hilbert", "rowmajor"])
def test_layers_come_back(spark, store, index):
    a = random_raster(16, 16)
    layer = rt.convert(cell_layer(spark, a), "int8")
    assert not store.contains("a", 0)
    store.write_layer("a", layer, index)
    assert store.contains("a", 0) and store.value_class("a", 0) == "SpatialKey"
    assert store.layer_ids().collect() == [("a", 0)]
    again = store.read_layer("a", 0)
    np.testing.assert_array_equal(as_array(again, 16, 16), a)
    assert again.meta.cell_type.name == "int8"
    part = store.read_layer("a", 0, envelope=rt.Extent(4, -8, 12, -4))
    assert {(r["col"], r["row"]) for r in rt.keys(part).collect()} == {(1, 1), (2, 1)}
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = part.df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(col,1)" in plan and "LessThanOrEqual(row,1)" in plan
    assert store.read_tile("a", 0, 3, 2).count() == 1
    assert store.read_tile("a", 0, 30, 2).count() == 0
    assert store.in_bounds("a", 0, 3, 3) and not store.in_bounds("a", 0, 4, 0)
    store.delete_layer("a", 0)
    assert not store.contains("a", 0)
    with pytest.raises(KeyError):
        store.read_layer("a", 0)
    with pytest.raises(ValueError):
        store.write_layer("b", layer, "peano")


def test_temporal_layers(spark, store):
    layer = cell_layer(spark, random_raster(8, 8))
    days = [layer.df.withColumn("instant", F.lit(f"2024-01-{d:02d} 12:00:00").cast("timestamp_ntz"))
            for d in range(1, 9)]
    df = days[0]
    for d in days[1:]:
        df = df.unionByName(d)
    both = layer.with_df(df, temporal=True)
    for index in ("zorder", "hilbert"):
        store.write_layer(index, both, index, time_unit="months", time_resolution=2)
        got = store.read_layer(index, 0, times=["2024-01-03 00:00:00", "2024-01-05 23:00:00"])
        assert got.df.select("instant").distinct().count() == 3
        assert store.value_class(index, 0) == "SpaceTimeKey"
        assert store.in_bounds(index, 0, 1, 1, "2024-01-08 12:00:00")
        assert not store.in_bounds(index, 0, 1, 1, "2024-01-08 12:00:01")
        assert store.read_tile(index, 0, 1, 1, "2024-01-02 12:00:00").count() == 1
    with pytest.raises(ValueError):
        key_index(both.meta, "rowmajor")


@pytest.mark.parametrize("n,bits", [(2, 4), (3, 3)])
def test_hilbert_curve_visits_neighbours(spark, n, bits):
    side = 1 << bits
    axes = [F.floor(F.col("id") / side ** k) % side for k in range(n)]
    rows = spark.range(side ** n).select(*[a.alias(f"a{k}") for k, a in enumerate(axes)]).select(
        "*", curves.hilbert_index([F.col(f"a{k}") for k in range(n)], bits).alias("h")).collect()
    path = np.array([[r[k] for k in range(n)] for r in sorted(rows, key=lambda r: r["h"])])
    assert sorted(r["h"] for r in rows) == list(range(side ** n))
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_z_order(spark):
    rows = spark.range(1).select(
        curves.z_index(F.lit(5), F.lit(3)).alias("two"),
        curves.z_index(F.lit(3), F.lit(5), F.lit(6)).alias("three"),
        curves.z_index(F.lit(2 ** 31 - 1), F.lit(2 ** 31 - 1)).alias("top")).first()
    assert rows["two"] == 0b011011
    assert rows["three"] == sum(((3 >> b & 1) | (5 >> b & 1) << 1 | (6 >> b & 1) << 2) << 3 * b
                                for b in range(3))
    assert rows["top"] == 2 ** 62 - 1


def test_time_slots_do_not_depend_on_the_session_zone(spark):
    at = F.lit("1970-01-08 00:00:00").cast("timestamp_ntz")
    row = spark.range(1).select(curves.time_slot(at, "weeks").alias("w"),
                                curves.time_slot(at, "millis").alias("m"),
                                curves.time_slot(at, "years").alias("y")).first()
    assert (row["w"], row["m"], row["y"]) == (1, 7 * 86400000, 0)


def test_export_keeps_tags_apart(spark):
    layer = cell_layer(spark, random_raster(4, 4))
    row = rt.export_scenes(layer, head_tags={"a": "1"}).first()
    assert row["tags"] == {"a": "1"} and row["band_tags"] == []
    row = rt.export_scenes(layer, band_tags=[{"b": "2"}]).first()
    assert row["tags"] == {} and row["band_tags"] == [{"b": "2"}]
    assert (row["xmin"], row["ymin"], row["xmax"], row["ymax"]) == (0, -4, 4, 0)


def test_nodata_values_of_files(spark):
    a = np.array([[1.0, -9.0], [np.nan, 4.0]])
    layer = cell_layer(spark, a, tile=2, cell_type="int16ud-9")
    gone = np.array([[1.0, np.nan], [np.nan, 4.0]])
    clean = rt.without_sentinels(layer)
    np.testing.assert_array_equal(as_array(clean, 2, 2), gone)
    rows = rt.export_scenes(clean, sentinels=True)
    assert rows.first()["bands"] == [[1, -9, -9, 4]]
    folder = run_folder(spark, "scenes")
    rows.select(F.lit(7).cast("bigint").alias("scene_id"), "epsg", "xmin", "ymin", "xmax", "ymax",
                "cols", "rows", "bands").write.parquet(folder)
    back = rt.read_scenes(spark, folder, cell_type="int16ud-9")
    np.testing.assert_array_equal(as_array(rt.tile_to_layout(back, layer.meta.layout), 2, 2), gone)
    f = spark.createDataFrame([(0, 0, [[1.5, float("nan"), -1.0, None]])],
                              "col int, row int, bands array<array<double>>")
    meta = rt.Meta(rt.CellType.parse("float32ud-1"), layer.meta.layout, 3857, 1)
    assert rt.without_sentinels(rt.from_tiles(f, meta)).df.first()["bands"] == [[1.5, None, None, None]]


def test_requests_across_zooms_in_batch_and_stream(spark):
    a = random_raster(16, 16, gaps=0.0)
    base = cell_layer(spark, a)
    base = base.with_df(base.df, layout=rt.global_level(3857, 2, 4), zoom=2)
    levels = rt.pyramid(base, "Max")
    asked = [(1, 2, 1, 2), (2, 4, 5, 9), (3, 0, 0, 0), (4, 2, 9, 9)]
    requests = spark.createDataFrame(asked, "id int, zoom int, x bigint, y bigint")
    found = {r["id"]: r["bands"][0] for r in rt.read_tiles_zoomed(requests, levels).collect()}
    assert sorted(found) == [1, 2, 3]
    np.testing.assert_array_equal(np.reshape(found[1], (4, 4)), a[8:12, 4:8])
    np.testing.assert_array_equal(np.reshape(found[2], (4, 4)), np.full((4, 4), a[9, 5]))
    capped = rt.read_tiles_zoomed(requests, levels, max_zoom=2, overzoom=False)
    assert sorted(r["id"] for r in capped.collect()) == [1, 3]

    folder = run_folder(spark, "asked")
    requests.write.parquet(folder)
    stream = spark.readStream.schema(requests.schema).parquet(folder)
    colors = rt.ColorMap.from_map({20: 1, 40: 2}, 0, 3)
    seen = []
    served = serve_requests(stream, levels, lambda df, n: seen.extend(df.collect()), colors=colors)
    served.processAllAvailable()
    served.stop()
    assert sorted(r["id"] for r in seen) == [1, 2, 3]
    assert all(set(r["rgba"]) <= {1, 2} for r in seen)
    assert answer_requests(requests, levels).count() == 3


@pytest.mark.parametrize("curve,bits,axes", [("zorder", 5, 2), ("hilbert", 5, 2), ("zorder", 3, 3), ("hilbert", 3, 3)])
def test_runs_hold_their_box(curve, bits, axes):
    """Every key of the box, and with runs enough nothing else."""
    import itertools
    import random

    from rastertable.functions.curves import index_runs, position
    rng, side = random.Random(1), 1 << bits
    at = {k: position(curve, k, bits) for k in itertools.product(range(side), repeat=axes)}
    assert sorted(at.values()) == list(range(side ** axes))
    for most in (1, 8, 10_000):
        for _ in range(20):
            box = [tuple(sorted(rng.choices(range(side), k=2))) for _ in range(axes)]
            runs = index_runs(curve, box, bits, most)
            held = {k for k, p in at.items() if any(a <= p <= b for a, b in runs)}
            inside = {k for k in at if all(lo <= c <= hi for c, (lo, hi) in zip(k, box))}
            assert inside <= held and (most < 10_000 or inside == held)
    assert index_runs(curve, [(2, 1)] * axes, bits) == []


@pytest.mark.parametrize("curve", ["zorder", "hilbert"])
def test_positions_equal_the_columns(spark, curve):
    from rastertable.functions import curves
    keys = [(c * 37 % 64, c * 11 % 64) for c in range(50)]
    df = spark.createDataFrame(keys, "col int, row int")
    col = curves.z_index(F.col("col"), F.col("row")) if curve == "zorder" else curves.hilbert_index([F.col("col"), F.col("row")], 6)
    got = df.select(col).collect()
    assert [r[0] for r in got] == [curves.position(curve, k, 6 if curve == "hilbert" else 31) for k in keys]


def test_reads_push_runs_and_skip_files(spark, store):
    layer = cell_layer(spark, random_raster(64, 64, 3))
    store.write_layer("a", layer, "hilbert", num_partitions=16)
    part = store.read_layer("a", 0, envelope=rt.Extent(20.0, -30.0, 35.0, -20.0))
    plan = part.df._jdf.queryExecution().toString()
    assert "key_index" in plan[plan.index("PushedFilters"):]
    got = {(r["col"], r["row"]) for r in part.df.select("col", "row").collect()}
    assert got == {(c, r) for c in range(5, 9) for r in range(5, 8)}
    assert store.read_layer("a", 0, envelope=rt.Extent(900.0, -30.0, 935.0, -20.0)).df.count() == 0


def test_declared_time_bounds(spark, store):
    layer = cell_layer(spark, random_raster(8, 8, 3))
    days = [layer.df.withColumn("instant", F.lit(f"2024-0{m}-01 00:00:00").cast("timestamp_ntz")) for m in (1, 3, 6)]
    timed = layer.with_df(days[0].unionByName(days[1]).unionByName(days[2]), temporal=True)
    bounds = ("2024-01-01 00:00:00", "2024-06-01 00:00:00")
    store.write_layer("t", timed, "hilbert", time_bounds=bounds, time_bits=4)
    got = store.read_layer("t", 0, times=["2024-02-01 00:00:00", "2024-04-01 00:00:00"])
    assert {str(r[0]) for r in got.df.select("instant").distinct().collect()} == {"2024-03-01 00:00:00"}
    assert store.read_layer("t", 0).df.count() == 12
    assert store.read_layer("t", 0, times=["2030-01-01 00:00:00", "2031-01-01 00:00:00"]).df.count() == 0
    with pytest.raises(Exception, match="outside the declared time bounds"):
        store.write_layer("u", timed, "zorder", time_bounds=("2024-02-01 00:00:00", "2024-06-01 00:00:00"))
    with pytest.raises(ValueError, match="1 to 21 bits"):
        store.write_layer("u", timed, time_bounds=bounds[::-1])


def test_requests_read_only_what_they_ask_for(spark, store):
    layer = cell_layer(spark, random_raster(16, 16, 3))
    for level in rt.pyramid(layer, "Max", end_zoom=1):
        store.write_layer("p", level)
    levels = store.levels("p")
    asked = spark.createDataFrame([(2, 1, 1), (2, 2, 1)], "zoom int, x int, y int")
    found = rt.read_tiles_zoomed(asked, levels, max_zoom=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") - plan.count("ExistingRDD") <= 2 and "zoom=1" not in plan
    assert found.count() == 2
    assert rt.read_tiles_zoomed(asked.where("zoom > 5"), levels).count() == 0
