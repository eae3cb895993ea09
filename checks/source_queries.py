"""Queries of sources, sinks, the catalog, curve indices and tile requests."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

import rastertable as rt
from rastertable.functions import curves
from rastertable.plans.lineage import run_folder

from .cell_queries import _CENTRES, _TOUCH, cells, texted
from .fixtures import (KEYED, SCENES, TALL, fx1_cells, fx2_cells, fx3_tiles, fx5_scenes,
                       map_edges, map_points, table)
from .registry import query


def catalog(spark) -> rt.Catalog:
    return rt.Catalog(spark, run_folder(spark, "catalog"))


@query("read_scenes", "", """SELECT vec_id AS scene_id, 32631 AS epsg, CAST(DATE '2024-01-01' + label AS VARCHAR)[1:10]
    || ' 00:00:00' AS instant, CAST(list_sum(list_transform(embedding,
      lambda e: floor(CAST(e AS DOUBLE) * 1000))) AS BIGINT) AS total FROM embeddings""")
def _(spark, sf):
    folder = run_folder(spark, "scenes")
    scenes = fx5_scenes(spark, sf, temporal=True).df
    tagged = scenes.withColumn("tags", F.create_map(
        F.lit("ACQUIRED"), F.date_format("instant", "yyyy/MM/dd HH:mm"))).drop("instant")
    tagged.where("xmin < 12").write.parquet(f"{folder}/west")
    tagged.where("xmin >= 12").write.parquet(f"{folder}/east")
    layer = rt.read_scenes(spark, [f"{folder}/west", f"{folder}/east"], temporal=True,
                           crs="EPSG:32631", time_tag="ACQUIRED", time_format="yyyy/MM/dd HH:mm",
                           num_partitions=4, cell_type="int32")
    total = F.aggregate(F.flatten("bands"), F.lit(0).cast("bigint"), lambda a, v: a + v)
    return texted(layer.df.select("scene_id", "epsg", "instant", total.alias("total")))


@query("split_scenes", "fx5", """SELECT priority AS scene_id, CAST(x0 + i * 3 AS DOUBLE) AS xmin,
    CAST(-y0 - j * 3 AS DOUBLE) AS ymax, CAST(count(*) AS BIGINT) AS cells, CAST(sum(v) AS BIGINT) AS total
    FROM (SELECT priority, v, (priority * 7) % 24 AS x0, priority AS y0,
            (x - (priority * 7) % 24) // 3 AS i, (y - priority) // 3 AS j FROM fx5) q
    GROUP BY priority, x0, y0, i, j""")
def _(spark, sf):
    layer = rt.split_scenes(fx5_scenes(spark, sf), 3)
    flat = F.flatten("bands")
    total = F.aggregate(flat, F.lit(0).cast("bigint"), lambda a, v: a + v)
    return layer.df.select("scene_id", "xmin", "ymax", F.size(flat).cast("bigint").alias("cells"),
                           total.alias("total"))


@query("split_then_tile", "fx5m", "SELECT x, y, 0 AS band, v FROM fx5m")
def _(spark, sf):
    return cells(rt.tile_to_layout(rt.split_scenes(fx5_scenes(spark, sf), 3), SCENES))


@query("export_scenes", "fx3", """SELECT CAST(x // 8 AS INT) AS col, CAST(y // 8 AS INT) AS row,
    CAST((x // 8) * 8 AS DOUBLE) AS xmin, CAST(-(y // 8) * 8 - 8 AS DOUBLE) AS ymin,
    CAST((x // 8) * 8 + 8 AS DOUBLE) AS xmax, CAST(-(y // 8) * 8 AS DOUBLE) AS ymax, 3857 AS epsg,
    'survey' AS kind, CAST(sum(v) AS BIGINT) AS total FROM fx3 GROUP BY 1, 2, 3, 4, 5, 6""")
def _(spark, sf):
    path = run_folder(spark, "export")
    rows = rt.export_scenes(fx3_tiles(spark, sf), {"kind": "survey"}, path=path)
    total = F.aggregate(F.flatten("bands"), F.lit(0).cast("bigint"), lambda a, v: a + v)
    return rows.select("col", "row", "xmin", "ymin", "xmax", "ymax", "epsg",
                       F.col("tags")["kind"].alias("kind"), total.alias("total"))


# --- catalog ---------------------------------------------------------------------------------

@query("write_read_layer", "fx3", "SELECT x, y, 0 AS band, v FROM fx3")
def _(spark, sf):
    store = catalog(spark)
    store.write_layer("vectors", fx3_tiles(spark, sf), "zorder")
    return cells(store.read_layer("vectors", 0))


@query("read_layer_envelope", "fx1", """SELECT x, y, band, v FROM fx1
    WHERE x // 16 BETWEEN 1 AND 3 AND y // 16 BETWEEN 2 AND 9""")
def _(spark, sf):
    store = catalog(spark)
    store.write_layer("fx1", fx1_cells(spark, sf), "hilbert")
    return cells(store.read_layer("fx1", 0, envelope=rt.Extent(20.0, -160.0, 64.0, -40.0)))


@query("read_layer_off_layer", "fx1", """SELECT x, y, band, v FROM fx1
    WHERE x // 16 BETWEEN 1 AND 3 AND y // 16 BETWEEN 2 AND 9""")
def _(spark, sf):
    store = catalog(spark)
    store.write_layer("fx1", fx1_cells(spark, sf), "hilbert")
    hit, miss = rt.Extent(20.0, -160.0, 64.0, -40.0), rt.Extent(1e6, -160.0, 1e6 + 44.0, -40.0)
    return cells(rt.union_layers([store.read_layer("fx1", 0, envelope=at) for at in (hit, miss)]))


@query("read_layer_envelope_degrees", "fx1", """SELECT x, y, band, v FROM fx1
    WHERE x // 16 BETWEEN 1 AND 3 AND y // 16 BETWEEN 2 AND 9""")
def _(spark, sf):
    store = catalog(spark)
    store.write_layer("fx1", fx1_cells(spark, sf), "rowmajor", num_partitions=4)
    area = rt.transform_extent(rt.Extent(20.0, -159.0, 63.0, -40.0), 3857, 4326)
    return cells(store.read_layer("fx1", 0, envelope=area, query_epsg=4326))


@query("read_layer_points", "fx1 pt1", """SELECT x, y, band, v FROM fx1 WHERE (x // 16, y // 16) IN (
    SELECT (CAST(floor(x / 16) AS BIGINT), CAST(floor(y / 16) AS BIGINT)) FROM pt1
    WHERE x < 128)""")
def _(spark, sf):
    store = catalog(spark)
    store.write_layer("fx1", fx1_cells(spark, sf))
    return cells(store.read_layer("fx1", 0, points=map_points(spark, sf)))


@query("write_read_temporal", "fx2", """SELECT x, y, CAST(instant AS VARCHAR) AS instant, band, v
    FROM fx2 WHERE instant BETWEEN TIMESTAMP '2024-01-04 00:00:00' AND TIMESTAMP '2024-01-09 00:00:00'
      AND x < 16""")
def _(spark, sf):
    store = catalog(spark)
    store.write_layer("fx2", fx2_cells(spark, sf), "zorder", time_unit="hours", time_resolution=6)
    layer = store.read_layer("fx2", 0, envelope=rt.Extent(0.0, -32.0, 16.0, 0.0),
                             times=["2024-01-04 00:00:00", "2024-01-09 00:00:00"])
    return texted(cells(layer))


@query("read_tile", "fx3", """SELECT CAST((y % 8) * 8 + x % 8 AS INT) AS i, v FROM fx3
    WHERE x // 8 = 5 AND y // 8 = 2""")
def _(spark, sf):
    store = catalog(spark)
    store.write_layer("vectors", fx3_tiles(spark, sf))
    return store.read_tile("vectors", 0, 5, 2).select(
        F.posexplode(F.get("bands", F.lit(0))).alias("i", "v"))


@query("layer_bounds", "fx1", """SELECT CAST(min(x // 16) AS INT) AS col0, CAST(min(y // 16) AS INT) AS row0,
    CAST(max(x // 16) AS INT) AS col1, CAST(max(y // 16) AS INT) AS row1 FROM fx1""")
def _(spark, sf):
    store = catalog(spark)
    store.write_layer("fx1", fx1_cells(spark, sf))
    text = "struct<bounds:struct<minKey:struct<col:int,row:int>,maxKey:struct<col:int,row:int>>>"
    b = F.from_json("json", text)["bounds"]
    return store.attributes().where("attr = 'metadata'").select(
        b["minKey"]["col"].alias("col0"), b["minKey"]["row"].alias("row0"),
        b["maxKey"]["col"].alias("col1"), b["maxKey"]["row"].alias("row1"))


@query("write_read_temporal_hilbert", "fx2", """SELECT x, y, CAST(instant AS VARCHAR) AS instant, band, v
    FROM fx2 WHERE instant = TIMESTAMP '2024-01-09 07:00:00'""")
def _(spark, sf):
    store = catalog(spark)
    store.write_layer("fx2", fx2_cells(spark, sf), "hilbert", time_unit="days")
    return texted(cells(store.read_layer("fx2", 0, times=["2024-01-09 07:00:00"])))


@query("write_read_temporal_bounds", "fx2", """SELECT x, y, CAST(instant AS VARCHAR) AS instant, band, v
    FROM fx2 WHERE instant BETWEEN TIMESTAMP '2024-01-06 00:00:00' AND TIMESTAMP '2024-01-08 12:00:00' AND y >= 8""")
def _(spark, sf):
    """An index over a declared year: a span of time and an area are runs of it."""
    store = catalog(spark)
    store.write_layer("fx2", fx2_cells(spark, sf), "hilbert", time_bounds=("2024-01-01 00:00:00", "2024-12-31 23:59:59"), time_bits=12)
    layer = store.read_layer("fx2", 0, envelope=rt.Extent(0.0, -32.0, 32.0, -8.5),
                             times=["2024-01-06 00:00:00", "2024-01-08 12:00:00"])
    return texted(cells(layer))


@query("in_bounds", "pt1 fx1", """SELECT point_id, (CAST(floor(x / 16) AS INT) BETWEEN c0 AND c1)
      AND (CAST(floor(y / 16) AS INT) BETWEEN r0 AND r1) AS in_bounds
    FROM pt1, (SELECT min(x // 16) AS c0, max(x // 16) AS c1, min(y // 16) AS r0, max(y // 16) AS r1 FROM fx1 WHERE y >= 64) b""")
def _(spark, sf):
    """Keys of all points against the bounds of a layer that begins in the fifth row of tiles."""
    layer, store = fx1_cells(spark, sf), catalog(spark)
    store.write_layer("fx1", layer.with_df(layer.df.where("y >= 64")))
    points = map_points(spark, sf)
    keys = points.select("point_id", F.floor(F.col("x") / 16).cast("int").alias("col"), F.floor(-F.col("y") / 16).cast("int").alias("row"))
    return store.keys_in_bounds("fx1", 0, keys).select("point_id", "in_bounds")


@query("collect_metadata", "fx5", """SELECT CAST(min(x) AS DOUBLE) AS xmin, CAST(-max(y) - 1 AS DOUBLE) AS ymin,
      CAST(max(x) + 1 AS DOUBLE) AS xmax, CAST(-min(y) AS DOUBLE) AS ymax, 0 AS col0, 0 AS row0,
      CAST((max(x) - min(x)) // 16 AS INT) AS col1, CAST((max(y) - min(y)) // 16 AS INT) AS row1, 16 AS tile_cols
    FROM fx5""")
def _(spark, sf):
    meta = rt.collect_metadata(fx5_scenes(spark, sf), rt.LocalLayout(16))
    lo, hi, e = meta.bounds["minKey"], meta.bounds["maxKey"], meta.extent
    return spark.createDataFrame(
        [(e.xmin, e.ymin, e.xmax, e.ymax, lo["col"], lo["row"], hi["col"], hi["row"], meta.layout.tile_cols)],
        "xmin double, ymin double, xmax double, ymax double, col0 int, row0 int, col1 int, row1 int, tile_cols int")


@query("read_tiles_levels", "fx3", """SELECT a.id, a.zoom, CAST(i AS INT) AS i, l.v FROM (
      SELECT event_id AS id, CAST(17 + event_id % 4 AS INT) AS zoom, greatest(CAST(17 + event_id % 4 AS INT) - 19, 0) AS dz,
        (user_id % 16) * (1 << CAST(event_id % 4 AS INT)) // 4 AS x, (user_id // 16) * (1 << CAST(event_id % 4 AS INT)) // 4 AS y,
        unnest(range(0, 64)) AS i FROM events) a
    JOIN (SELECT 19 AS zoom, x, y, v FROM fx3 UNION ALL SELECT 18, x // 2, y // 2, max(v) FROM fx3 GROUP BY 1, 2, 3
      UNION ALL SELECT 17, x // 4, y // 4, max(v) FROM fx3 GROUP BY 1, 2, 3) l
      ON l.zoom = least(a.zoom, 19) AND l.x = ((a.x * 8 + i % 8) >> dz) AND l.y = ((a.y * 8 + i // 8) >> dz)""")
def _(spark, sf):
    """A request per event over three stored levels, a quarter of them beyond the deepest."""
    store, layer = catalog(spark), fx3_tiles(spark, sf)
    world = rt.global_level(3857, 19, 8)
    for level in rt.pyramid(layer.with_df(layer.df, layout=world, zoom=19), "Max", end_zoom=17):
        store.write_layer("vectors", level)
    side = F.call_function("shiftleft", F.lit(1), (F.col("event_id") % 4).cast("int"))
    asked = table(spark, sf, "events").select(
        F.col("event_id").alias("id"), (17 + F.col("event_id") % 4).cast("int").alias("zoom"),
        F.floor((F.col("user_id") % 16) * side / 4).alias("x"), F.floor(F.floor(F.col("user_id") / 16) * side / 4).alias("y"))
    found = rt.read_tiles_zoomed(asked, store.levels("vectors"))
    cells_ = found.select("id", "zoom", F.posexplode(F.get("bands", F.lit(0))).alias("i", "v"))
    return cells_.where(F.col("v").isNotNull())


@query("read_layer_polygons", "geo fx1", """SELECT f.x, f.y, f.band, f.v FROM fx1 f
    WHERE EXISTS (SELECT 1 FROM touched t WHERE t.col = f.x // 16 AND t.row = f.y // 16)""",
       tile_centres=_CENTRES, touched=_TOUCH)
def _(spark, sf):
    store = catalog(spark)
    store.write_layer("fx1", fx1_cells(spark, sf))
    return cells(store.read_layer("fx1", 0, polygons=map_edges(spark, sf)))


@query("catalog_levels", "fx3", """SELECT CAST(zoom AS INT) AS zoom, count(*) AS tiles FROM (
    SELECT DISTINCT 19 AS zoom, x // 8 AS c, y // 8 AS r FROM fx3
    UNION ALL SELECT DISTINCT 18, x // 16, y // 16 FROM fx3
    UNION ALL SELECT DISTINCT 17, x // 32, y // 32 FROM fx3) t GROUP BY 1""")
def _(spark, sf):
    store = catalog(spark)
    layer = fx3_tiles(spark, sf)
    world = rt.global_level(3857, 19, 8)
    for level in rt.pyramid(layer.with_df(layer.df, layout=world, zoom=19), "Max", end_zoom=17):
        store.write_layer("vectors", level)
    asked = [t.df.select(F.lit(t.zoom).alias("zoom"), F.col("col").alias("x"), F.col("row").alias("y"))
             for t in store.levels("vectors")]
    requests = asked[0].union(asked[1]).union(asked[2])
    found = rt.read_tiles_zoomed(requests, store.levels("vectors"))
    return found.groupBy("zoom").agg(F.count(F.lit(1)).alias("tiles"))


# --- curves ----------------------------------------------------------------------------------

_KEYS = "SELECT DISTINCT CAST(x // 16 AS INT) AS col, CAST(y // 16 AS INT) AS row FROM fx1"


@query("z_index", "fx1", """SELECT col, row, CAST(list_sum(list_transform(range(0, 20),
    lambda b: ((col >> b) & 1) * pow(4, b) + ((row >> b) & 1) * 2 * pow(4, b))) AS BIGINT) AS z FROM k""",
       k="SELECT DISTINCT x // 16 AS col, y // 16 AS row FROM fx1")
def _(spark, sf):
    k = rt.to_tiles(fx1_cells(spark, sf)).df
    return k.select(F.col("col").cast("bigint").alias("col"), F.col("row").cast("bigint").alias("row"),
                    curves.z_index(F.col("col"), F.col("row")).alias("z"))


@query("z_index_time", "fx2", """SELECT col, row, CAST(instant AS VARCHAR) AS instant,
    CAST(list_sum(list_transform(range(0, 20), lambda b: ((col >> b) & 1) * pow(8, b)
      + ((row >> b) & 1) * 2 * pow(8, b) + ((slot >> b) & 1) * 4 * pow(8, b))) AS BIGINT) AS z FROM k""",
       k="""SELECT DISTINCT x // 8 AS col, y // 8 AS row, instant,
            CAST(floor(epoch(instant) / 21600) AS BIGINT) AS slot FROM fx2""")
def _(spark, sf):
    k = rt.to_tiles(fx2_cells(spark, sf)).df
    slot = curves.time_slot(F.col("instant"), "hours", 6)
    return texted(k.select(F.col("col").cast("bigint").alias("col"),
                           F.col("row").cast("bigint").alias("row"), "instant",
                           curves.z_index(F.col("col"), F.col("row"), slot).alias("z")))


@query("time_slots", "", """SELECT event_id, CAST(floor(epoch(ts) / 900) AS BIGINT) AS quarter_hours,
    CAST(floor(epoch(ts) / 604800) AS BIGINT) AS weeks,
    CAST(floor(((year(ts) - 1970) * 12 + month(ts) - 1) / 3) AS BIGINT) AS quarters,
    CAST(year(ts) - 1970 AS BIGINT) AS years FROM events""")
def _(spark, sf):
    at = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", curves.time_slot(at, "minutes", 15).alias("quarter_hours"),
        curves.time_slot(at, "weeks").alias("weeks"),
        curves.time_slot(at, "months", 3).alias("quarters"),
        curves.time_slot(at, "years").alias("years"))


# the classic bit-by-bit walk: quadrant, then rotate
@query("hilbert_index", "fx1", """SELECT col, row, h FROM walk WHERE s = 0""",
       walk=f"""WITH RECURSIVE w AS (
        SELECT col, row, CAST(col AS BIGINT) AS x, CAST(row AS BIGINT) AS y, CAST(131072 AS BIGINT) AS s,
               CAST(0 AS BIGINT) AS h FROM ({_KEYS}) k
        UNION ALL
        SELECT col, row,
          CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN s - 1 - (y & (s - 1)) ELSE y & (s - 1) END
               ELSE x & (s - 1) END,
          CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN s - 1 - (x & (s - 1)) ELSE x & (s - 1) END
               ELSE y & (s - 1) END,
          s // 2, h + s * s * xor(3 * rx, ry)
        FROM (SELECT *, CASE WHEN (x & s) > 0 THEN 1 ELSE 0 END AS rx,
                     CASE WHEN (y & s) > 0 THEN 1 ELSE 0 END AS ry FROM w WHERE s > 0) v)
        SELECT * FROM w""")
def _(spark, sf):
    k = rt.to_tiles(fx1_cells(spark, sf)).df
    return k.select("col", "row", curves.hilbert_index([F.col("col"), F.col("row")], 18).alias("h"))


@query("rowmajor_index", "fx1", f"SELECT col, row, CAST(row * 8 + col AS BIGINT) AS i FROM ({_KEYS}) k")
def _(spark, sf):
    k = rt.to_tiles(fx1_cells(spark, sf)).df
    return k.select("col", "row", curves.rowmajor_index(F.col("col"), F.col("row"), 8).alias("i"))


# --- requests --------------------------------------------------------------------------------

# a request per customer: zoom 19 is the layer's own, above it tiles are enlarged
_ASKED = """SELECT c_custkey AS id, 19 + c_custkey % 4 AS zoom,
    CAST((c_custkey * 5) % 16 * pow(2, c_custkey % 4) + c_custkey % 3 * (c_custkey % 4 > 1)::INT AS BIGINT) AS x,
    CAST(floor(c_custkey / 40) * pow(2, c_custkey % 4) + (c_custkey % 4 > 0)::INT AS BIGINT) AS y FROM customer"""


def requests(spark, sf):
    k = F.col("c_custkey")
    zoomed = F.pow(F.lit(2.0), k % 4)
    return table(spark, sf, "customer").select(
        k.alias("id"), (k % 4 + 19).cast("int").alias("zoom"),
        ((k * 5) % 16 * zoomed + F.when(k % 4 > 1, k % 3).otherwise(0)).cast("bigint").alias("x"),
        (F.floor(k / 40) * zoomed + F.when(k % 4 > 0, 1).otherwise(0)).cast("bigint").alias("y"))


@query("read_tiles_zoomed", "fx3", """SELECT a.id, CAST(i AS INT) AS i, f.v FROM (
      SELECT *, zoom - 19 AS dz, unnest(range(0, 64)) AS i FROM asked) a
    JOIN fx3 f ON f.x = ((a.x * 8 + i % 8) >> dz) AND f.y = ((a.y * 8 + i // 8) >> dz)""", asked=_ASKED)
def _(spark, sf):
    level = fx3_tiles(spark, sf)
    found = rt.read_tiles_zoomed(requests(spark, sf), [level.with_df(level.df, zoom=19)])
    return found.select("id", F.posexplode(F.get("bands", F.lit(0))).alias("i", "v"))


@query("read_tiles_without_overzoom", "fx3", """SELECT a.id, f.v AS first_cell FROM asked a
    JOIN fx3 f ON f.x = a.x * 8 AND f.y = a.y * 8 WHERE a.zoom = 19""", asked=_ASKED)
def _(spark, sf):
    level = fx3_tiles(spark, sf)
    found = rt.read_tiles_zoomed(requests(spark, sf), [level.with_df(level.df, zoom=19)],
                                 overzoom=False)
    return found.select("id", F.get(F.get("bands", F.lit(0)), F.lit(0)).alias("first_cell"))
