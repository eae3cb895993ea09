"""Queries of the cell-wise operations, shapes, filters and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

import rastertable as rt

from .fixtures import (TALL, fx1_cells, fx2_cells, fx3_labels, fx3_tiles, fx5_scenes,
                       map_edges, map_points, table)
from .registry import query

FX1_SELECT = "SELECT x, y, band, {} AS v FROM fx1"
CELLS3 = "SELECT x, y, 0 AS band, {} AS v FROM fx3"


def cells(layer: rt.Layer):
    return rt.to_cells(layer).df


def rounded(df, *names: str, digits: int = 6):
    return df.withColumns({n: F.round(n, digits) for n in names or ("v",)})


# --- shapes ----------------------------------------------------------------------------------

@query("to_tiles_to_cells", "fx1", "SELECT x, y, band, v FROM fx1")
def _(spark, sf):
    return cells(rt.to_tiles(fx1_cells(spark, sf)))


@query("to_cells", "fx3", CELLS3.format("v"))
def _(spark, sf):
    return cells(fx3_tiles(spark, sf))


@query("to_tiles", "fx1", """SELECT CAST(x // 16 AS INT) AS col, CAST(y // 16 AS INT) AS row,
    512 AS cells, CAST(count(*) AS BIGINT) AS data, CAST(sum(v) AS BIGINT) AS total
    FROM fx1 GROUP BY 1, 2""")
def _(spark, sf):
    flat = F.flatten("bands")
    data = F.filter(flat, lambda v: v.isNotNull())
    total = F.aggregate(data, F.lit(0).cast("bigint"), lambda a, v: a + v)
    return rt.to_tiles(fx1_cells(spark, sf)).df.select(
        "col", "row", F.size(flat).alias("cells"), F.size(data).cast("bigint").alias("data"),
        total.alias("total"))


@query("grid", "grid", """SELECT g.x, g.y, b.band, f.v FROM grid g
    CROSS JOIN (SELECT 0 AS band UNION ALL SELECT 1) b
    LEFT JOIN fx1 f ON f.x = g.x AND f.y = g.y AND f.band = b.band""")
def _(spark, sf):
    return rt.grid(fx1_cells(spark, sf))


@query("keys", "fx1", "SELECT DISTINCT CAST(x // 16 AS INT) AS col, CAST(y // 16 AS INT) AS row FROM fx1")
def _(spark, sf):
    return rt.keys(rt.to_tiles(fx1_cells(spark, sf)))


@query("scene_keys", "", """SELECT 3857 AS epsg, CAST((vec_id * 7) % 24 AS DOUBLE) AS xmin,
    CAST(-vec_id - 8 AS DOUBLE) AS ymin, CAST((vec_id * 7) % 24 + 8 AS DOUBLE) AS xmax,
    CAST(-vec_id AS DOUBLE) AS ymax FROM embeddings""")
def _(spark, sf):
    return rt.keys(fx5_scenes(spark, sf))


# --- constants -------------------------------------------------------------------------------

_INTEGER_OPS = {
    "local_add": (lambda t: rt.local_add(t, 7), "v + 7"),
    "local_subtract": (lambda t: rt.local_subtract(t, 50), "v - 50"),
    "r_local_subtract": (lambda t: rt.r_local_subtract(t, 50), "50 - v"),
    "local_multiply": (lambda t: rt.local_multiply(t, 3), "v * 3"),
    "local_divide": (lambda t: rt.local_divide(t, 7), "v // 7"),
    "r_local_divide": (lambda t: rt.r_local_divide(t, 1000), "1000 // nullif(v, 0)"),
    "local_pow": (lambda t: rt.local_pow(t, 2), "v * v"),
    "local_abs": (lambda t: rt.local_abs(rt.local_subtract(t, 100)), "abs(v - 100)"),
    "local_chain": (lambda t: abs((((t + 7) * 3) - 200) / 4) + 1,
                    "abs(CAST(trunc(((v + 7) * 3 - 200) / 4) AS BIGINT)) + 1"),
}
for _name, (_op, _sql) in _INTEGER_OPS.items():
    for _shape, _make, _parts, _form in (
            ("", fx3_tiles, "fx3", CELLS3), ("_cells", fx1_cells, "fx1", FX1_SELECT)):
        # truncating division of possibly negative values
        _text = _sql.replace("v // 7", "CAST(trunc(v / 7) AS BIGINT)").replace(
            "1000 // nullif(v, 0)", "CAST(trunc(1000 / nullif(v, 0)) AS BIGINT)")
        _body = f"SELECT * FROM ({_form.format(_text)}) q WHERE v IS NOT NULL"

        @query(_name + _shape, _parts, _body)
        def _(spark, sf, op=_op, make=_make):
            return cells(op(make(spark, sf)))


@query("local_add_double", "fx3", CELLS3.format("v + CAST(0.5 AS DOUBLE)"))
def _(spark, sf):
    return cells(rt.local_add(fx3_tiles(spark, sf), 0.5))


@query("local_divide_double", "fx3", CELLS3.format("round(v / 8.0, 6)"))
def _(spark, sf):
    return rounded(cells(rt.local_divide(fx3_tiles(spark, sf), 8.0)))


@query("r_local_pow", "fx1", FX1_SELECT.format("round(pow(1.01, v), 6)"))
def _(spark, sf):
    return rounded(cells(rt.r_local_pow(fx1_cells(spark, sf), 1.01)))


@query("normalize", "fx1", FX1_SELECT.format("round(10.0 + (v - 1.0) * 90.0 / 199.0, 6)"))
def _(spark, sf):
    return rounded(cells(rt.normalize(fx1_cells(spark, sf), 1, 200, 10, 100)))


@query("convert_uint8", "fx3", CELLS3.format("((v % 256) + 256) % 256"))
def _(spark, sf):
    return cells(rt.convert(fx3_tiles(spark, sf), "uint8"))


@query("convert_int8", "fx3", CELLS3.format("(((v + 128) % 256) + 256) % 256 - 128"))
def _(spark, sf):
    return cells(rt.convert(fx3_tiles(spark, sf), "int8"))


@query("convert_from_double", "fx3", CELLS3.format("CAST(trunc(v / 8.0) AS BIGINT)"))
def _(spark, sf):
    return cells(rt.convert(rt.local_divide(fx3_tiles(spark, sf), 8.0), "int32"))


# --- classes and colours ---------------------------------------------------------------------

_BREAKS = {10: 1, 25: 2, 50: 3, 100: 4}
_CLASS_SQL = {
    "LessThan": "CASE WHEN v < 10 THEN 1 WHEN v < 25 THEN 2 WHEN v < 50 THEN 3 WHEN v < 100 THEN 4 END",
    "LessThanOrEqualTo": "CASE WHEN v <= 10 THEN 1 WHEN v <= 25 THEN 2 WHEN v <= 50 THEN 3 WHEN v <= 100 THEN 4 END",
    "GreaterThan": "CASE WHEN v > 100 THEN 4 WHEN v > 50 THEN 3 WHEN v > 25 THEN 2 WHEN v > 10 THEN 1 END",
    "GreaterThanOrEqualTo": "CASE WHEN v >= 100 THEN 4 WHEN v >= 50 THEN 3 WHEN v >= 25 THEN 2 WHEN v >= 10 THEN 1 END",
    "Exact": "CASE v WHEN 10 THEN 1 WHEN 25 THEN 2 WHEN 50 THEN 3 WHEN 100 THEN 4 END",
}
for _boundary, _case in _CLASS_SQL.items():
    @query(f"reclassify_{_boundary}", "fx1",
           f"SELECT * FROM ({FX1_SELECT.format(f'CAST({_case} AS BIGINT)')}) q WHERE v IS NOT NULL")
    def _(spark, sf, boundary=_boundary):
        return cells(rt.reclassify(fx1_cells(spark, sf), _BREAKS, boundary))


@query("reclassify_many_breaks", "fx3", "SELECT * FROM (" + CELLS3.format(
    "CASE WHEN v < -300 THEN 0 WHEN v < 300 THEN CAST(floor((v + 300) / 2.0) + 1 AS BIGINT) END") + ") q WHERE v IS NOT NULL")
def _(spark, sf):
    """301 breaks; values below the first are class 0, values from the last on have none."""
    breaks = {-300 + 2 * i: i for i in range(0, 301)}
    return cells(rt.reclassify(fx3_tiles(spark, sf), breaks, "LessThan"))


@query("reclassify_double", "fx1", f"""SELECT * FROM ({FX1_SELECT.format(
    "CASE WHEN v <= 10.5 THEN CAST(0.25 AS DOUBLE) WHEN v <= 60.5 THEN CAST(0.75 AS DOUBLE) END")}) q
    WHERE v IS NOT NULL""")
def _(spark, sf):
    return cells(rt.reclassify(fx1_cells(spark, sf), {10.5: 0.25, 60.5: 0.75}, double=True))


@query("reclassify_replace_nodata", "grid", """SELECT g.x, g.y, b.band,
    CAST(CASE WHEN f.v IS NULL THEN -1 WHEN f.v <= 10 THEN 1 WHEN f.v <= 50 THEN 2 END AS BIGINT) AS v
    FROM grid g CROSS JOIN (SELECT 0 AS band UNION ALL SELECT 1) b
    LEFT JOIN fx1 f ON f.x = g.x AND f.y = g.y AND f.band = b.band
    WHERE f.v IS NULL OR f.v <= 50""")
def _(spark, sf):
    return cells(rt.reclassify(fx1_cells(spark, sf), {10: 1, 50: 2}, replace_nodata_with=-1))


_COLORS = rt.ColorMap.from_breaks([10, 40, 90], [0xFF0000FF, 0x00FF00FF, 0x0000FFFF],
                                  no_data_color=0x00000000, fallback_color=0x000000FF)
_COLOR_SQL = """CAST(CASE WHEN f.v IS NULL THEN 0 WHEN f.v <= 10 THEN 4278190335
    WHEN f.v <= 40 THEN 16711935 WHEN f.v <= 90 THEN 65535 ELSE 255 END AS BIGINT)"""


@query("color_map", "grid", f"""SELECT g.x, g.y, b.band, {_COLOR_SQL} AS v
    FROM grid g CROSS JOIN (SELECT 0 AS band UNION ALL SELECT 1) b
    LEFT JOIN fx1 f ON f.x = g.x AND f.y = g.y AND f.band = b.band""")
def _(spark, sf):
    return cells(rt.color_map(fx1_cells(spark, sf), _COLORS))


@query("render_rgba", "grid fx1b0", f"""SELECT CAST(g.x // 16 AS INT) AS col, CAST(g.y // 16 AS INT) AS row,
    CAST((g.y % 16) * 16 + g.x % 16 AS INT) AS i, {_COLOR_SQL} AS rgba
    FROM grid g LEFT JOIN fx1b0 f ON f.x = g.x AND f.y = g.y""")
def _(spark, sf):
    return rt.render_rgba(fx1_cells(spark, sf), _COLORS).select(
        "col", "row", F.posexplode("rgba").alias("i", "rgba"))


@query("color_map_from_quantiles", "fx3 ", """SELECT x, y, 0 AS band, CAST(CASE
    WHEN v <= (SELECT quantile_disc(v, 0.25) FROM fx3) THEN 11
    WHEN v <= (SELECT quantile_disc(v, 0.5) FROM fx3) THEN 22
    WHEN v <= (SELECT quantile_disc(v, 0.75) FROM fx3) THEN 33 ELSE 44 END AS BIGINT) AS v FROM fx3""")
def _(spark, sf):
    layer = fx3_tiles(spark, sf)
    colors = rt.color_map_from_quantiles(layer, [11, 22, 33, 44], exact=True)
    return cells(rt.color_map(layer, colors))


@query("color_map_from_histogram", "fx3 ", """SELECT x, y, 0 AS band, CAST(CASE
    WHEN v <= (SELECT quantile_disc(v, 0.5) FROM fx3) THEN 5 ELSE 6 END AS BIGINT) AS v FROM fx3""")
def _(spark, sf):
    layer = fx3_tiles(spark, sf)
    colors = rt.color_map_from_histogram(rt.histogram_exact(layer), [5, 6])
    return cells(rt.color_map(layer, colors))


# --- pairs and sets --------------------------------------------------------------------------

_PAIRS = {
    "local_add_layer": (rt.local_add, "a.v + b.label"),
    "local_subtract_layer": (rt.local_subtract, "a.v - b.label"),
    "local_multiply_layer": (rt.local_multiply, "a.v * b.label"),
    "local_divide_layer": (rt.local_divide, "CAST(trunc(a.v / nullif(b.label, 0)) AS BIGINT)"),
    "local_pow_layer": (rt.local_pow, "round(pow(CAST(a.v AS DOUBLE), b.label % 3), 6)"),
}
for _name, (_op, _sql) in _PAIRS.items():
    @query(_name, "fx3", f"""SELECT * FROM (SELECT a.x, a.y, 0 AS band, {_sql} AS v
        FROM fx3 a JOIN fx3 b ON a.x = b.x AND a.y = b.y) q WHERE v IS NOT NULL""")
    def _(spark, sf, op=_op, name=_name):
        other = fx3_labels(spark, sf)
        if name == "local_pow_layer":
            other = other.map_cells(lambda v: v % 3)
        out = cells(op(fx3_tiles(spark, sf), other))
        return rounded(out) if name == "local_pow_layer" else out


@query("local_add_layer_cells", "fx1", "SELECT x, y, band, v + v * 2 AS v FROM fx1 WHERE v > 20")
def _(spark, sf):
    layer = fx1_cells(spark, sf)
    high = rt.local_multiply(layer.with_df(layer.df.where("v > 20")), 2)
    return cells(rt.local_add(layer, high))


@query("local_add_all", "fx1", """SELECT x, y, band, CAST(sum(v) AS BIGINT) AS v FROM (
      SELECT x, y, band, v, 1 AS n FROM fx1
      UNION ALL SELECT x, y, band, v * 10, 1 FROM fx1 WHERE v > 20) u
    JOIN (SELECT tx, ty, count(*) AS present FROM (
        SELECT DISTINCT x // 16 AS tx, y // 16 AS ty, 0 AS l FROM fx1
        UNION ALL SELECT DISTINCT x // 16, y // 16, 1 FROM fx1 WHERE v > 20) t GROUP BY 1, 2) p
      ON p.tx = u.x // 16 AND p.ty = u.y // 16
    GROUP BY x, y, band HAVING sum(n) = max(present)""")
def _(spark, sf):
    layer = fx1_cells(spark, sf)
    high = rt.local_multiply(layer.with_df(layer.df.where("v > 20")), 10)
    return cells(rt.local_add(layer, [high]))


@query("combine_bands", "fx1", """SELECT x, y, band, v FROM fx1 UNION ALL
    SELECT x, y, band + 2, v * 10 FROM fx1 WHERE y >= 64""")
def _(spark, sf):
    layer = fx1_cells(spark, sf)
    south = rt.local_multiply(layer.with_df(layer.df.where("y >= 64")), 10)
    return cells(rt.combine_bands([layer, south]))


@query("combine_bands_scenes", "fx5", """SELECT priority AS scene_id, 2 AS bands,
    CAST(sum(v) AS BIGINT) AS first, CAST(sum(v + 1) AS BIGINT) AS second FROM fx5 GROUP BY 1""")
def _(spark, sf):
    layer = fx5_scenes(spark, sf)
    other = (layer + 1).with_df((layer + 1).df.withColumn("scene_id", F.col("scene_id") + 100000))
    both = rt.combine_bands([layer, other]).df
    total = lambda i: F.aggregate(F.get("bands", F.lit(i)), F.lit(0).cast("bigint"), lambda a, v: a + v)
    return both.select("scene_id", F.size("bands").alias("bands"), total(0).alias("first"),
                       total(1).alias("second"))


@query("union_scenes", "fx5", "SELECT v FROM fx5 UNION ALL SELECT v * 2 FROM fx5")
def _(spark, sf):
    layer = fx5_scenes(spark, sf)
    return rt.union_layers([layer, layer * 2]).df.select(F.explode(F.flatten("bands")).alias("v"))


@query("to_spatial_scenes", "", """SELECT vec_id AS scene_id FROM embeddings WHERE label = 3""")
def _(spark, sf):
    layer = rt.to_spatial(fx5_scenes(spark, sf, temporal=True), "2024-01-04 00:00:00")
    return layer.df.select("scene_id")


@query("composite", "fx1", """SELECT a.x, a.y, a.band, a.v FROM fx1 a WHERE a.v > 20
      AND EXISTS (SELECT 1 FROM fx1 t WHERE t.v > 20 AND t.x // 16 = a.x // 16 AND t.y // 16 = a.y // 16)
    UNION ALL SELECT a.x, a.y, a.band, -a.v FROM fx1 a WHERE a.v <= 20
      AND EXISTS (SELECT 1 FROM (SELECT DISTINCT x // 16 AS tx, y // 16 AS ty FROM fx1 WHERE v > 20) t
                  WHERE t.tx = a.x // 16 AND t.ty = a.y // 16)""")
def _(spark, sf):
    layer = fx1_cells(spark, sf)
    high = layer.with_df(layer.df.where("v > 20"))
    return cells(rt.composite([high, 0 - layer]))


@query("union_layers", "fx1", """SELECT x, y, band, v FROM fx1 UNION ALL
    SELECT x, y, band, v + 1 FROM fx1""")
def _(spark, sf):
    layer = rt.to_tiles(fx1_cells(spark, sf))
    return cells(rt.union_layers([layer, layer + 1]))


@query("select_bands", "fx1", """SELECT x, y, 0 AS band, v FROM fx1 WHERE band = 1
    UNION ALL SELECT x, y, 1, v FROM fx1 WHERE band = 0
    UNION ALL SELECT x, y, 2, v FROM fx1 WHERE band = 1""")
def _(spark, sf):
    return cells(rt.select_bands(rt.to_tiles(fx1_cells(spark, sf)), [1, 0, 1]))


@query("select_bands_cells", "fx1", """SELECT x, y, 0 AS band, v FROM fx1 WHERE band = 1
    UNION ALL SELECT x, y, 1, v FROM fx1 WHERE band = 1""")
def _(spark, sf):
    return cells(rt.select_bands(fx1_cells(spark, sf), [1, 1]))


# --- filters ---------------------------------------------------------------------------------

_TIMES = ["2024-01-03 05:00:00", "2024-01-05 17:00:00", "2024-01-20 00:00:00",
          "2024-01-22 12:00:00", "2024-01-25 01:00:00"]
_TIME_SQL = """(instant BETWEEN TIMESTAMP '2024-01-03 05:00:00' AND TIMESTAMP '2024-01-05 17:00:00'
    OR instant BETWEEN TIMESTAMP '2024-01-20 00:00:00' AND TIMESTAMP '2024-01-22 12:00:00'
    OR instant = TIMESTAMP '2024-01-25 01:00:00')"""


def texted(df):
    """Instants as text, which reads the same in every engine and time zone."""
    return df.withColumn("instant", F.col("instant").cast("string"))


@query("filter_by_times", "fx2", f"""SELECT x, y, CAST(instant AS VARCHAR) AS instant, band, v
    FROM fx2 WHERE {_TIME_SQL}""")
def _(spark, sf):
    layer = rt.to_tiles(fx2_cells(spark, sf))
    return texted(cells(rt.filter_by_times(layer, _TIMES)))


@query("filter_scenes_by_times", "", """SELECT vec_id AS scene_id FROM embeddings
    WHERE label BETWEEN 2 AND 4 OR label = 7""")
def _(spark, sf):
    layer = fx5_scenes(spark, sf, temporal=True)
    days = ["2024-01-03 00:00:00", "2024-01-05 00:00:00", "2024-01-08 00:00:00"]
    return rt.filter_by_times(layer, days).df.select("scene_id")


@query("to_spatial_at", "fx2", """SELECT x, y, band, v FROM fx2
    WHERE instant = TIMESTAMP '2024-01-05 17:00:00'""")
def _(spark, sf):
    layer = rt.to_tiles(fx2_cells(spark, sf))
    return cells(rt.to_spatial(layer, "2024-01-05 17:00:00"))


@query("to_spatial", "fx2", "SELECT x, y, band, v FROM fx2")
def _(spark, sf):
    return cells(rt.to_spatial(rt.to_tiles(fx2_cells(spark, sf))))


@query("lookup", "fx3", "SELECT i, v FROM (SELECT CAST((y % 8) * 8 + x % 8 AS INT) AS i, v FROM fx3 "
       "WHERE x // 8 = 7 AND y // 8 = 3) q")
def _(spark, sf):
    return rt.lookup(fx3_tiles(spark, sf), 7, 3).select(
        F.posexplode(F.get("bands", F.lit(0))).alias("i", "v"))


@query("lookup_many", "fx3", """SELECT CAST(x // 8 AS INT) AS col, CAST(y // 8 AS INT) AS row,
    CAST(sum(v) AS BIGINT) AS total FROM fx3
    WHERE (x // 8, y // 8) IN (SELECT (n_nationkey % 16, s_suppkey % 40) FROM nation
                               JOIN supplier ON s_nationkey = n_nationkey) GROUP BY 1, 2""")
def _(spark, sf):
    nation, supplier = table(spark, sf, "nation"), table(spark, sf, "supplier")
    wanted = nation.join(supplier, F.col("s_nationkey") == F.col("n_nationkey")).select(
        (F.col("n_nationkey") % 16).alias("col"), (F.col("s_suppkey") % 40).alias("row"))
    return rt.lookup_many(fx3_tiles(spark, sf), wanted).select("col", "row", F.aggregate(
        F.get("bands", F.lit(0)), F.lit(0).cast("bigint"), lambda a, v: a + v).alias("total"))


@query("filter_by_geometry_points", "fx1 pt1", """SELECT DISTINCT CAST(f.x // 16 AS INT) AS col,
    CAST(f.y // 16 AS INT) AS row FROM fx1 f WHERE (f.x // 16, f.y // 16) IN (
      SELECT (CAST(floor(x / 16) AS BIGINT), CAST(floor(y / 16) AS BIGINT)) FROM pt1
      WHERE x < 128)""")
def _(spark, sf):
    layer = rt.to_tiles(fx1_cells(spark, sf))
    return rt.keys(rt.filter_by_geometry(layer, points=map_points(spark, sf)))


# a tile is touched when a border crosses its open box, or its centre is inside
_TOUCH = """SELECT DISTINCT geom_id, CAST(tx AS INT) AS col, CAST(ty AS INT) AS row FROM (
    SELECT geom_id, x // 16 AS tx, y // 16 AS ty FROM inside_all WHERE x % 16 = 8 AND y % 16 = 8
      AND FALSE
    UNION ALL
    SELECT geom_id, tx, ty FROM tile_centres
    UNION ALL
    SELECT geom_id, unnest(range(CAST(floor(a) AS BIGINT),
        CAST(greatest(ceil(b), floor(a) + 1) AS BIGINT))) AS tx, ty FROM (
      SELECT geom_id, ty, least(xa, xb) AS a, greatest(xa, xb) AS b FROM (
        SELECT geom_id, ty,
          CASE WHEN y0 = y1 THEN x0 ELSE x0 + (least(greatest(ty, least(y0, y1)), greatest(y0, y1)) - y0)
               * (x1 - x0) / (y1 - y0) END AS xa,
          CASE WHEN y0 = y1 THEN x1 ELSE x0 + (least(greatest(ty + 1, least(y0, y1)), greatest(y0, y1)) - y0)
               * (x1 - x0) / (y1 - y0) END AS xb
        FROM (SELECT geom_id, x0 / 16 AS x0, y0 / 16 AS y0, x1 / 16 AS x1, y1 / 16 AS y1,
                unnest(range(CAST(floor(least(y0, y1) / 16) AS BIGINT),
                  CAST(greatest(ceil(greatest(y0, y1) / 16), floor(least(y0, y1) / 16) + 1) AS BIGINT))) AS ty
              FROM geo) e) s) t) u
    WHERE tx BETWEEN 0 AND 7"""
_CENTRES = """SELECT e.geom_id, c.tx, e.ty FROM (
      SELECT geom_id, x0 / 16 AS x0, y0 / 16 AS y0, x1 / 16 AS x1, y1 / 16 AS y1,
        unnest(range(CAST(floor(least(y0, y1) / 16) AS BIGINT),
                     CAST(ceil(greatest(y0, y1) / 16) AS BIGINT))) AS ty FROM geo) e,
      (SELECT unnest(range(0, 8)) AS tx) c
    WHERE e.ty + 0.5 >= least(e.y0, e.y1) AND e.ty + 0.5 < greatest(e.y0, e.y1)
      AND e.x0 + (e.ty + 0.5 - e.y0) * (e.x1 - e.x0) / (e.y1 - e.y0) <= c.tx + 0.5
    GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1"""
_TOUCH = _TOUCH.replace("""SELECT geom_id, x // 16 AS tx, y // 16 AS ty FROM inside_all WHERE x % 16 = 8 AND y % 16 = 8
      AND FALSE
    UNION ALL
    """, "")


@query("tiles_for_geometry", "geo", _TOUCH, tile_centres=_CENTRES)
def _(spark, sf):
    return rt.tiles_for_geometry(map_edges(spark, sf), TALL)


@query("filter_by_geometry", "geo fx1", """SELECT DISTINCT CAST(x // 16 AS INT) AS col,
    CAST(y // 16 AS INT) AS row FROM fx1 WHERE (x // 16, y // 16) IN (
      SELECT (col, row) FROM touched)""", tile_centres=_CENTRES, touched=_TOUCH)
def _(spark, sf):
    layer = rt.to_tiles(fx1_cells(spark, sf))
    return rt.keys(rt.filter_by_geometry(layer, edges=map_edges(spark, sf)))
