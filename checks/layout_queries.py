"""Queries of layouts: resampling, retiling, pyramids, reprojection, rasterizing, distances."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

import rastertable as rt
from rastertable.functions import projection

from .cell_queries import cells, rounded, texted
from .fixtures import (KEYED, SCENES, SMALL, TALL, fx1_cells, fx2_cells, fx3_tiles,
                       fx5_scenes, map_edges, map_points, table)
from .registry import query

HALF = replace(TALL, layout_cols=4, layout_rows=1 << 17)
# the same extent cut into 96 instead of 128 columns, and as many fewer rows
ODD = replace(TALL, tile_cols=12, tile_rows=12)
DOUBLE = replace(TALL, tile_cols=32, tile_rows=32)


# --- the ten methods -------------------------------------------------------------------------

_BLOCK = "CAST(floor(x / 2) AS BIGINT) AS x, CAST(floor(y / 2) AS BIGINT) AS y"
_BLOCKS = {
    "Average": "round(avg(v), 6)", "Median": "round(median(v), 6)", "Max": "max(v)", "Min": "min(v)",
}
for _method, _sql in _BLOCKS.items():
    @query(f"resample_{_method}", "fx1", f"""SELECT x, y, band, {_sql} AS v
        FROM (SELECT {_BLOCK}, band, v FROM fx1) q GROUP BY 1, 2, 3""")
    def _(spark, sf, method=_method):
        out = cells(rt.resample(fx1_cells(spark, sf), HALF, method))
        return rounded(out) if method in ("Average", "Median") else out


@query("resample_Mode", "fx1", f"""SELECT x, y, band, v FROM (SELECT x, y, band, v, row_number() OVER (
    PARTITION BY x, y, band ORDER BY n DESC, v) AS nth FROM (
      SELECT {_BLOCK}, band, v, count(*) AS n FROM fx1 GROUP BY 1, 2, 3, 4) c) r WHERE nth = 1""")
def _(spark, sf):
    return cells(rt.resample(fx1_cells(spark, sf), HALF, "Mode"))


# target centre (x + .5) * 4/3 in source cells
_TARGETS = """SELECT x, y, (x + 0.5) * 4 / 3 AS sx, (y + 0.5) * 4 / 3 AS sy FROM
    (SELECT unnest(range(0, 96)) AS x) a,
    (SELECT unnest(range(0, (SELECT CAST(ceil((max(y) // 16 + 1) * 12) AS BIGINT) FROM fx1))) AS y) b"""


@query("resample_NearestNeighbor", "fx1", """SELECT t.x, t.y, f.band, f.v FROM targets t
    JOIN fx1 f ON f.x = floor(t.sx) AND f.y = floor(t.sy)""", targets=_TARGETS)
def _(spark, sf):
    return cells(rt.resample(fx1_cells(spark, sf), ODD, "NearestNeighbor"))


_TENT = "greatest(1 - abs({d}), 0)"
_KEYS = """CASE WHEN abs({d}) < 1 THEN (1.5 * abs({d}) - 2.5) * abs({d}) * abs({d}) + 1
    WHEN abs({d}) < 2 THEN ((-0.5 * abs({d}) + 2.5) * abs({d}) - 4) * abs({d}) + 2 ELSE 0 END"""
_SPLINE = """CASE WHEN abs({d}) < 1 THEN (3 * abs({d}) * abs({d}) * abs({d}) - 6 * {d} * {d} + 4) / 6
    WHEN abs({d}) < 2 THEN pow(2 - abs({d}), 3) / 6 ELSE 0 END"""
_SINC = """CASE WHEN abs({d}) < 1e-12 THEN 1 WHEN abs({d}) < 3 THEN
    3 * sin(pi() * {d}) * sin(pi() * {d} / 3) / (pi() * {d} * pi() * {d}) ELSE 0 END"""
# weighted means often end in an exact 5: a small shift takes them off the rounding border
_SHIFT = 1.3e-7
# kernels with negative lobes give way to bilinear weights where data cells carry too little
for _method, _kernel, _reach, _least in (
        ("Bilinear", _TENT, 1, 1e-9), ("CubicConvolution", _KEYS, 2, 0.3),
        ("CubicSpline", _SPLINE, 2, 1e-9), ("Lanczos", _SINC, 3, 0.3)):
    _taps = f"""SELECT x, y, sx, sy, cx, cy, ({_kernel.format(d='(sx - 0.5 - cx)')})
        * ({_kernel.format(d='(sy - 0.5 - cy)')}) AS w, ({_TENT.format(d='(sx - 0.5 - cx)')})
        * ({_TENT.format(d='(sy - 0.5 - cy)')}) AS t FROM (
        SELECT x, y, sx, sy, floor(sx - 0.5) + dx AS cx, floor(sy - 0.5) + dy AS cy FROM targets,
          (SELECT unnest(range({1 - _reach}, {_reach + 1})) AS dx) a,
          (SELECT unnest(range({1 - _reach}, {_reach + 1})) AS dy) b) q"""

    @query(f"resample_{_method}", "fx1", f"""SELECT t.x, t.y, f.band, round(CASE WHEN sum(w) > {_least}
          THEN sum(w * f.v) / sum(w) ELSE sum(t.t * f.v) / sum(t.t) END + {_SHIFT}, 4) AS v
        FROM taps t JOIN fx1 f ON f.x = t.cx AND f.y = t.cy
        JOIN (SELECT DISTINCT x // 16 AS tx, y // 16 AS ty FROM fx1) k
          ON k.tx = floor(t.sx / 16) AND k.ty = floor(t.sy / 16)
        GROUP BY 1, 2, 3 HAVING sum(w) > {_least} OR sum(t.t) > 1e-9""", targets=_TARGETS, taps=_taps)
    def _(spark, sf, method=_method):
        out = cells(rt.resample(fx1_cells(spark, sf), ODD, method))
        return rounded(out.withColumn("v", F.col("v") + _SHIFT), digits=4)


# --- retiling --------------------------------------------------------------------------------

@query("tile_to_layout", "fx5m", "SELECT x, y, 0 AS band, v FROM fx5m")
def _(spark, sf):
    return cells(rt.tile_to_layout(fx5_scenes(spark, sf), SCENES))


@query("tile_to_layout_temporal", "fx5", """SELECT x, y, CAST(DATE '2024-01-01' + label AS VARCHAR)[1:10]
    || ' 00:00:00' AS instant, 0 AS band, arg_min(v, priority) AS v FROM fx5 GROUP BY 1, 2, 3""")
def _(spark, sf):
    return texted(cells(rt.tile_to_layout(fx5_scenes(spark, sf, temporal=True), SCENES)))


@query("tile_to_layout_equal_ids", "fx5", """SELECT x, y, 0 AS band, arg_min(v, (priority // 5, v)) AS v
    FROM fx5 GROUP BY 1, 2""")
def _(spark, sf):
    """Five scenes an id: where they overlap the smaller value, in whatever order they come."""
    layer = fx5_scenes(spark, sf)
    ids = layer.df.withColumn("scene_id", F.floor(F.col("scene_id") / 5))
    return cells(rt.tile_to_layout(layer.with_df(ids), SCENES))


@query("tile_to_layout_average", "fx5", """SELECT x, y, 0 AS band, round(arg_min(v, priority), 6) AS v
    FROM (SELECT x // 2 AS x, y // 2 AS y, priority, avg(v) AS v FROM fx5 GROUP BY 1, 2, 3) q
    GROUP BY 1, 2""")
def _(spark, sf):
    half = replace(SCENES, layout_cols=2, layout_rows=1 << 18)
    return rounded(cells(rt.tile_to_layout(fx5_scenes(spark, sf), half, "Average")))


@query("tile_to_layout_local", "fx5m", """SELECT x - (SELECT min(x) FROM fx5m) AS x,
    y - (SELECT min(y) FROM fx5m) AS y, 0 AS band, v FROM fx5m""")
def _(spark, sf):
    return cells(rt.tile_to_layout(fx5_scenes(spark, sf), rt.LocalLayout(16)))


@query("retile", "fx1", "SELECT x, y, band, v FROM fx1")
def _(spark, sf):
    wide = rt.Layout(TALL.extent, 4, 1 << 17, 32, 32)
    return cells(rt.tile_to_layout(fx1_cells(spark, sf), wide))


@query("retile_tiles", "fx1", "SELECT x + 5 AS x, y + 7 AS y, band, v FROM fx1 WHERE x < 120")
def _(spark, sf):
    moved = rt.Layout(rt.Extent(-5.0, 7.0 - 20 * (1 << 18), 120.0, 7.0), 5, 1 << 18, 25, 20)
    return cells(rt.tile_to_layout(rt.to_tiles(fx1_cells(spark, sf)), moved))


def split_tiles(spark, sf):
    """FX1 as two tiles a key: low values in one, high values in the other."""
    layer = fx1_cells(spark, sf)
    return rt.union_layers([rt.to_tiles(layer.with_df(layer.df.where(part))) for part in ("v <= 20", "v > 20")])


@query("retile_repeated_keys", "fx1", "SELECT x + 5 AS x, y + 7 AS y, band, v FROM fx1 WHERE x < 120")
def _(spark, sf):
    moved = rt.Layout(rt.Extent(-5.0, 7.0 - 20 * (1 << 18), 120.0, 7.0), 5, 1 << 18, 25, 20)
    return cells(rt.tile_to_layout(split_tiles(spark, sf), moved))


@query("retile_tiles_temporal", "fx2", """SELECT x, y, CAST(instant AS VARCHAR) AS instant, band, v
    FROM fx2""")
def _(spark, sf):
    whole = rt.Layout(SMALL.extent, 1, 1, 32, 32)
    return texted(cells(rt.tile_to_layout(rt.to_tiles(fx2_cells(spark, sf)), whole)))


@query("resample_to_power_of_two", "fx1", """SELECT CAST(x * 2 + i AS BIGINT) AS x,
    CAST(y * 2 + j AS BIGINT) AS y, band, v FROM fx1, (SELECT unnest([0, 1]) AS i) a, (SELECT unnest([0, 1]) AS j) b""")
def _(spark, sf):
    return cells(rt.resample_to_power_of_two(fx1_cells(spark, sf), 5, 5))


@query("resample_to_power_of_two_temporal", "fx2", """SELECT x // 2 AS x, y // 2 AS y,
    CAST(instant AS VARCHAR) AS instant, band, max(v) AS v FROM fx2 GROUP BY 1, 2, 3, 4""")
def _(spark, sf):
    return texted(cells(rt.resample_to_power_of_two(fx2_cells(spark, sf), 2, 2, "Max")))


# half of the layer, in both directions
@query("crop", "fx1", """SELECT x, y, band, v FROM fx1 WHERE x BETWEEN 10 AND 99
    AND y BETWEEN 5 AND (SELECT max(y) // 2 FROM fx1)""")
def _(spark, sf):
    layer = rt.to_tiles(fx1_cells(spark, sf))
    south = fx1_cells(spark, sf).df.agg(F.max("y")).first()[0] // 2 + 1
    return cells(rt.crop(layer, rt.Extent(10.0, -float(south), 100.0, -5.0)))


@query("stitch_cells", "fx1", """SELECT CAST(floor((x - 10) / 3) AS BIGINT) AS x,
    CAST(floor((y - 5) / 3) AS BIGINT) AS y, band, max(v) AS v FROM fx1
    WHERE x BETWEEN 10 AND 99 AND y BETWEEN 5 AND 5 + 3 * ((SELECT max(y) FROM fx1) // 6) - 1
    GROUP BY 1, 2, 3""")
def _(spark, sf):
    layer = fx1_cells(spark, sf)
    rows = layer.df.agg(F.max("y")).first()[0] // 6
    extent = rt.Extent(10.0, -5.0 - 3 * rows, 100.0, -5.0)
    return cells(rt.stitch_cells(rt.crop(rt.to_tiles(layer), extent), extent, 30, rows, "Max"))


def _levels(first: str, top: int, step: str, n: int) -> dict[str, str]:
    """Level tables l0..ln, each from the one above."""
    out = {"l0": first}
    for k in range(1, n + 1):
        out[f"l{k}"] = step.format(prior=f"l{k - 1}", k=k)
    return out


_UNION = " UNION ALL ".join(
    f"SELECT x, y, band, {{value}} AS v, {18 - k} AS zoom FROM l{k}" for k in range(0, 4))


@query("pyramid_average", "fx1", _UNION.format(value="round(v, 6)"), **_levels(
    "SELECT x, y, band, CAST(v AS DOUBLE) AS v FROM fx1", 18,
    "SELECT x // 2 AS x, y // 2 AS y, band, avg(v) AS v FROM {prior} GROUP BY 1, 2, 3", 3))
def _(spark, sf):
    levels = rt.pyramid(fx1_cells(spark, sf), "Average", end_zoom=15)
    return rounded(rt.pyramid_cells(levels))


@query("pyramid_repeated_keys", "fx1", _UNION.format(value="v"), **_levels(
    "SELECT x, y, band, CAST(v AS DOUBLE) AS v FROM fx1", 18,
    "SELECT x // 2 AS x, y // 2 AS y, band, max(v) AS v FROM {prior} GROUP BY 1, 2, 3", 3))
def _(spark, sf):
    return rt.pyramid_cells(rt.pyramid(split_tiles(spark, sf), "Max", end_zoom=15))


@query("pyramid_max_global", "fx3", _UNION.format(value="v").replace("18", "19").replace("17", "18")
       .replace("16 AS zoom", "17 AS zoom").replace("15 AS zoom", "16 AS zoom"), **_levels(
    """SELECT x, y, 0 AS band, CAST(v AS DOUBLE) AS v FROM fx3""", 19,
    "SELECT x // 2 AS x, y // 2 AS y, band, max(v) AS v FROM {prior} GROUP BY 1, 2, 3", 3))
def _(spark, sf):
    layer = fx3_tiles(spark, sf)
    world = rt.global_level(3857, 19, 8)
    levels = rt.pyramid(layer.with_df(layer.df, layout=world, zoom=19), "Max", end_zoom=16)
    return rt.pyramid_cells(levels)


@query("pyramid_nearest", "fx1", _UNION.format(value="CAST(v AS DOUBLE)"), **_levels(
    "SELECT x, y, band, v FROM fx1", 18,
    "SELECT x // 2 AS x, y // 2 AS y, band, v FROM {prior} WHERE x % 2 = 1 AND y % 2 = 1", 3))
def _(spark, sf):
    return rt.pyramid_cells(rt.pyramid(fx1_cells(spark, sf), end_zoom=15))


@query("pyramid_max_to_top", "fx1", " UNION ALL ".join(f"SELECT x, y, band, v, {18 - k} AS zoom FROM l{k}" for k in range(19)),
       **_levels("SELECT x, y, band, CAST(v AS DOUBLE) AS v FROM fx1", 18,
                 "SELECT x // (CASE WHEN {k} <= 3 THEN 2 ELSE 1 END) AS x, y // 2 AS y, band, max(v) AS v FROM {prior} GROUP BY 1, 2, 3", 18))
def _(spark, sf):
    """All levels; from the fourth on the layout is one tile wide and shrinks in height alone."""
    return rt.pyramid_cells(rt.pyramid(fx1_cells(spark, sf), "Max"))


# --- coordinates and reprojection ------------------------------------------------------------

@query("transform_xy", "pt1", """SELECT point_id,
    round(degrees(lon / 6378137.0), 9) AS lon,
    round(degrees(2 * atan(exp(lat / 6378137.0)) - pi() / 2), 9) AS lat
    FROM (SELECT point_id, x * 50000 AS lon, -y * 3000 AS lat FROM pt1) q""")
def _(spark, sf):
    points = map_points(spark, sf)
    lon, lat = rt.transform_xy(F.col("x") * 50000, F.col("y") * 3000, 3857, 4326)
    return rounded(points.select("point_id", lon.alias("lon"), lat.alias("lat")), "lon", "lat",
                   digits=9)


@query("transform_xy_utm_round_trip", "pt1", """SELECT point_id, round(3.0 + x / 64, 7) AS lon,
    round(40.0 - y / 1024, 7) AS lat FROM pt1""")
def _(spark, sf):
    points = map_points(spark, sf)
    lon, lat = F.lit(3.0) + F.col("x") / 64, F.lit(40.0) + F.col("y") / 1024
    x, y = rt.transform_xy(lon, lat, 4326, 32631)
    there = points.select("point_id", x.alias("x"), y.alias("y"))
    lon, lat = rt.transform_xy(F.col("x"), F.col("y"), 32631, 4326)
    return rounded(there.select("point_id", lon.alias("lon"), lat.alias("lat")), "lon", "lat",
                   digits=7)


# Degrees for cells of about 0.8 source units.
_DEGREES = rt.Layout(rt.Extent(0.0, -0.0000072 * (1 << 22), 0.0000072 * 160, 0.0), 10, 1 << 18, 16, 16)
_BACK = """SELECT x, y, radians((x + 0.5) * 0.0000072) * 6378137.0 AS sx,
      -ln(tan(radians(-(y + 0.5) * 0.0000072) / 2 + pi() / 4)) * 6378137.0 AS sy FROM
    (SELECT unnest(range(0, 160)) AS x) a,
    (SELECT unnest(range(0, (SELECT CAST((max(y) + 32) * 1.3 AS BIGINT) FROM fx1))) AS y) b"""


@query("reproject_tiles", "fx1", """SELECT t.x, t.y, f.band, f.v FROM back t
    JOIN fx1 f ON f.x = floor(t.sx) AND f.y = floor(t.sy)""", back=_BACK)
def _(spark, sf):
    return cells(rt.reproject(fx1_cells(spark, sf), 4326, _DEGREES))


@query("reproject_scenes", "fx5m fx1", """SELECT t.x, t.y, 0 AS band, f.v FROM back t
    JOIN fx5m f ON f.x = floor(t.sx) AND f.y = floor(t.sy)""", back=_BACK.replace(
        "max(y) + 32) * 1.3 AS BIGINT) FROM fx1", "max(y) + 32) * 1.3 AS BIGINT) FROM fx5m"))
def _(spark, sf):
    return cells(rt.reproject(fx5_scenes(spark, sf), 4326, _DEGREES))


@query("reproject_bilinear", "fx1", f"""SELECT t.x, t.y, f.band,
      round(sum(w * f.v) / sum(w) + {_SHIFT}, 3) AS v
    FROM (SELECT x, y, sx, sy, cx, cy, (1 - abs(sx - 0.5 - cx)) * (1 - abs(sy - 0.5 - cy)) AS w FROM (
        SELECT x, y, sx, sy, floor(sx - 0.5) + dx AS cx, floor(sy - 0.5) + dy AS cy FROM back,
          (SELECT unnest([0, 1]) AS dx) a, (SELECT unnest([0, 1]) AS dy) b) q) t
    JOIN fx1 f ON f.x = t.cx AND f.y = t.cy
    JOIN (SELECT DISTINCT x // 16 AS tx, y // 16 AS ty FROM fx1) k
      ON k.tx = floor(t.sx / 16) AND k.ty = floor(t.sy / 16)
    GROUP BY 1, 2, 3 HAVING abs(sum(w)) > 1e-9""", back=_BACK)
def _(spark, sf):
    out = cells(rt.reproject(fx1_cells(spark, sf), 4326, _DEGREES, "Bilinear"))
    return rounded(out.withColumn("v", F.col("v") + _SHIFT), digits=3)


# Cells of 100 m in UTM zone 31 and back to degrees (Snyder 1987), in steps.
_UTM = rt.Layout(rt.Extent(388000.0, 1106400.0 - 100.0 * (1 << 22), 404000.0, 1106400.0), 10, 1 << 18, 16, 16)
_E2 = projection.E2
_E1 = (1 - (1 - _E2) ** 0.5) / (1 + (1 - _E2) ** 0.5)
_UTM_BACK = f"""SELECT x, y, (lon + 3.0 - 2.0) / 0.001 AS sx, (10.0 - lat) / 0.001 AS sy FROM (
  SELECT x, y, degrees((d - (1 + 2 * t2 + cc) * d * d * d / 6 + (5 - 2 * cc + 28 * t2 - 3 * cc * cc
      + 8 * {projection.EP2!r} + 24 * t2 * t2) * d * d * d * d * d / 120) / cos(phi)) AS lon,
    degrees(phi - n * tan(phi) / r * (d * d / 2 - (5 + 3 * t2 + 10 * cc - 4 * cc * cc - 9 * {projection.EP2!r})
      * d * d * d * d / 24 + (61 + 90 * t2 + 298 * cc + 45 * t2 * t2 - 252 * {projection.EP2!r} - 3 * cc * cc)
      * d * d * d * d * d * d / 720)) AS lat FROM (
  SELECT *, easting / (n * {projection.UTM_SCALE}) AS d, tan(phi) * tan(phi) AS t2,
    {projection.EP2!r} * cos(phi) * cos(phi) AS cc FROM (
  SELECT *, {projection.SEMI_MAJOR} / sqrt(w) AS n, {projection.SEMI_MAJOR} * (1 - {_E2!r}) / (w * sqrt(w)) AS r FROM (
  SELECT *, 1 - {_E2!r} * sin(phi) * sin(phi) AS w FROM (
  SELECT x, y, easting, mu + (3 * {_E1!r} / 2 - 27 * pow({_E1!r}, 3) / 32) * sin(2 * mu)
    + (21 * pow({_E1!r}, 2) / 16 - 55 * pow({_E1!r}, 4) / 32) * sin(4 * mu)
    + (151 * pow({_E1!r}, 3) / 96) * sin(6 * mu) + (1097 * pow({_E1!r}, 4) / 512) * sin(8 * mu) AS phi FROM (
  SELECT x, y, 388000.0 + (x + 0.5) * 100 - 500000.0 AS easting, (1106400.0 - (y + 0.5) * 100) / {projection.UTM_SCALE}
    / ({projection.SEMI_MAJOR} * (1 - {_E2!r} / 4 - 3 * pow({_E2!r}, 2) / 64 - 5 * pow({_E2!r}, 3) / 256)) AS mu FROM
    (SELECT unnest(range(0, 160)) AS x) a,
    (SELECT unnest(range(0, (SELECT CAST((max(y) + 32) * 1.3 AS BIGINT) FROM fx1))) AS y) b) s1) s2) s3) s4) s5) s6"""


def in_degrees(layer: rt.Layer) -> rt.Layer:
    """The layer's cells as thousandths of a degree, from 10 degrees north southwards."""
    there = rt.Layout(rt.Extent(2.0, 10.0 - 0.001 * (1 << 22), 2.0 + 0.128, 10.0), 8, 1 << 18, 16, 16)
    return layer.with_df(layer.df, layout=there, epsg=4326)


@query("reproject_to_utm", "fx1", """SELECT t.x, t.y, f.band, f.v FROM back t
    JOIN fx1 f ON f.x = floor(t.sx) AND f.y = floor(t.sy)""", back=_UTM_BACK)
def _(spark, sf):
    return cells(rt.reproject(in_degrees(fx1_cells(spark, sf)), 32631, _UTM))


@query("reproject_to_utm_local")
def _(spark, sf):
    """From degrees to UTM zone 31 by a layout type; the layout comes from the layer's extent."""
    layer = in_degrees(fx1_cells(spark, sf))
    rows = layer.df.agg(F.max("y")).first()[0] + 1
    extent = rt.Extent(2.0, 10.0 - 0.001 * rows, 2.128, 10.0)
    return cells(rt.reproject(layer.with_df(layer.df, extent=extent), 32631, rt.LocalLayout(64)))


# --- rasterize and distance ------------------------------------------------------------------

@query("rasterize", "inside_all", "SELECT DISTINCT x, y, 0 AS band, CAST(7 AS BIGINT) AS v FROM inside_all")
def _(spark, sf):
    return cells(rt.rasterize_on(TALL, 3857, 7, polygons=map_edges(spark, sf)))


@query("rasterize_points", "pt1", """SELECT DISTINCT CAST(floor(x) AS BIGINT) AS x,
    CAST(floor(y) AS BIGINT) AS y, 0 AS band, CAST(3 AS BIGINT) AS v FROM pt1 WHERE x < 128""")
def _(spark, sf):
    return cells(rt.rasterize_on(TALL, 3857, 3, points=map_points(spark, sf)))


_LINE_CELLS = """SELECT DISTINCT x, y FROM (
    SELECT unnest(range(CAST(floor(a) AS BIGINT), CAST(greatest(ceil(b), floor(a) + 1) AS BIGINT))) AS x, y
    FROM (SELECT y, least(xa, xb) AS a, greatest(xa, xb) AS b FROM (
      SELECT y, CASE WHEN y0 = y1 THEN x0 ELSE x0 + (least(greatest(y, least(y0, y1)), greatest(y0, y1)) - y0)
                 * (x1 - x0) / (y1 - y0) END AS xa,
             CASE WHEN y0 = y1 THEN x1 ELSE x0 + (least(greatest(y + 1, least(y0, y1)), greatest(y0, y1)) - y0)
                 * (x1 - x0) / (y1 - y0) END AS xb
      FROM (SELECT *, unnest(range(CAST(floor(least(y0, y1)) AS BIGINT), CAST(greatest(
              ceil(greatest(y0, y1)), floor(least(y0, y1)) + 1) AS BIGINT))) AS y FROM geo) e) s) t) u
    WHERE x < 128"""


@query("rasterize_lines", "geo", f"SELECT x, y, 0 AS band, CAST(1 AS BIGINT) AS v FROM ({_LINE_CELLS}) c")
def _(spark, sf):
    return cells(rt.rasterize_on(TALL, 3857, 1, lines=map_edges(spark, sf)))


@query("rasterize_global_zoom", "geo", """SELECT DISTINCT CAST(floor(x0 + 512) AS BIGINT) AS x,
    CAST(floor(y0 + 512) AS BIGINT) AS y, 0 AS band, CAST(9 AS BIGINT) AS v FROM geo""")
def _(spark, sf):
    """Corners of the polygons on the global grid of zoom 10, one cell per map step."""
    level = rt.global_level(3857, 10)
    step = level.cell_width
    edges = map_edges(spark, sf)
    at = edges.select((F.lit(level.extent.xmin) + (F.col("x0") + 512.5) * step).alias("x"),
                      (F.lit(level.extent.ymax) + (F.col("y0") - 512.5) * step).alias("y"))
    return cells(rt.rasterize(3857, 10, 9, points=at))


@query("rasterize_temporal", "geo", """SELECT x, y, '2024-02-03 04:05:06' AS instant, 0 AS band,
    CAST(5 AS BIGINT) AS v FROM (SELECT DISTINCT x, y FROM (
      SELECT e.geom_id, c.x, e.y FROM (SELECT g.*, unnest(range(CAST(floor(least(y0, y1) / 2) AS BIGINT) - 1,
          CAST(ceil(greatest(y0, y1) / 2) AS BIGINT) + 1)) AS y FROM geo g) e, (SELECT unnest(range(0, 64)) AS x) c
      WHERE 2 * e.y + 1 >= least(e.y0, e.y1) AND 2 * e.y + 1 < greatest(e.y0, e.y1)
        AND e.x0 + (2 * e.y + 1 - e.y0) * (e.x1 - e.x0) / (e.y1 - e.y0) <= 2 * c.x + 1
      GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1) i) d""")
def _(spark, sf):
    """All polygons; the extent reaches as far south as they do."""
    edges = map_edges(spark, sf)
    rows = int(-edges.agg(F.least(F.min("y0"), F.min("y1"))).first()[0]) // 2 + 1
    return texted(cells(rt.rasterize_single(
        rt.Extent(0.0, -2.0 * rows, 128.0, 0.0), 3857, "2024-02-03 04:05:06", 64, rows, 5, edges)))


@query("rasterize_partial", "geo inside_all", f"""SELECT DISTINCT x, y, 0 AS band, CAST(7 AS BIGINT) AS v
    FROM (SELECT x, y FROM inside_all UNION ALL SELECT x, y FROM ({_LINE_CELLS}) c) u""")
def _(spark, sf):
    """Cells that polygons cover in part count as well."""
    return cells(rt.rasterize_on(TALL, 3857, 7, polygons=map_edges(spark, sf), partial=True))


@query("rasterize_coverage", "covered", """SELECT x, CAST(y AS BIGINT) AS y, 0 AS band,
    round(sum(share) + 1.3e-7, 6) AS v FROM covered GROUP BY 1, 2""")
def _(spark, sf):
    """Shares of all polygons added up."""
    out = cells(rt.rasterize_coverage(TALL, 3857, map_edges(spark, sf)))
    return rounded(out.withColumn("v", F.col("v") + 1.3e-7))


@query("euclidean_distance", "pt1", """SELECT x, y, 0 AS band, round(sqrt(min(
      (x + 0.5 - px) * (x + 0.5 - px) + (y + 0.5 - py) * (y + 0.5 - py))), 6) AS v
    FROM (SELECT unnest(range(0, 128)) AS x) a, (SELECT unnest(range(0, (SELECT CAST(
      (floor(max(y) / 16) + 1) * 16 AS BIGINT) FROM pt1))) AS y) b,
      (SELECT x AS px, y AS py FROM pt1) p GROUP BY 1, 2""")
def _(spark, sf):
    return rounded(cells(rt.euclidean_distance(TALL, 3857, points=map_points(spark, sf))))


# From cells: the nearest in each column first, then over the columns.
_NEAREST_CELL = """SELECT x, y, 0 AS band, round(sqrt(min((x - c) * (x - c) + gap * gap)), 6) AS v FROM (
      SELECT unnest(range(0, 128)) AS x) a, (
      SELECT q.y, s.c, least(coalesce(q.y - max(s.y) FILTER (s.y <= q.y), 1000000), coalesce(
        min(s.y) FILTER (s.y >= q.y) - q.y, 1000000)) AS gap
      FROM (SELECT unnest(range((SELECT min(y) // 16 * 16 FROM cells), (SELECT (max(y) // 16 + 1) * 16 FROM cells))) AS y) q
      JOIN (SELECT DISTINCT x AS c, y FROM cells) s ON s.y BETWEEN q.y - 400 AND q.y + 400
      GROUP BY q.y, s.c) g
    WHERE x BETWEEN (SELECT min(x) // 16 * 16 FROM cells) AND (SELECT max(x) // 16 * 16 + 15 FROM cells) GROUP BY 1, 2"""


@query("euclidean_distance_polygons", "inside_all", _NEAREST_CELL, cells="SELECT x, y FROM inside_all")
def _(spark, sf):
    """From the cells inside polygons."""
    return rounded(cells(rt.euclidean_distance(TALL, 3857, polygons=map_edges(spark, sf))))


@query("euclidean_distance_lines", "geo", _NEAREST_CELL, cells=_LINE_CELLS)
def _(spark, sf):
    """From the cells that the polygons' edges cross."""
    return rounded(cells(rt.euclidean_distance(TALL, 3857, lines=map_edges(spark, sf))))


# Least costs grow from the sources cell by cell; what fell in one step goes on in the next.
def _least_costs(sources: str, limit: str) -> str:
    return f"""WITH RECURSIVE friction AS MATERIALIZED (SELECT * FROM fx1b0), cost(x, y, d) USING KEY (x, y) AS (
      SELECT x, y, CAST(0 AS DOUBLE) AS d FROM friction SEMI JOIN ({sources}) s USING (x, y)
      UNION
      SELECT x, y, min(d) AS d FROM (
        SELECT f.x, f.y, c.d + m.len * (g.v + f.v) / 2 AS d FROM cost c JOIN friction g ON g.x = c.x AND g.y = c.y
        CROSS JOIN (SELECT dx, dy, sqrt(dx * dx + dy * dy) AS len FROM (SELECT unnest([-1, 0, 1]) AS dx) a,
          (SELECT unnest([-1, 0, 1]) AS dy) b WHERE dx <> 0 OR dy <> 0) m
        JOIN friction f ON f.x = c.x + m.dx AND f.y = c.y + m.dy) n
      LEFT JOIN (SELECT x AS kx, y AS ky, d AS kd FROM recurring.cost) k ON kx = x AND ky = y
      WHERE (kd IS NULL OR d < kd) {limit} GROUP BY x, y)
    SELECT x, y, 0 AS band, round(d, 6) AS v FROM cost"""


_AT_POINTS = "SELECT CAST(floor(x) AS BIGINT) AS x, CAST(floor(y) AS BIGINT) AS y FROM pt1"


@query("cost_distance", "fx1b0 pt1", _least_costs(_AT_POINTS, "AND d <= 400"))
def _(spark, sf):
    return rounded(cells(rt.cost_distance(fx1_cells(spark, sf), map_points(spark, sf), 400.0)))


@query("cost_distance_unlimited", "fx1b0 pt1", _least_costs(_AT_POINTS + " WHERE point_id % 8 = 0", ""))
def _(spark, sf):
    """From one point in eight, as far as data goes."""
    return rounded(cells(rt.cost_distance(fx1_cells(spark, sf), map_points(spark, sf).where("point_id % 8 = 0"))))


@query("cost_distance_polygons", "fx1b0 inside_all", _least_costs("SELECT x, y FROM inside_all", "AND d <= 300"))
def _(spark, sf):
    """From the cells inside polygons."""
    return rounded(cells(rt.cost_distance(fx1_cells(spark, sf), max_distance=300.0, polygons=map_edges(spark, sf))))
