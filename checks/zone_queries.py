"""Queries of polygons, points, series, aggregation, histograms and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

import rastertable as rt

from .cell_queries import cells, rounded, texted
from .fixtures import (KEYED, SCENES, TALL, fx1_cells, fx2_cells, fx3_labels, fx3_tiles,
                       fx5_scenes, map_edges, map_points, table)
from .registry import query


# --- geometry --------------------------------------------------------------------------------

@query("polygon_spans", "inside_all", """SELECT geom_id, y, min(x) AS x0, max(x) + 1 AS x1 FROM (
    SELECT geom_id, x, y, x - row_number() OVER (PARTITION BY geom_id, y ORDER BY x) AS run
    FROM inside_all) r GROUP BY geom_id, y, run""")
def _(spark, sf):
    return rt.polygon_spans(map_edges(spark, sf), TALL)


@query("mask", "inside", """SELECT f.x, f.y, f.band, f.v FROM fx1 f
    WHERE EXISTS (SELECT 1 FROM inside i WHERE i.x = f.x AND i.y = f.y)""")
def _(spark, sf):
    return cells(rt.mask(fx1_cells(spark, sf), map_edges(spark, sf)))


_ZONAL = """SELECT i.geom_id, f.band, {} AS value FROM fx1 f
    JOIN inside i ON i.x = f.x AND i.y = f.y GROUP BY 1, 2"""


@query("polygonal_min", "inside", _ZONAL.format("min(f.v)"))
def _(spark, sf):
    return rt.polygonal_min(fx1_cells(spark, sf), map_edges(spark, sf))


@query("polygonal_max", "inside", _ZONAL.format("max(f.v)"))
def _(spark, sf):
    return rt.polygonal_max(fx1_cells(spark, sf), map_edges(spark, sf))


@query("polygonal_sum", "inside", _ZONAL.format("CAST(sum(f.v) AS BIGINT)"))
def _(spark, sf):
    return rt.polygonal_sum(fx1_cells(spark, sf), map_edges(spark, sf))


@query("polygonal_mean", "inside", _ZONAL.format("round(avg(f.v), 6)"))
def _(spark, sf):
    return rounded(rt.polygonal_mean(fx1_cells(spark, sf), map_edges(spark, sf)), "value")


@query("polygon_coverage", "covered", """SELECT geom_id, x, CAST(y AS BIGINT) AS y,
    round(share + 1.3e-7, 6) AS share FROM covered""")
def _(spark, sf):
    """Runs of equal shares, cell by cell."""
    spans = rt.coverage_spans(map_edges(spark, sf), TALL)
    return spans.select("geom_id", F.explode(F.sequence("x0", F.col("x1") - 1)).alias("x"), "y",
                        F.round(F.col("share") + 1.3e-7, 6).alias("share"))


@query("polygonal_weighted", "fx1 covered", """SELECT c.geom_id, f.band, round(sum(c.share) + 1.3e-7, 6) AS weight,
    round(sum(c.share * f.v) + 1.3e-7, 6) AS sum, round(sum(c.share * f.v) / sum(c.share) + 1.3e-7, 6) AS mean
    FROM fx1 f JOIN covered c ON c.x = f.x AND c.y = f.y GROUP BY 1, 2""")
def _(spark, sf):
    """Cells count by the share that a polygon covers."""
    out = rt.polygonal_weighted(fx1_cells(spark, sf), map_edges(spark, sf))
    return rounded(out.withColumns({n: F.col(n) + 1.3e-7 for n in ("weight", "sum", "mean")}), "weight", "sum", "mean")


@query("polygonal_sum_double", "inside", _ZONAL.format("round(sum(f.v / 4.0), 6)"))
def _(spark, sf):
    layer = rt.local_divide(fx1_cells(spark, sf), 4.0)
    return rounded(rt.polygonal_sum(layer, map_edges(spark, sf)), "value")


@query("polygonal_min_max_double", "inside", """SELECT i.geom_id, f.band, min(f.v / 4.0) AS low,
    max(f.v / 4.0) AS high FROM fx1 f JOIN inside i ON i.x = f.x AND i.y = f.y GROUP BY 1, 2""")
def _(spark, sf):
    layer = rt.local_divide(fx1_cells(spark, sf), 4.0)
    return rt.polygonal_summary(layer, map_edges(spark, sf)).select(
        "geom_id", "band", F.col("min").alias("low"), F.col("max").alias("high"))


@query("polygonal_union", "inside", """SELECT f.band, CAST(sum(f.v) AS BIGINT) AS value FROM fx1 f
    WHERE EXISTS (SELECT 1 FROM inside i WHERE i.x = f.x AND i.y = f.y) GROUP BY 1""")
def _(spark, sf):
    return rt.polygonal_sum(fx1_cells(spark, sf), map_edges(spark, sf), by_geometry=False)


@query("masked_zonal_summary", "inside", """SELECT i.geom_id, f.band, count(*) AS cells,
    min(f.v) AS min, max(f.v) AS max, CAST(sum(f.v) AS BIGINT) AS sum, round(avg(f.v), 6) AS mean
    FROM fx1 f JOIN inside i ON i.x = f.x AND i.y = f.y GROUP BY 1, 2""")
def _(spark, sf):
    edges = map_edges(spark, sf)
    masked = rt.mask(rt.to_tiles(fx1_cells(spark, sf)), edges)
    return rounded(rt.polygonal_summary(masked, edges), "mean")


# --- series ----------------------------------------------------------------------------------

# the suppliers' polygons moved onto the 32 x 32 layer, where many of them overlap
def series_edges(spark, sf):
    fold = F.col("geom_id") % 8 * 4
    x0 = (F.col("geom_id") * 13) % 96
    edges = map_edges(spark, sf)
    return edges.withColumns({
        "x0": F.col("x0") - x0, "x1": F.col("x1") - x0,
        "y0": F.col("y0") + F.col("geom_id") * 4 - fold,
        "y1": F.col("y1") + F.col("geom_id") * 4 - fold})


_FOLD = """SELECT geom_id, x0 - (geom_id * 13) % 96 AS x0, x1 - (geom_id * 13) % 96 AS x1,
    y0 - geom_id * 4 + geom_id % 8 * 4 AS y0, y1 - geom_id * 4 + geom_id % 8 * 4 AS y1
    FROM geo"""
_HIT = """SELECT DISTINCT c.x, c.y FROM (SELECT a.x, b.y, e.geom_id FROM
      (SELECT unnest(range(0, 32)) AS x) a, (SELECT unnest(range(0, 32)) AS y) b, fold e
    WHERE b.y + 0.5 >= least(e.y0, e.y1) AND b.y + 0.5 < greatest(e.y0, e.y1)
      AND e.x0 + (b.y + 0.5 - e.y0) * (e.x1 - e.x0) / (e.y1 - e.y0) <= a.x + 0.5
    GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1) c"""
_SERIES = {
    "sum_series": (rt.sum_series, "CAST(sum(f.v) AS BIGINT)"),
    "min_series": (rt.min_series, "min(f.v)"),
    "max_series": (rt.max_series, "max(f.v)"),
    "mean_series": (rt.mean_series, "round(avg(f.v), 6)"),
}
for _name, (_op, _sql) in _SERIES.items():
    @query(_name, "fx2 geo", f"""SELECT CAST(f.instant AS VARCHAR) AS instant, {_sql} AS value
        FROM fx2 f JOIN hit h ON h.x = f.x AND h.y = f.y GROUP BY f.instant""", fold=_FOLD, hit=_HIT)
    def _(spark, sf, op=_op, name=_name):
        edges = series_edges(spark, sf)
        out = texted(op(fx2_cells(spark, sf), edges))
        return rounded(out, "value") if name == "mean_series" else out


@query("histogram_series", "fx2 geo", """SELECT CAST(f.instant AS VARCHAR) AS instant, f.v AS value,
    count(*) AS count FROM fx2 f JOIN hit h ON h.x = f.x AND h.y = f.y GROUP BY f.instant, f.v""",
       fold=_FOLD, hit=_HIT)
def _(spark, sf):
    edges = series_edges(spark, sf)
    return texted(rt.histogram_series(fx2_cells(spark, sf), edges))


@query("polygonal_sum_temporal", "fx2 geo", """SELECT CAST(f.instant AS VARCHAR) AS instant, f.band,
    CAST(sum(f.v) AS BIGINT) AS value FROM fx2 f JOIN hit h ON h.x = f.x AND h.y = f.y
    GROUP BY f.instant, f.band""", fold=_FOLD, hit=_HIT)
def _(spark, sf):
    edges = series_edges(spark, sf)
    return texted(rt.polygonal_sum(fx2_cells(spark, sf), edges, by_geometry=False))


# --- points ----------------------------------------------------------------------------------

@query("point_values", "fx1 pt1", """SELECT p.point_id, b.band, f.v FROM pt1 p
    CROSS JOIN (SELECT 0 AS band UNION ALL SELECT 1) b
    LEFT JOIN fx1 f ON f.x = floor(p.x) AND f.y = floor(p.y) AND f.band = b.band""")
def _(spark, sf):
    found = rt.point_values(fx1_cells(spark, sf), map_points(spark, sf))
    both = F.coalesce("values", F.array(F.lit(None), F.lit(None)).cast("array<double>"))
    return found.select("point_id", F.posexplode(both).alias("band", "v")).withColumn(
        "v", F.col("v").cast("bigint"))


@query("point_values_bilinear", "fx1 pt1", """SELECT p.point_id, b.band, t.v FROM pt1 p
    CROSS JOIN (SELECT 0 AS band UNION ALL SELECT 1) b LEFT JOIN (
      SELECT p.point_id, f.band, round(sum(w * f.v) / sum(w), 6) AS v FROM (
        SELECT point_id, floor(x - 0.5) + dx AS cx, floor(y - 0.5) + dy AS cy,
          (1 - abs(x - 0.5 - floor(x - 0.5) - dx)) * (1 - abs(y - 0.5 - floor(y - 0.5) - dy)) AS w
        FROM pt1, (SELECT unnest([0, 1]) AS dx) a, (SELECT unnest([0, 1]) AS dy) b) p
      JOIN fx1 f ON f.x = p.cx AND f.y = p.cy WHERE w > 0 GROUP BY 1, 2) t
    ON t.point_id = p.point_id AND t.band = b.band""")
def _(spark, sf):
    found = rt.point_values(fx1_cells(spark, sf), map_points(spark, sf), "Bilinear")
    both = F.coalesce("values", F.array(F.lit(None), F.lit(None)).cast("array<double>"))
    return rounded(found.select("point_id", F.posexplode(both).alias("band", "v")))


@query("point_values_temporal", "fx2 pt1", """SELECT p.point_id, CAST(t.instant AS VARCHAR) AS instant, f.v
    FROM (SELECT point_id, CAST(floor(x) AS BIGINT) AS x, CAST(floor(y) AS BIGINT) AS y FROM pt1) p
    LEFT JOIN (SELECT DISTINCT x // 8 AS tx, y // 8 AS ty, instant FROM fx2) t ON t.tx = p.x // 8 AND t.ty = p.y // 8
    LEFT JOIN fx2 f ON f.x = p.x AND f.y = p.y AND f.instant = t.instant""")
def _(spark, sf):
    """Every point at every instant that has its tile, and points off the layer once."""
    found = rt.point_values(fx2_cells(spark, sf), map_points(spark, sf))
    v = F.get("values", F.lit(0)).cast("bigint")
    return texted(found.select("point_id", "instant", v.alias("v")))


# --- aggregation -----------------------------------------------------------------------------

_STACK = {
    "Sum": ("CAST(sum(v) AS BIGINT)", None), "Min": ("min(v)", None), "Max": ("max(v)", None),
    "Mean": ("round(avg(v), 6)", 6), "Variance": ("round(var_samp(v), 4)", 4),
    "StandardDeviation": ("round(stddev_samp(v), 6)", 6),
}
for _name, (_sql, _digits) in _STACK.items():
    # the sum needs data in every tile of the key; the others skip gaps
    _have = "HAVING count(*) = max(p.present)" if _name == "Sum" else ""
    _tiles = """JOIN (SELECT tx, ty, count(*) AS present FROM (
        SELECT DISTINCT x // 16 AS tx, y // 16 AS ty, 0 AS l FROM fx1
        UNION ALL SELECT DISTINCT x // 16, y // 16, 1 FROM fx1 WHERE v > 20
        UNION ALL SELECT DISTINCT x // 16, y // 16, 2 FROM fx1) t GROUP BY 1, 2) p
      ON p.tx = u.x // 16 AND p.ty = u.y // 16"""

    @query(f"aggregate_by_cell_{_name}", "fx1", f"""SELECT * FROM (SELECT x, y, band, {_sql} AS v
        FROM (SELECT x, y, band, v FROM fx1 UNION ALL SELECT x, y, band, v * 3 FROM fx1 WHERE v > 20
              UNION ALL SELECT x, y, band, v + 5 FROM fx1) u {_tiles if _name == "Sum" else ""}
        GROUP BY x, y, band {_have}) q WHERE v IS NOT NULL""")
    def _(spark, sf, name=_name, digits=_digits):
        layer = fx1_cells(spark, sf)
        high = layer.with_df(layer.df.where("v > 20")) * 3
        stack = rt.union_layers([rt.to_tiles(t) for t in (layer, high, layer + 5)])
        out = cells(rt.aggregate_by_cell(stack, name))
        return rounded(out, digits=digits) if digits else out


@query("aggregate_by_cell_mixed_bands", "fx1", "SELECT x, y, band, v + 5 AS v FROM fx1 WHERE band = 0")
def _(spark, sf):
    layer = rt.to_tiles(fx1_cells(spark, sf))
    return cells(rt.aggregate_by_cell(rt.union_layers([rt.select_bands(layer, [0]) + 5, layer]), "Max"))


@query("aggregate_by_cell_large_integers", "fx1", """SELECT x, y, band, CAST(2 * v + 18014398509481987 AS BIGINT) AS v
    FROM fx1""")
def _(spark, sf):
    """Sum of two layers whose cells lie past 2^53, where doubles skip every other whole number."""
    layer = fx1_cells(spark, sf)
    far = [rt.to_tiles(layer.with_df(layer.df.withColumn("v", F.col("v") + F.lit(9007199254740993 + k)))) for k in (0, 1)]
    return cells(rt.aggregate_by_cell(rt.union_layers(far), "Sum"))


@query("aggregate_over_time", "fx2", """SELECT x, y, band, round(avg(v), 6) AS v FROM fx2
    GROUP BY 1, 2, 3""")
def _(spark, sf):
    flat = rt.to_spatial(rt.to_tiles(fx2_cells(spark, sf)))
    return rounded(cells(rt.aggregate_by_cell(flat, "Mean")))


@query("merge", "fx1", """SELECT x, y, band, arg_min(v, nth) AS v FROM (
    SELECT x, y, band, -v AS v, 0 AS nth FROM fx1 WHERE v > 20
    UNION ALL SELECT x, y, band, v, 1 FROM fx1) u GROUP BY 1, 2, 3""")
def _(spark, sf):
    layer = fx1_cells(spark, sf)
    high = 0 - layer.with_df(layer.df.where("v > 20"))
    return cells(rt.merge([rt.to_tiles(high), rt.to_tiles(layer)]))


@query("merge_repeated_cells", "fx1", """SELECT x, y, band, min(v) AS v FROM (
    SELECT x, y, band, v FROM fx1 UNION ALL SELECT x, y, band, 40 - v FROM fx1) u GROUP BY 1, 2, 3""")
def _(spark, sf):
    """Cells that repeat inside one layer: the smaller value, whatever the order of rows."""
    layer = fx1_cells(spark, sf)
    return cells(rt.merge(layer.with_df(layer.df.unionByName(layer.df.withColumn("v", 40 - F.col("v"))))))


@query("raster_summary", "", """SELECT 3857 AS epsg, 'int32' AS cell_type,
    CAST(min((vec_id * 7) % 24) AS DOUBLE) AS xmin, CAST(-max(vec_id) - 8 AS DOUBLE) AS ymin,
    CAST(max((vec_id * 7) % 24) + 8 AS DOUBLE) AS xmax, CAST(-min(vec_id) AS DOUBLE) AS ymax,
    CAST(DATE '2024-01-01' + min(label) AS VARCHAR)[1:10] || ' 00:00:00' AS start,
    CAST(DATE '2024-01-01' + max(label) AS VARCHAR)[1:10] || ' 00:00:00' AS "end",
    count(*) AS tile_count, CAST(1 AS DOUBLE) AS cell_width, CAST(1 AS DOUBLE) AS cell_height
    FROM embeddings""")
def _(spark, sf):
    out = rt.raster_summary(fx5_scenes(spark, sf, temporal=True))
    return out.withColumns({c: F.col(c).cast("string") for c in ("start", "end")})


@query("combine_summaries", "", """SELECT 3857 AS epsg, 'float64' AS cell_type,
    CAST(min((vec_id * 7) % 24) AS DOUBLE) AS xmin, CAST(-max(vec_id) - 8 AS DOUBLE) AS ymin,
    CAST(max((vec_id * 7) % 24) + 8 AS DOUBLE) AS xmax, CAST(-min(vec_id) AS DOUBLE) AS ymax,
    2 * count(*) AS tile_count, CAST(1 AS DOUBLE) AS cell_width, CAST(1 AS DOUBLE) AS cell_height FROM embeddings""")
def _(spark, sf):
    scenes = fx5_scenes(spark, sf)
    return rt.combine_summaries([rt.raster_summary(scenes), rt.raster_summary(rt.convert(scenes, "float64"))])


@query("min_max", "fx1", "SELECT min(v) AS min, max(v) AS max FROM fx1")
def _(spark, sf):
    return rt.min_max(fx1_cells(spark, sf))


@query("histogram_exact", "fx1", "SELECT band, v AS value, count(*) AS count FROM fx1 GROUP BY 1, 2")
def _(spark, sf):
    return rt.histogram_exact(rt.to_tiles(fx1_cells(spark, sf)))


@query("histogram_json_round_trip", "fx1",
       "SELECT band, CAST(v AS DOUBLE) AS value, CAST(count(*) AS DOUBLE) AS count FROM fx1 GROUP BY 1, 2")
def _(spark, sf):
    rows = rt.histogram_to_json(rt.histogram_exact(fx1_cells(spark, sf)))
    return rt.histogram_from_json(rows)


@query("histogram_approx")
def _(spark, sf):
    return rt.histogram_approx(rt.local_divide(fx1_cells(spark, sf), 3.0), 40)


@query("histogram_approx_total", "fx1",
       "SELECT band, CAST(count(*) AS DOUBLE) AS total FROM fx1 GROUP BY 1")
def _(spark, sf):
    sketch = rt.histogram_approx(rt.local_divide(fx1_cells(spark, sf), 3.0), 40)
    return sketch.groupBy("band").agg(F.sum("count").alias("total"))


_QUANTILES = """SELECT band, CAST(i AS INT) AS i, min(v) AS value FROM (
      SELECT band, v, count(*) OVER (PARTITION BY band ORDER BY v) AS upto,
             count(*) OVER (PARTITION BY band) AS total FROM fx1) q,
      (SELECT unnest(range(1, 11)) AS i) n WHERE upto * 10 >= i * total GROUP BY 1, 2"""


@query("quantile_breaks_exact", "fx1", _QUANTILES)
def _(spark, sf):
    return rt.quantile_breaks_exact(fx1_cells(spark, sf), 10)


@query("quantile_breaks", "fx1", _QUANTILES)
def _(spark, sf):
    return rt.quantile_breaks(fx1_cells(spark, sf), 10, accuracy=1000000)


@query("quantile_breaks_exact_wide", "fx2", """SELECT band, CAST(i AS INT) AS i, min(v) AS value FROM (
      SELECT band, v * 1000 - 7000000 AS v, count(*) OVER (PARTITION BY band ORDER BY v) AS upto,
             count(*) OVER (PARTITION BY band) AS total FROM fx2) q,
      (SELECT unnest(range(1, 8)) AS i) n WHERE upto * 7 >= i * total GROUP BY 1, 2""")
def _(spark, sf):
    return rt.quantile_breaks_exact(fx2_cells(spark, sf) * 1000 - 7000000, 7)
