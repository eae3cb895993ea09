"""Queries of neighbourhood operations."""

from __future__ import annotations

import rastertable as rt

from .cell_queries import cells, rounded, texted
from .fixtures import fx1_cells, fx2_cells
from .registry import query

_SQUARE = "SELECT dx, dy FROM (SELECT unnest(range(-{n}, {n} + 1)) AS dx) a, (SELECT unnest(range(-{n}, {n} + 1)) AS dy) b"
_OFFSETS = {
    "Square": (rt.Square(3), _SQUARE.format(n=3)),
    "Nesw": (rt.Nesw(4), _SQUARE.format(n=4) + " WHERE dx = 0 OR dy = 0"),
    "Circle": (rt.Circle(3), _SQUARE.format(n=3) + " WHERE dx * dx + dy * dy <= 9"),
    "Annulus": (rt.Annulus(2, 4), _SQUARE.format(n=4) + " WHERE dx * dx + dy * dy BETWEEN 4 AND 16"),
    "Wedge": (rt.Wedge(4, 300, 60), _SQUARE.format(n=4) + """ WHERE dx * dx + dy * dy <= 16 AND
        ((dx = 0 AND dy = 0) OR (degrees(atan2(-dy, dx)) BETWEEN -60 AND 60))"""),
}
# every data cell is sent to the cells that see it
_NEAR = """FROM grid g JOIN (SELECT x - dx AS x, y - dy AS y, v FROM fx1b0, offs) f
    ON f.x = g.x AND f.y = g.y"""
_STATS = {
    "Sum": "CAST(sum(f.v) AS BIGINT)", "Min": "min(f.v)", "Max": "max(f.v)",
    "Mean": "round(avg(f.v), 6)", "StandardDeviation": "round(stddev_pop(f.v), 5)",
    "Median": "round(median(f.v), 6)",
}


def _register(operation: str, shape: str) -> None:
    area, offsets = _OFFSETS[shape]
    if operation == "Mode":
        sql = f"""SELECT x, y, 0 AS band, v FROM (SELECT x, y, v, row_number() OVER (
            PARTITION BY x, y ORDER BY n DESC, v) AS nth FROM (
              SELECT g.x, g.y, f.v, count(*) AS n {_NEAR} GROUP BY 1, 2, 3) c) r WHERE nth = 1"""
    else:
        sql = f"SELECT g.x, g.y, 0 AS band, {_STATS[operation]} AS v {_NEAR} GROUP BY 1, 2"

    @query(f"focal_{operation}_{shape}", "grid fx1b0", sql, offs=offsets)
    def _(spark, sf):
        out = cells(rt.focal(fx1_cells(spark, sf), operation, area))
        digits = {"Mean": 6, "Median": 6, "StandardDeviation": 5}.get(operation)
        return rounded(out, digits=digits) if digits else out


for _operation in (*_STATS, "Mode"):
    _register(_operation, "Square")
for _shape in ("Nesw", "Circle", "Annulus", "Wedge"):
    _register("Sum", _shape)
_register("Median", "Circle")
_register("Mode", "Circle")
_register("Max", "Annulus")


@query("focal_target_nodata", "grid fx1b0", f"""SELECT x, y, 0 AS band, v FROM (
    SELECT g.x, g.y, coalesce(max(c.v), CAST(sum(f.v) AS BIGINT)) AS v FROM grid g, offs o
    LEFT JOIN fx1b0 f ON f.x = g.x + o.dx AND f.y = g.y + o.dy
    LEFT JOIN fx1b0 c ON c.x = g.x AND c.y = g.y GROUP BY 1, 2) q WHERE v IS NOT NULL""",
       offs=_SQUARE.format(n=1))
def _(spark, sf):
    return cells(rt.focal(fx1_cells(spark, sf), "Sum", rt.Square(1), target="NoData"))


@query("focal_sum_temporal", "fx2", """SELECT t.x, t.y, CAST(t.instant AS VARCHAR) AS instant,
      0 AS band, CAST(sum(f.v) AS BIGINT) AS v
    FROM (SELECT tx * 8 + i AS x, ty * 8 + j AS y, instant FROM (
            SELECT DISTINCT x // 8 AS tx, y // 8 AS ty, instant FROM fx2) k,
            (SELECT unnest(range(0, 8)) AS i) a, (SELECT unnest(range(0, 8)) AS j) b) t
    JOIN fx2 f ON f.instant = t.instant AND f.x BETWEEN t.x - 2 AND t.x + 2
      AND f.y BETWEEN t.y - 2 AND t.y + 2 GROUP BY t.x, t.y, t.instant""")
def _(spark, sf):
    return texted(cells(rt.focal(fx2_cells(spark, sf), "Sum", rt.Square(2))))


# Rise to the east and south per cell; missing neighbours count as the centre.
_HORN = """SELECT x, y, (ne + 2 * e + se - nw - 2 * w - sw) / 8.0 AS ge,
      (sw + 2 * s + se - nw - 2 * n - ne) / 8.0 AS gs FROM (
    SELECT c.x, c.y, """ + ", ".join(
    f"coalesce(max(CASE WHEN o.dx = {dx} AND o.dy = {dy} THEN f.v END), max(c.v)) AS {name}"
    for name, dx, dy in (("nw", -1, -1), ("n", 0, -1), ("ne", 1, -1), ("w", -1, 0), ("e", 1, 0),
                         ("sw", -1, 1), ("s", 0, 1), ("se", 1, 1))) + """
    FROM fx1b0 c, offs o LEFT JOIN fx1b0 f ON f.x = c.x + o.dx AND f.y = c.y + o.dy
    GROUP BY 1, 2) q"""
_HORN_PARTS = {"offs": _SQUARE.format(n=1), "horn": _HORN}


@query("slope", "fx1b0", """SELECT x, y, 0 AS band,
    round(degrees(atan(0.1 * sqrt(ge * ge + gs * gs))), 6) AS v FROM horn""", **_HORN_PARTS)
def _(spark, sf):
    return rounded(cells(rt.slope(fx1_cells(spark, sf), 0.1)))


@query("aspect", "fx1b0", """SELECT x, y, 0 AS band, CASE WHEN ge = 0 AND gs = 0 THEN -1.0 ELSE
    round(CASE WHEN atan2(-ge, gs) < 0 THEN degrees(atan2(-ge, gs)) + 360
               ELSE degrees(atan2(-ge, gs)) END, 6) END AS v FROM horn""", **_HORN_PARTS)
def _(spark, sf):
    return rounded(cells(rt.focal(fx1_cells(spark, sf), "Aspect")))


@query("hillshade", "fx1b0", """SELECT x, y, 0 AS band, CAST(floor(255 * greatest(0.0,
      cos(radians(50.0)) * cos(st) + sin(radians(50.0)) * sin(st) * cos(radians(300.0) - atan2(-ge, gs)))
      + 0.5) AS BIGINT) AS v
    FROM (SELECT *, atan(0.05 * sqrt(ge * ge + gs * gs)) AS st FROM horn) q""", **_HORN_PARTS)
def _(spark, sf):
    return cells(rt.hillshade(fx1_cells(spark, sf), 300, 40, 0.05))


@query("tobler", "fx1b0", """SELECT x, y, 0 AS band,
    round(6 * exp(-3.5 * abs(tan(atan(0.01 * sqrt(ge * ge + gs * gs))) + 0.05)), 6) AS v FROM horn""",
       **_HORN_PARTS)
def _(spark, sf):
    return rounded(cells(rt.tobler(fx1_cells(spark, sf), 0.01)))


# --- radius 40 -------------------------------------------------------------------------------

# dense cells of the tiles that hold data and of those around them
_DENSE = """SELECT c.x, c.y, f.v FROM (SELECT unnest(range(-40, 168)) AS x) a,
      (SELECT unnest(range(-40, (SELECT max(y) + 57 FROM fx1b0))) AS y) b, LATERAL (SELECT a.x, b.y) c
    LEFT JOIN fx1b0 f ON f.x = c.x AND f.y = c.y"""
_LINES = "SELECT x, y, {fn}(v) OVER (PARTITION BY y ORDER BY x ROWS BETWEEN 40 PRECEDING AND 40 FOLLOWING) AS v FROM dense"
_SQUARES = "SELECT x, y, {fn}(v) OVER (PARTITION BY x ORDER BY y ROWS BETWEEN 40 PRECEDING AND 40 FOLLOWING) AS v FROM lines"
for _name, _fn in (("Sum", "sum"), ("Min", "min"), ("Max", "max")):
    @query(f"focal_{_name}_wide", "grid fx1b0", """SELECT x, y, 0 AS band, CAST(v AS BIGINT) AS v
        FROM squares SEMI JOIN grid USING (x, y) WHERE v IS NOT NULL""",
           dense=_DENSE, lines=_LINES.format(fn=_fn), squares=_SQUARES.format(fn=_fn))
    def _(spark, sf, name=_name):
        return cells(rt.focal(fx1_cells(spark, sf), name, rt.Square(40)))


# each row of the circle is a difference of two running sums
@query("focal_Mean_wide", "grid fx1b0", """SELECT g.x, g.y, 0 AS band,
      round(sum(e.s - w.s) / sum(e.n - w.n), 6) AS v
    FROM grid g JOIN (SELECT unnest(range(-40, 41)) AS dy) o ON true
    JOIN sums e ON e.y = g.y + dy AND e.x = g.x + CAST(floor(sqrt(1600 - dy * dy)) AS BIGINT)
    JOIN sums w ON w.y = g.y + dy AND w.x = g.x - CAST(floor(sqrt(1600 - dy * dy)) AS BIGINT) - 1
    GROUP BY 1, 2 HAVING sum(e.n - w.n) > 0""", dense=_DENSE.replace("range(-40, 168)", "range(-41, 168)"), sums="""
    SELECT x, y, coalesce(sum(v) OVER q, 0) AS s, count(v) OVER q AS n FROM dense
    WINDOW q AS (PARTITION BY y ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def _(spark, sf):
    return rounded(cells(rt.focal(fx1_cells(spark, sf), "Mean", rt.Circle(40))))
