"""Registry of the driver's queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Named table texts an oracle may use; they are put in front of it as needed.
PARTS = {
    "fx1": fx.FX1,
    "fx1b0": "SELECT x, y, v FROM fx1 WHERE band = 0",
    "fx2": fx.FX2,
    "fx3": fx.FX3,
    "fx5": fx.FX5,
    "pt1": fx.PT1,
    "geo": fx.GEO,
    # cells of the tiles that hold any data
    "grid": """SELECT tx * 16 + i AS x, ty * 16 + j AS y
        FROM (SELECT DISTINCT x // 16 AS tx, y // 16 AS ty FROM fx1) t,
             (SELECT unnest(range(0, 16)) AS i) a, (SELECT unnest(range(0, 16)) AS j) b""",
    # cells of fx1 inside each geometry: an odd number of crossings to the west
    "inside": """SELECT e.geom_id, c.x, c.y
        FROM (SELECT DISTINCT x, y FROM fx1) c
        JOIN geo e ON c.y + 0.5 >= least(e.y0, e.y1) AND c.y + 0.5 < greatest(e.y0, e.y1)
        WHERE e.x0 + (c.y + 0.5 - e.y0) * (e.x1 - e.x0) / (e.y1 - e.y0) <= c.x + 0.5
        GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1""",
    # the same over all cells of the layout rows the geometries reach
    "inside_all": """SELECT e.geom_id, c.x, e.y
        FROM (SELECT g.*, unnest(range(CAST(floor(least(y0, y1)) AS BIGINT),
                                       CAST(ceil(greatest(y0, y1)) AS BIGINT))) AS y FROM geo g) e,
             (SELECT unnest(range(0, 128)) AS x) c
        WHERE e.y + 0.5 >= least(e.y0, e.y1) AND e.y + 0.5 < greatest(e.y0, e.y1)
          AND e.x0 + (e.y + 0.5 - e.y0) * (e.x1 - e.x0) / (e.y1 - e.y0) <= c.x + 0.5
        GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1""",
    # the share of each cell that a geometry covers: a row cut at all corners, edges in each slab in turn
    # entering and leaving, and the mean width of the cell right of each edge
    "covered": """SELECT geom_id, x, y, share FROM (
        SELECT geom_id, x, y, sum(sign * h * CASE WHEN abs(u - v) < 1e-6 THEN
            (least(greatest(u, 0), 1) + least(greatest(v, 0), 1)) / 2 ELSE (
              CASE WHEN u <= 0 THEN 0 WHEN u <= 1 THEN u * u / 2 ELSE u - 0.5 END
              - CASE WHEN v <= 0 THEN 0 WHEN v <= 1 THEN v * v / 2 ELSE v - 0.5 END) / (u - v) END) AS share
        FROM (SELECT geom_id, y, h, c.x, c.x + 1 - xa AS u, c.x + 1 - xb AS v, CASE WHEN row_number() OVER (
                PARTITION BY geom_id, lo, c.x ORDER BY xa + xb) % 2 = 1 THEN 1 ELSE -1 END AS sign
          FROM (SELECT s.geom_id, s.y, s.lo, s.hi - s.lo AS h, e.x0 + (s.lo - e.y0) * (e.x1 - e.x0) / (e.y1 - e.y0) AS xa,
                  e.x0 + (s.hi - e.y0) * (e.x1 - e.x0) / (e.y1 - e.y0) AS xb
            FROM (SELECT geom_id, floor(lo) AS y, lo, lead(lo) OVER (PARTITION BY geom_id ORDER BY lo) AS hi FROM (
                SELECT geom_id, y0 AS lo FROM geo UNION SELECT geom_id, unnest(range(CAST(floor(min(y0)) AS BIGINT),
                  CAST(ceil(max(y0)) AS BIGINT) + 1)) FROM geo GROUP BY geom_id) b) s
            JOIN geo e ON e.geom_id = s.geom_id AND e.y0 <> e.y1
              AND least(e.y0, e.y1) <= s.lo AND greatest(e.y0, e.y1) >= s.hi) t,
            (SELECT unnest(range(0, 128)) AS x) c) p
        GROUP BY 1, 2, 3) q WHERE share > 1e-9""",
    "fx5m": "SELECT x, y, arg_min(v, priority) AS v FROM fx5 GROUP BY 1, 2",
}
NEEDS = {"fx1b0": ("fx1",), "grid": ("fx1",), "inside": ("fx1", "geo"), "inside_all": ("geo",), "covered": ("geo",),
         "fx5m": ("fx5",)}


def with_parts(names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """SQL text with the named parts in front, each once, dependencies first."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, ()):
            add(need)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    ctes = [f"{name} AS ({PARTS[name]})" for name in order]
    ctes += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    if ctes and body.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {', '.join(ctes)}, {body.removeprefix('WITH RECURSIVE ')}"
    return f"WITH {', '.join(ctes)} {body}" if ctes else body


def query(name: str, parts: str | None = None, sql: str | None = None, **extra: str):
    """Register a query, with its oracle when ``sql`` is given."""
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_parts(parts or "", sql, extra)
        return fn
    return keep
