"""Geometry as tables: edges ``(geom_id, ring, x0, y0, x1, y1)`` and points ``(point_id, x, y)``.

A cell is inside a polygon when its centre is, by the even-odd rule; an edge crosses a row when
``y0 <= cy < y1``, so cells on shared borders count once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..model import Extent, Layout
from ..plans.joins import lookup_join

WORD = 32  # cells per mask word
EDGE_SCHEMA = "geom_id bigint, ring int, x0 double, y0 double, x1 double, y1 double"


def edges_from_rings(spark: SparkSession, geometries: dict[int, Sequence[Sequence]]) -> DataFrame:
    """Edge table from ``{geom_id: [ring, ..]}`` with rings as lists of (x, y), closed on demand."""
    rows = []
    for geom_id, rings in geometries.items():
        for n, ring in enumerate(rings):
            closed = list(ring) + ([ring[0]] if tuple(ring[0]) != tuple(ring[-1]) else [])
            rows += [(geom_id, n, float(a[0]), float(a[1]), float(b[0]), float(b[1]))
                     for a, b in zip(closed, closed[1:])]
    return spark.createDataFrame(rows, EDGE_SCHEMA)


def extent_edges(spark: SparkSession, extent: Extent, geom_id: int = 0) -> DataFrame:
    e = extent
    ring = [(e.xmin, e.ymin), (e.xmax, e.ymin), (e.xmax, e.ymax), (e.xmin, e.ymax)]
    return edges_from_rings(spark, {geom_id: [ring]})


def grid_edges(edges: DataFrame, layout: Layout) -> DataFrame:
    """Edges in cell coordinates of the layout (y south)."""
    gx0, gy0 = layout.to_grid(F.col("x0"), F.col("y0"))
    gx1, gy1 = layout.to_grid(F.col("x1"), F.col("y1"))
    return edges.select("geom_id", gx0.alias("x0"), gy0.alias("y0"), gx1.alias("x1"),
                        gy1.alias("y1"))


def explode_range(df: DataFrame, name: str, low: Column, high: Column) -> DataFrame:
    """One row per whole number from ``low`` to ``high`` inclusive; none when the range is empty."""
    return (df.withColumns({"_low": low.cast("bigint"), "_high": high.cast("bigint")})
            .where("_low <= _high")
            .withColumn(name, F.explode(F.sequence("_low", "_high"))).drop("_low", "_high"))


def polygon_spans(edges: DataFrame, layout: Layout) -> DataFrame:
    """Runs of inside cells ``[x0, x1)`` per (geom_id, y).

    Crossings at the same cell cancel in pairs before they are ordered, so what is ordered per
    (geometry, row) is bounded by the width of the grid, not by the number of edges.
    """
    g = grid_edges(edges, layout).where("y0 <> y1")
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    rows = explode_range(g, "y", F.greatest(F.ceil(low - 0.5), F.lit(0)),
                         F.least(F.ceil(high - 0.5) - 1, F.lit(layout.rows - 1)))
    cross = (F.col("x0") + (F.col("y") + 0.5 - F.col("y0")) * (F.col("x1") - F.col("x0"))
             / (F.col("y1") - F.col("y0")))
    first_cell = F.ceil(cross - 0.5)
    clipped = F.least(F.greatest(first_cell, F.lit(0)), F.lit(layout.cols)).cast("bigint")
    toggles = (rows.groupBy("geom_id", "y", clipped.alias("x"))
               .agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1"))
    w = Window.partitionBy("geom_id", "y").orderBy("x")
    return (toggles.select("geom_id", "y", "x", F.lead("x").over(w).alias("x1"),
                           F.row_number().over(w).alias("nth"))
            .where("nth % 2 = 1 and x1 is not null")
            .select("geom_id", "y", F.col("x").alias("x0"), "x1"))


def _word_rows(spans: DataFrame, layout: Layout, by_geometry: bool) -> DataFrame:
    """Spans as bit masks of ``WORD`` cells per (tile, row in tile), or-ed together.

    Masks of the same word combine before the shuffle; nothing is listed per group.
    """
    tc, tr = layout.tile_cols, layout.tile_rows
    parts = explode_range(spans, "col", F.floor(F.col("x0") / tc), F.floor((F.col("x1") - 1) / tc))
    parts = parts.select(
        "geom_id", F.col("col").cast("int"), F.floor(F.col("y") / tr).cast("int").alias("row"),
        (F.col("y") % tr).cast("int").alias("ry"),
        F.greatest(F.col("x0") - F.col("col") * tc, F.lit(0)).alias("a"),
        F.least(F.col("x1") - F.col("col") * tc, F.lit(tc)).alias("b"))
    words = explode_range(parts, "w", F.floor(F.col("a") / WORD), F.floor((F.col("b") - 1) / WORD))
    one = F.lit(1).cast("bigint")
    a = F.greatest(F.col("a") - F.col("w") * WORD, F.lit(0)).cast("int")
    b = F.least(F.col("b") - F.col("w") * WORD, F.lit(WORD)).cast("int")
    bits = F.call_function("shiftleft", one, b) - F.call_function("shiftleft", one, a)
    per_row = -(-tc // WORD)
    keys = (["geom_id"] if by_geometry else []) + ["col", "row"]
    return (words.select(*keys, (F.col("ry") * per_row + F.col("w")).cast("int").alias("i"),
                         bits.alias("bits"))
            .groupBy(*keys, "i").agg(F.bit_or("bits").alias("bits")))


def tile_masks(spans: DataFrame, layout: Layout, by_geometry: bool) -> DataFrame:
    """One mask per tile (and geometry): array of words, one bit per cell, rows padded to words."""
    from .shape import dense_array

    keys = (["geom_id"] if by_geometry else []) + ["col", "row"]
    n = layout.tile_rows * -(-layout.tile_cols // WORD)
    lists = (_word_rows(spans, layout, by_geometry)
             .groupBy(*keys)
             .agg(F.sort_array(F.collect_list(F.struct("i", F.col("bits").alias("v"))))
                  .alias("entries")))
    return lists.select(*keys, dense_array(F.col("entries"), n, "bigint").alias("mask"))


def mask_bytes(layout: Layout) -> int:
    return 64 + 8 * layout.tile_rows * -(-layout.tile_cols // WORD)


def in_mask(mask: Column, i: Column, layout: Layout) -> Column:
    """Whether cell ``i`` of a tile is set in its mask."""
    x, y = layout.place_of(i)
    at = y * -(-layout.tile_cols // WORD) + F.shiftright(x, 5)
    word = F.coalesce(F.get(mask, at.cast("int")), F.lit(0).cast("bigint"))
    return F.getbit(word, x.bitwiseAND(F.lit(WORD - 1)).cast("int")) == 1


def mask_cells(mask: Column, layout: Layout) -> Column:
    """A mask as an array of booleans, one per cell; linear in the cells."""
    per_row = -(-layout.tile_cols // WORD)

    def bits(word: Column, n: int) -> Column:
        known = F.coalesce(word, F.lit(0).cast("bigint"))
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda b: F.getbit(known, b) == 1)

    last = layout.tile_cols - (per_row - 1) * WORD
    if per_row == 1 or last == WORD:
        return F.flatten(F.transform(mask, lambda w: bits(w, last)))
    return F.flatten(F.transform(mask, lambda w, k: F.when(
        (k + 1) % per_row == 0, bits(w, last)).otherwise(bits(w, WORD))))


def _corners(geometry: DataFrame) -> list[Column]:
    xs, ys = (("x0", "x1"), ("y0", "y1")) if "x0" in geometry.columns else (("x",), ("y",))
    low = lambda names: F.least(*[F.min(c) for c in names]) if len(names) > 1 else F.min(names[0])
    high = lambda names: F.greatest(*[F.max(c) for c in names]) if len(names) > 1 else F.max(names[0])
    return [low(xs).alias("xmin"), low(ys).alias("ymin"), high(xs).alias("xmax"),
            high(ys).alias("ymax")]


def envelope(geometry: DataFrame) -> tuple[Extent | None, int]:
    """Bounding box and number of edges or points: one aggregate row, no box without geometry."""
    r = geometry.agg(*_corners(geometry), F.count(F.lit(1)).alias("n")).first()
    return (Extent(*r[:4]) if r["n"] else None), r["n"]


def tile_bound(edges: DataFrame, layout: Layout) -> tuple[Extent | None, int, int]:
    """Bounding box of all polygons, and upper bounds of the number of tiles they touch, all
    together and polygon by polygon, from the boxes of the polygons."""
    boxes = edges.groupBy("geom_id").agg(*_corners(edges))
    x0, y0 = layout.to_grid(F.col("xmin"), F.col("ymax"))
    x1, y1 = layout.to_grid(F.col("xmax"), F.col("ymin"))

    def span(a: Column, b: Column, size: int, most: int) -> Column:
        low = F.greatest(F.floor(a / size), F.lit(0))
        return F.greatest(F.least(F.floor(b / size), F.lit(most - 1)) - low + 1, F.lit(0))

    tiles = (span(x0, x1, layout.tile_cols, layout.layout_cols).cast("double")
             * span(y0, y1, layout.tile_rows, layout.layout_rows))
    r = boxes.agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax"), F.sum(tiles)).first()
    if r[0] is None:
        return None, 0, 0
    area = Extent(*r[:4])
    each, bounds = int(r[4]), layout.key_bounds(area)
    if bounds is None:
        return area, 0, each
    c0, r0, c1, r1 = bounds
    return area, min(each, (c1 - c0 + 2) * (r1 - r0 + 2)), each


def near(tiles: DataFrame, layout: Layout, area: Extent | None, cells: int = 1) -> DataFrame:
    """Tiles whose key lies in the area widened by some cells, as a predicate that can reach the
    scan, so that geometry in a corner of a layer reads that corner only."""
    if area is None:
        return tiles.where("false")
    dx, dy = cells * layout.cell_width, cells * layout.cell_height
    bounds = layout.key_bounds(Extent(area.xmin - dx, area.ymin - dy, area.xmax + dx, area.ymax + dy))
    if bounds is None:
        return tiles.where("false")
    c0, r0, c1, r1 = bounds
    return tiles.where(F.col("col").between(c0, c1) & F.col("row").between(r0, r1))


def segment_spans(edges: DataFrame, layout: Layout) -> DataFrame:
    """Runs of cells ``[x0, x1)`` that segments pass through, per segment and row: from the x where the
    segment enters the row to the x where it leaves."""
    g = grid_edges(edges, layout)
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    last = F.greatest(F.ceil(high) - 1, F.floor(low))
    rows = explode_range(g, "y", F.greatest(F.floor(low), F.lit(0)),
                         F.least(last, F.lit(layout.rows - 1)))
    dy = F.col("y1") - F.col("y0")

    def x_at(y: Column) -> Column:
        bounded = F.least(F.greatest(y, low), high)
        return F.col("x0") + (bounded - F.col("y0")) * (F.col("x1") - F.col("x0")) / dy

    enter = F.when(dy == 0, F.col("x0")).otherwise(x_at(F.col("y").cast("double")))
    leave = F.when(dy == 0, F.col("x1")).otherwise(x_at(F.col("y") + 1.0))
    rows = rows.select("geom_id", "y", F.least(enter, leave).alias("a"),
                       F.greatest(enter, leave).alias("b"))
    end = F.greatest(F.ceil("b") - 1, F.floor("a"))
    return rows.select("geom_id", "y", F.greatest(F.floor("a"), F.lit(0)).cast("bigint").alias("x0"),
                       (F.least(end, F.lit(layout.cols - 1)) + 1).cast("bigint").alias("x1")).where("x0 < x1")


def segment_cells(edges: DataFrame, layout: Layout) -> DataFrame:
    """Cells that segments pass through, as distinct (geom_id, x, y)."""
    spans = segment_spans(edges, layout)
    return explode_range(spans, "x", F.col("x0"), F.col("x1") - 1).select("geom_id", "x", "y").distinct()


#: Shares of a cell below this are rounding.
LEAST_SHARE = 1e-9


def _row_pieces(edges: DataFrame, layout: Layout) -> DataFrame:
    """Edges cut at the rows of the grid: (geom_id, ring, y, a, b, xa, xb, up), where ``a`` < ``b`` are heights
    within row y, xa and xb the places there, and ``up`` tells whether the edge runs along or against y."""
    gx0, gy0 = layout.to_grid(F.col("x0"), F.col("y0"))
    gx1, gy1 = layout.to_grid(F.col("x1"), F.col("y1"))
    g = edges.select("geom_id", "ring", gx0.alias("x0"), gy0.alias("y0"), gx1.alias("x1"), gy1.alias("y1")).where("y0 <> y1")
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    rows = explode_range(g, "y", F.greatest(F.floor(low), F.lit(0)), F.least(F.ceil(high) - 1, F.lit(layout.rows - 1)))
    a, b = F.greatest(low - F.col("y"), F.lit(0.0)), F.least(high - F.col("y"), F.lit(1.0))
    at = lambda h: F.col("x0") + (h - (F.col("y0") - F.col("y"))) * (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))
    return rows.select("geom_id", "ring", "y", a.alias("a"), b.alias("b"), at(a).alias("xa"), at(b).alias("xb"),
                       F.signum(F.col("y1") - F.col("y0")).alias("up")).where("a < b")


def _ring_sides(pieces: DataFrame) -> DataFrame:
    """(geom_id, ring, side): 1 where edges that run along y have the inside to their right, else -1. A
    ring inside an odd number of others is a hole; only pieces of its own polygon and of one row meet its point."""
    width = (F.col("xa") + F.col("xb")) / 2
    height = F.col("b") - F.col("a")
    rings = pieces.groupBy("geom_id", "ring").agg(
        F.sum(F.col("up") * width * height).alias("area"),
        F.max(F.struct(height.alias("h"), "y", ((F.col("a") + F.col("b")) / 2).alias("at"), width.alias("x"))).alias("point"))
    rings = rings.select("geom_id", F.col("ring").alias("own"), "area", "point.y", "point.at", "point.x")
    there = F.col("xa") + (F.col("at") - F.col("a")) * (F.col("xb") - F.col("xa")) / (F.col("b") - F.col("a"))
    around = (rings.join(pieces, ["geom_id", "y"])
              .where("own <> ring AND a <= at AND at < b").where(there < F.col("x"))
              .groupBy("geom_id", "own").agg(F.count("*").alias("n")))
    nested = F.when(F.coalesce("n", F.lit(0)) % 2 == 1, -1).otherwise(1)
    return rings.join(around, ["geom_id", "own"], "left").select(
        "geom_id", F.col("own").alias("ring"), (-F.signum("area") * nested).alias("side"))


def coverage_spans(edges: DataFrame, layout: Layout, by_geometry: bool = True) -> DataFrame:
    """Runs of cells ``[x0, x1)`` per (geom_id, y) and the ``share`` of each that the polygon covers, exact but
    for rounding; without ``by_geometry`` the sum of the shares of all polygons, per y.

    An edge adds to every cell the area to its right within the cell's row, positive where the inside
    begins and negative where it ends. That area changes only in the cells the edge passes through, so an edge is
    as many rows as it crosses cells, and the sums along a row are bounded by the width of the grid.
    Rings may run either way round but must not cross each other or themselves.
    """
    pieces = _row_pieces(edges, layout)
    signed = lookup_join(pieces, _ring_sides(pieces), ["geom_id", "ring"], spread_by=["y"])
    first = F.greatest(F.floor(F.least("xa", "xb")), F.lit(0))
    last = F.least(F.greatest(F.ceil(F.greatest("xa", "xb")), first), F.lit(layout.cols - 1))
    steps = explode_range(signed.withColumn("first", first), "x", F.col("first"), last)

    def right(c: Column) -> Column:
        """Mean width of cell ``c`` that lies right of the piece."""
        u, v = c + 1 - F.col("xa"), c + 1 - F.col("xb")
        held = lambda w: F.least(F.greatest(w, F.lit(0.0)), F.lit(1.0))
        summed = lambda w: held(w) * held(w) / 2 + F.greatest(w - 1, F.lit(0.0))
        return F.when(F.abs(u - v) < 1e-6, (held(u) + held(v)) / 2).otherwise((summed(u) - summed(v)) / (u - v))

    before = F.when(F.col("x") > F.col("first"), right(F.col("x") - 1)).otherwise(0.0)
    step = F.col("side") * F.col("up") * (F.col("b") - F.col("a")) * (right(F.col("x")) - before)
    keys = ["geom_id", "y"] if by_geometry else ["y"]
    changes = steps.groupBy(*keys, "x").agg(F.sum(step).alias("step"))
    w = Window.partitionBy(*keys).orderBy("x")
    share = F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (changes.select(*keys, F.col("x").alias("x0"), F.lead("x", 1, layout.cols).over(w).alias("x1"),
                           (F.least(share, F.lit(1.0)) if by_geometry else share).alias("share"))
            .where(F.col("share") > LEAST_SHARE))


def tile_shares(spans: DataFrame, layout: Layout, by_geometry: bool = True) -> DataFrame:
    """One row per tile (and geometry): ``shares``, an array of (i, n, share), runs of ``n`` cells from cell ``i``
    on within one row of the tile, in order; no more than the tile has cells."""
    tc, tr = layout.tile_cols, layout.tile_rows
    keys = (["geom_id"] if by_geometry else []) + ["col", "row"]
    parts = explode_range(spans, "col", F.floor(F.col("x0") / tc), F.floor((F.col("x1") - 1) / tc))
    left = F.greatest(F.col("x0") - F.col("col") * tc, F.lit(0))
    end = F.least(F.col("x1") - F.col("col") * tc, F.lit(tc))
    run = F.struct(((F.col("y") % tr) * tc + left).cast("int").alias("i"), (end - left).cast("int").alias("n"), "share")
    return (parts.withColumn("row", F.floor(F.col("y") / tr).cast("int")).withColumn("run", run)
            .withColumn("col", F.col("col").cast("int"))
            .groupBy(*keys).agg(F.sort_array(F.collect_list("run")).alias("shares")))


def tile_layout(layout: Layout) -> Layout:
    """The layout seen with one cell per tile."""
    return Layout(layout.extent, layout.layout_cols, layout.layout_rows, 1, 1)


def tiles_for_geometry(edges: DataFrame, layout: Layout) -> DataFrame:
    """Tile keys a polygon touches: an edge passes through, or the tile's centre is inside."""
    coarse = tile_layout(layout)
    spans = polygon_spans(edges, coarse)
    inside = explode_range(spans, "x", F.col("x0"), F.col("x1") - 1).select("geom_id", "x", "y")
    both = inside.unionByName(segment_cells(edges, coarse)).distinct()
    return both.select("geom_id", F.col("x").cast("int").alias("col"),
                       F.col("y").cast("int").alias("row"))


def tiles_for_points(points: DataFrame, layout: Layout) -> DataFrame:
    """Tile keys that hold points."""
    x, y = tile_layout(layout).cell_of(F.col("x"), F.col("y"))
    inside = x.between(0, layout.layout_cols - 1) & y.between(0, layout.layout_rows - 1)
    return (points.where(inside)
            .select(x.cast("int").alias("col"), y.cast("int").alias("row")).distinct())
