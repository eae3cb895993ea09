"""Distance to the nearest source, exact, by a descent through two quadtrees.

Target cells and source points are nodes of quadtrees with the same origin. From the root on, each
target node keeps the source nodes that can hold the nearest source of some point in it: those
whose smallest distance does not exceed the best guaranteed distance of any kept node. Nodes then
split in four, and so on down to single cells. Each step is a join on the source node and a window
minimum per target node; a target node has few candidates at any level, so no step pairs all
sources with all cells. The descent stops at blocks of 32 x 32 cells: a block and the points of its
few candidates are compared as arrays. Where some block-sized node holds thousands of points, it goes on
to single cells, and source nodes split below the cell size until none holds many points, so that a
crowded cell costs no more than others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import CellType, Layer, Layout, Meta
from ..plans.joins import BROADCAST_BYTES, salted_join, split_join
from ..plans.lineage import run_folder, through_table
from .geometry import polygon_spans, segment_cells

NODE_POINTS = 32
#: Level of the blocks that are compared as arrays (2^5 cells a side), and points of a node at most there.
BLOCK_LEVEL = 5
BLOCK_POINTS = 4096
#: Blocks along a side of the squares that a node's points are sent to, and squares that one task sends them to.
SQUARE = 8
HOT_SQUARES = 4096
NODE_BYTES = 96
DEEPEST = -40
SLACK = 1 + 1e-9


def _node(name: str, level: int) -> Column:
    """Quadtree index of a grid coordinate; ``level`` is log2 of the node size in cells."""
    return F.floor(F.col(name) * F.lit(2.0 ** -level)).cast("bigint")


def _nodes(points: DataFrame, level: int) -> DataFrame:
    """Occupied source nodes of a level with their tight boxes in map units."""
    return (points.groupBy(_node("gx", level).alias("sx"), _node("gy", level).alias("sy"))
            .agg(F.min("mx").alias("bx0"), F.max("mx").alias("bx1"),
                 F.min("my").alias("by0"), F.max("my").alias("by1"),
                 F.count(F.lit(1)).alias("n")))


def _gap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(b0 - a1, a0 - b1, F.lit(0.0))


def _span(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.abs(b1 - a0), F.abs(a1 - b0))


def cell_centres(layout: Layout, polygons: DataFrame | None,
                 lines: DataFrame | None) -> DataFrame:
    """Centres of the cells that polygons hold or lines cross, as points."""
    parts = []
    if polygons is not None:
        spans = polygon_spans(polygons, layout)
        parts.append(spans.select(F.explode(F.sequence("x0", F.col("x1") - 1)).alias("x"), "y"))
    if lines is not None:
        parts.append(segment_cells(lines, layout).select("x", "y"))
    cells = reduce(DataFrame.unionByName, parts).distinct()
    x, y = layout.centre_of(F.col("x"), F.col("y"))
    return cells.select(x.alias("x"), y.alias("y"))


def euclidean_distance(layout: Layout, epsg: int, points: DataFrame | None = None,
                       polygons: DataFrame | None = None, lines: DataFrame | None = None,
                       zoom: int | None = None) -> Layer:
    """Cells with the distance, in map units, from their centre to the nearest source.

    Sources are points as given, or the centres of the cells that polygons hold or lines cross.
    The result covers the tiles of the sources' envelope.
    """
    if (points is None) == (polygons is None and lines is None):
        raise ValueError("give points, or polygons and lines")
    sources = points if points is not None else cell_centres(layout, polygons, lines)
    spark = sources.sparkSession
    gx, gy = layout.to_grid(F.col("x"), F.col("y"))
    cw, ch = layout.cell_width, layout.cell_height
    folder = run_folder(spark, "distance")
    placed = through_table(sources.select(gx.alias("gx"), gy.alias("gy")).distinct(),
                           f"{folder}/sources")
    found = placed.agg(F.count(F.lit(1)), F.min("gx"), F.min("gy"), F.max("gx"), F.max("gy")).first()
    meta = Meta(CellType.parse("float64"), layout, epsg, 1, zoom=zoom)
    if not found[0]:
        empty = spark.createDataFrame([], "x bigint, y bigint, band int, v double")
        return Layer(empty, meta, "cell")
    n, lo_x, lo_y, hi_x, hi_y = found
    # tiles from the one of the smallest to the one of the largest source, as far as there are tiles
    tile = lambda v, size, most: min(max(math.floor(v / size), 0), most - 1)
    c0, c1 = (tile(v, layout.tile_cols, layout.layout_cols) for v in (lo_x, hi_x))
    r0, r1 = (tile(v, layout.tile_rows, layout.layout_rows) for v in (lo_y, hi_y))
    tx0, ty0 = c0 * layout.tile_cols, r0 * layout.tile_rows
    tx1, ty1 = (c1 + 1) * layout.tile_cols, (r1 + 1) * layout.tile_rows
    ox, oy = min(tx0, math.floor(lo_x)), min(ty0, math.floor(lo_y))
    across = max(tx1, math.floor(hi_x) + 1) - ox, max(ty1, math.floor(hi_y) + 1) - oy
    level = max(across).bit_length()
    base = placed.select((F.col("gx") - ox).alias("gx"), (F.col("gy") - oy).alias("gy"),
                         ((F.col("gx") - ox) * cw).alias("mx"),
                         ((F.col("gy") - oy) * ch).alias("my"))

    block = min(BLOCK_LEVEL, level - 1)
    as_arrays = block > 0 and _nodes(base, block).agg(F.max("n")).first()[0] <= BLOCK_POINTS
    lowest = block if as_arrays else 0
    while not as_arrays and lowest > DEEPEST and _nodes(base, lowest).agg(F.max("n")).first()[0] > NODE_POINTS:
        lowest -= 2

    pairs = spark.range(1).select(*[F.lit(0).cast("bigint").alias(c)
                                    for c in ("tx", "ty", "sx", "sy")])
    # the highest level with enough target nodes to keep all tasks busy
    wide, high = tx1 - tx0, ty1 - ty0
    many = 16 * spark.sparkContext.defaultParallelism
    spread_at = next((k for k in range(level - 1, 0, -1)
                      if (-(-wide // 2 ** k)) * (-(-high // 2 ** k)) >= many), 1)
    while level > lowest:
        level -= 1
        if level >= 0:
            step = F.sequence(F.lit(0), F.lit(1))
            pairs = (pairs.withColumn("_i", F.explode(step)).withColumn("_j", F.explode(step))
                     .withColumns({"tx": F.col("tx") * 2 + F.col("_i"),
                                   "ty": F.col("ty") * 2 + F.col("_j")}).drop("_i", "_j"))
            size = 2.0 ** level
            pairs = pairs.where((F.col("tx") * size < tx1 - ox) & (F.col("ty") * size < ty1 - oy)
                                & ((F.col("tx") + 1) * size > tx0 - ox)
                                & ((F.col("ty") + 1) * size > ty0 - oy))
        # children of the source node that exist, by join on the parent
        children = _nodes(base, level).drop("n")
        children = children.withColumns({"px": F.floor(F.col("sx") / 2).cast("bigint"),
                                         "py": F.floor(F.col("sy") / 2).cast("bigint")})
        # of one level there are no more nodes than the sources' box has room for
        bound = min(n, math.prod(math.floor((v - o) / 2.0 ** level) - math.floor((u - o) / 2.0 ** level) + 1
                                 for u, v, o in ((lo_x, hi_x, ox), (lo_y, hi_y, oy))))
        small = bound * NODE_BYTES <= BROADCAST_BYTES
        pairs = pairs.withColumnsRenamed({"sx": "px", "sy": "py"})
        # one source may be the candidate of any share of the targets, hence the salt
        pairs = (pairs.join(F.broadcast(children), ["px", "py"]) if small else
                 salted_join(pairs, children, ["px", "py"], ["tx", "ty"])).drop("px", "py")
        if level > 0:
            t = (F.col("tx") * (size * cw), (F.col("tx") + 1) * (size * cw),
                 F.col("ty") * (size * ch), (F.col("ty") + 1) * (size * ch))
        else:
            mx, my = (F.col("tx") + 0.5) * cw, (F.col("ty") + 0.5) * ch
            t = (mx, mx, my, my)
        near = F.pow(_gap(t[0], t[1], F.col("bx0"), F.col("bx1")), F.lit(2.0)) + F.pow(
            _gap(t[2], t[3], F.col("by0"), F.col("by1")), F.lit(2.0))
        far = F.pow(_span(t[0], t[1], F.col("bx0"), F.col("bx1")), F.lit(2.0)) + F.pow(
            _span(t[2], t[3], F.col("by0"), F.col("by1")), F.lit(2.0))
        pairs = pairs.select(*[c for c in ("ax", "ay") if c in pairs.columns],
                             "tx", "ty", "sx", "sy", near.alias("near"), far.alias("far"))
        if level == spread_at:
            # from here on targets stay in the partition of their ancestor at this level
            pairs = pairs.withColumns({"ax": F.col("tx"), "ay": F.col("ty")})
        keys = [c for c in ("ax", "ay") if c in pairs.columns]
        if small and keys and level == spread_at:
            pairs = pairs.repartition(*keys)
        best = F.min("far").over(Window.partitionBy(*keys, "tx", "ty"))
        pairs = (pairs.withColumn("best", best).where(F.col("near") <= F.col("best") * SLACK)
                 .drop("near", "far", "best"))
    if as_arrays:
        inside = (tx0 - ox, ty0 - oy, tx1 - ox, ty1 - oy)
        cells = _block_cells(pairs, base, block, n, (cw, ch), inside, f"{folder}/pairs")
        return Layer(cells.select((F.col("x") + ox).alias("x"), (F.col("y") + oy).alias("y"), F.lit(0).alias("band"), "v"),
                     meta, "cell")
    leaves = base.select(_node("gx", level).alias("sx"), _node("gy", level).alias("sy"),
                         "mx", "my")
    d = F.hypot((F.col("tx") + 0.5) * cw - F.col("mx"), (F.col("ty") + 0.5) * ch - F.col("my"))
    keys = [c for c in ("ax", "ay") if c in pairs.columns]
    found = (pairs.join(F.broadcast(leaves), ["sx", "sy"]) if n * 32 <= BROADCAST_BYTES else
             salted_join(pairs, leaves, ["sx", "sy"], ["tx", "ty"]))
    nearest = (found.withColumn("d", d)
               .groupBy(*keys, "tx", "ty").agg(F.min("d").alias("v")))
    cells = nearest.select((F.col("tx") + ox).alias("x"), (F.col("ty") + oy).alias("y"),
                           F.lit(0).alias("band"), "v")
    return Layer(cells, meta, "cell")


def _block_cells(pairs: DataFrame, points: DataFrame, level: int, n: int, size: tuple[float, float],
                 inside: tuple[int, int, int, int], path: str) -> DataFrame:
    """(x, y, v) of the cells of target blocks, from the points of their candidate nodes.

    A block's candidates stream by in one task, and one array of least distances is held. A node has
    BLOCK_POINTS points at most. Where there are too many points to broadcast, a node's points travel once
    to each square of SQUARE x SQUARE blocks that has it as a candidate, and not to every block.
    """
    packed = points.groupBy(_node("gx", level).alias("sx"), _node("gy", level).alias("sy")).agg(
        F.collect_list("mx").alias("px"), F.collect_list("my").alias("py"))
    keys = [c for c in ("ax", "ay") if c in pairs.columns]
    side, (cw, ch), (x0, y0, x1, y1) = 1 << level, size, inside

    def run(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        """Cells from (target node, xs, ys) in the order of targets."""
        last, best, mx, my, done = None, None, None, None, []

        def finished() -> None:
            gx, gy = np.meshgrid(np.arange(side) + last[0] * side, np.arange(side) + last[1] * side)
            ok = (gx >= x0) & (gx < x1) & (gy >= y0) & (gy < y1)
            done.append((gx[ok], gy[ok], np.sqrt(best[ok])))

        def passed_on() -> pa.RecordBatch:
            columns = [pa.array(np.concatenate(c)) for c in zip(*done)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, ["x", "y", "v"])

        for key, xs, ys in found:
            if key != last:
                if last is not None:
                    finished()
                    if len(done) >= 64:
                        yield passed_on()
                last, best = key, np.full((side, side), np.inf)
                mx = ((np.arange(side) + key[0] * side) + 0.5) * cw
                my = ((np.arange(side) + key[1] * side) + 0.5) * ch
            for at in range(0, len(xs), 256):
                dx = (mx[:, None] - xs[at:at + 256]) ** 2
                dy = (my[:, None] - ys[at:at + 256]) ** 2
                np.minimum(best, (dy[:, None, :] + dx[None, :, :]).min(axis=2), out=best)
        if last is not None:
            finished()
            yield passed_on()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            targets = zip(batch.column("tx").to_pylist(), batch.column("ty").to_pylist())
            px, py = batch.column("px"), batch.column("py")
            xs, ys, ends = px.values.to_numpy(), py.values.to_numpy(), px.offsets.to_numpy()
            for key, a, b in zip(targets, ends, ends[1:]):
                yield key, xs[a:b], ys[a:b]

    def looked_up(nodes: pa.Table, lists: pa.Table) -> Iterator[tuple]:
        lists, nodes = lists.combine_chunks(), nodes.sort_by([("tx", "ascending"), ("ty", "ascending")])
        place = {key: k for k, key in enumerate(zip(*(lists.column(c).to_pylist() for c in ("its_sx", "its_sy"))))}
        px, py = (lists.column(c).chunk(0) for c in ("its_px", "its_py"))
        xs, ys, ends = px.values.to_numpy(), py.values.to_numpy(), px.offsets.to_numpy()
        for tx, ty, *node in zip(*(nodes.column(c).to_pylist() for c in ("tx", "ty", "sx", "sy"))):
            k = place[tuple(node)]
            yield (tx, ty), xs[ends[k]:ends[k + 1]], ys[ends[k]:ends[k + 1]]

    schema = "x bigint, y bigint, v double"
    if n * 32 <= BROADCAST_BYTES:
        met = pairs.join(F.broadcast(packed), ["sx", "sy"])
        met = met if keys else met.repartition("tx", "ty")
        ordered = met.select("tx", "ty", "px", "py").sortWithinPartitions("tx", "ty")
        return ordered.mapInArrow(lambda batches: run(listed(batches)), schema)
    square = [F.floor(F.col(t) / SQUARE).alias(a) for t, a in (("tx", "ax"), ("ty", "ay"))]
    pairs = through_table(pairs.select(*square, "tx", "ty", "sx", "sy"), path)
    wanted = pairs.select("ax", "ay", "sx", "sy").distinct()
    carried = split_join(wanted, packed, ["sx", "sy"], "inner", ["ax", "ay"], hot_rows=HOT_SQUARES)
    # names of its own: both sides of a cogroup come from one table
    carried = carried.toDF(*[f"its_{c}" for c in carried.columns])
    return pairs.groupBy("ax", "ay").cogroup(carried.groupBy("its_ax", "its_ay")).applyInArrow(
        lambda nodes, lists: pa.Table.from_batches(run(looked_up(nodes, lists)), pa.schema(
            [("x", pa.int64()), ("y", pa.int64()), ("v", pa.float64())])), schema)
