"""Resampling: retile, resize, reproject, stitch and pyramid.

Source blocks (tiles or scenes) work out their part of the target tiles they reach as arrays, and one
shuffle brings the parts together (``scatter``). Mode and Median count values per target cell instead.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import projection, stencils
from ..functions.kernels import AGGREGATES
from ..model import (CellType, Extent, GlobalLayout, Layer, Layout, LocalLayout, Meta,
                     global_level)
from ..plans.lineage import run_folder, through_table
from .focal import nullable_lists, padded_windows
from .fold import fold_tiles, shared_bands, unflatten
from .scatter import scattered
from .shape import to_cells, to_tiles, unnest

# The ten method names.
METHODS = ("NearestNeighbor", "Bilinear", "CubicConvolution", "CubicSpline", "Lanczos",
           "Average", "Mode", "Median", "Max", "Min")
# Methods whose results are values of the source.
SELECTING = ("NearestNeighbor", "Mode", "Max", "Min")

def _blocks(layer: Layer) -> tuple[DataFrame, list[str]]:
    """Source blocks and the columns that tell their results apart."""
    instant = ["instant"] if layer.meta.temporal else []
    if layer.kind == "scene":
        df = layer.df.select(
            F.col("scene_id").alias("priority"), *instant, "bands", "cols", "rows",
            F.lit(0).cast("bigint").alias("ox"), F.lit(0).cast("bigint").alias("oy"),
            F.col("xmin").alias("left"), F.col("ymax").alias("top"),
            ((F.col("xmax") - F.col("xmin")) / F.col("cols")).alias("cw"),
            ((F.col("ymax") - F.col("ymin")) / F.col("rows")).alias("ch"))
        return df, ["priority", *instant]
    at = layer.meta.layout
    df = to_tiles(layer).df.select(
        *instant, "bands", F.lit(at.tile_cols).alias("cols"), F.lit(at.tile_rows).alias("rows"),
        (F.col("col").cast("bigint") * at.tile_cols).alias("ox"),
        (F.col("row").cast("bigint") * at.tile_rows).alias("oy"),
        F.lit(at.extent.xmin).alias("left"), F.lit(at.extent.ymax).alias("top"),
        F.lit(at.cell_width).alias("cw"), F.lit(at.cell_height).alias("ch"))
    return df, instant


def _aggregated(blocks, ids, target, warp, method: str) -> DataFrame:
    """Aggregating methods: every source cell belongs to the target cell its centre falls in."""
    keep = [*ids, "cols", "ox", "oy", "left", "top", "cw", "ch"]
    rows = unnest(blocks, keep, "bands", "band", "cells")
    rows = unnest(rows, [*keep, "band"], "cells", "i", "v").where(F.col("v").isNotNull())
    sx = F.col("left") + (F.col("ox") + F.col("i") % F.col("cols") + 0.5) * F.col("cw")
    sy = F.col("top") - (F.col("oy") + F.floor(F.col("i") / F.col("cols")) + 0.5) * F.col("ch")
    rows = projection.with_transformed(rows, sx, sy, *warp, ("_tx", "_ty"))
    x, y = target.cell_of(F.col("_tx"), F.col("_ty"))
    placed = rows.select(*ids, x.alias("x"), y.alias("y"), "band", "v").where(
        F.col("x").between(0, target.cols - 1) & F.col("y").between(0, target.rows - 1))
    return aggregate_cells(placed, [*ids, "x", "y", "band"], method)


def aggregate_cells(cells: DataFrame, keys: list[str], method: str) -> DataFrame:
    """Average, Mode (ties: smallest), Median (mean of the middle two), Max or Min of ``v``.

    Mode and Median count equal values first, so equal values travel once.
    """
    simple = {"Average": F.avg, "Max": F.max, "Min": F.min}
    if method in simple:
        return cells.groupBy(*keys).agg(simple[method]("v").alias("v"))
    counted = cells.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))
    if method == "Mode":
        return counted.groupBy(*keys).agg(
            F.max_by("v", F.struct(F.col("n"), -F.col("v"))).alias("v"))
    if method == "Median":
        return counted.groupBy(*keys).agg(F.expr("percentile(v, 0.5, n)").alias("v"))
    raise ValueError(f"unknown method {method!r}")


def _shift(source: Layout, target: Layout) -> tuple[int, int] | None:
    """Whole cells between the origins of two grids of the same cell size, if that is what they
    are."""
    w, h = source.cell_width, source.cell_height
    dx = (source.extent.xmin - target.extent.xmin) / w
    dy = (target.extent.ymax - source.extent.ymax) / h
    same = (math.isclose(w, target.cell_width, rel_tol=1e-12)
            and math.isclose(h, target.cell_height, rel_tol=1e-12))
    whole = abs(dx - round(dx)) < 1e-6 and abs(dy - round(dy)) < 1e-6
    return (round(dx), round(dy)) if same and whole else None


def unique_keys(layer: Layer) -> Layer:
    """A tile layer whose tiles of equal key are merged: lowest ``priority`` first where the layer
    has that column, then the smaller value. Only keys are read where none repeats."""
    keys, meta = layer.keys, layer.meta
    if layer.kind != "tile" or layer.df.groupBy(*keys).count().where("count > 1").isEmpty():
        return layer
    rank = F.col("priority") if "priority" in layer.df.columns else F.lit(0)
    n, number = meta.layout.tile_cells, meta.cell_type.compute_type
    folded = fold_tiles(layer.df, keys, F.flatten("bands"), n * meta.bands, "First", number, rank)
    return layer.with_df(folded.select(*keys, shared_bands(n, meta.cell_type.compute_type).alias("bands")))


def _with_data(keys: pa.RecordBatch, flat: np.ndarray) -> pa.RecordBatch:
    """Tiles with any data, by key. On every path a tile of nothing but NoData is no row."""
    some = ~np.isnan(flat).all(axis=1)
    kept = keys.filter(pa.array(some))
    return pa.RecordBatch.from_arrays([*kept.columns, nullable_lists(flat[some])], [*kept.schema.names, "flat"])


def _scatter(layer: Layer, target: Layout, method: str, warp: tuple[int, int] = (0, 0)) -> Layer:
    """``layer`` on another grid. Overlapping scenes: the lowest scene_id wins, then the smaller value."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}")
    kind = layer.meta.cell_type if method in SELECTING else CellType.parse("float64")
    if layer.kind == "cell":
        layer = to_tiles(layer)
    if layer.kind == "tile" and warp[0] == warp[1] and method != "CubicSpline" and _shift(layer.meta.layout, target):
        method = "NearestNeighbor"  # every cell is its own value, by any method that does not smooth
    if method != "NearestNeighbor":
        layer = unique_keys(layer)
    if method in ("Mode", "Median"):
        return _counted(layer, target, warp, method, kind)
    out = scattered(layer, target, method, kind, warp)
    if out.meta.layout == target:
        return out
    cells = to_cells(out)  # a target tile too large to be held
    return cells.with_df(cells.df.where((F.col("x") < target.cols) & (F.col("y") < target.rows)), layout=target)


def _counted(layer: Layer, target: Layout, warp: tuple[int, int], method: str, kind: CellType) -> Layer:
    """Mode and Median: values travel counted, as cells."""
    blocks, ids = _blocks(layer)
    cells = _aggregated(blocks, ids, target, warp, method)
    if layer.kind == "scene":
        keys = [k for k in ids if k != "priority"]
        cells = (cells.groupBy("x", "y", *keys, "band")
                 .agg(F.min_by("v", F.struct("priority", "v")).alias("v")))
    instant = ["instant"] if layer.meta.temporal else []
    cells = cells.select("x", "y", *instant, "band", F.col("v").cast(kind.compute_type))
    return layer.with_df(cells, "cell", layout=target, cell_type=kind, bounds=None)


def resample(layer: Layer, layout: Layout, method: str = "NearestNeighbor") -> Layer:
    """The layer on another grid of the same CRS: as tiles, by Mode and Median as cells."""
    return _scatter(layer, layout, method)


def single_epsg(layer: Layer) -> int:
    """The one CRS of a layer; scenes with several raise an error."""
    if layer.kind != "scene":
        return layer.meta.epsg
    found = [r[0] for r in layer.base.select("epsg").distinct().limit(2).collect()]
    if len(found) != 1:
        raise ValueError(f"exactly one CRS expected, found {found}")
    return found[0]


def source_grid(layer: Layer) -> tuple[Extent, tuple[float, float]]:
    """Extent and smallest cell size: one aggregate row of scenes, metadata of tiles."""
    if layer.kind != "scene":
        at = layer.meta.layout
        return layer.meta.extent or at.extent, (at.cell_width, at.cell_height)
    cw = (F.col("xmax") - F.col("xmin")) / F.col("cols")
    ch = (F.col("ymax") - F.col("ymin")) / F.col("rows")
    r = layer.base.agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax"),
                       F.min_by(F.struct(cw.alias("w"), ch.alias("h")), cw * ch)).first()
    return Extent(*r[:4]), (r[4]["w"], r[4]["h"])


def layout_for(layer: Layer, wanted: Layout | LocalLayout | GlobalLayout | Meta,
               epsg: int) -> tuple[Layout, int | None]:
    """Layout and zoom from a layout, a layout type or another layer's metadata."""
    if isinstance(wanted, Layout):
        return wanted, None
    if isinstance(wanted, Meta):
        return wanted.layout, wanted.zoom
    extent, size = source_grid(layer)
    return wanted.layout_for(epsg, extent, size)


def tile_to_layout(layer: Layer, layout, method: str = "NearestNeighbor",
                   zoom: int | None = None) -> Layer:
    """Scenes or tiles cut onto a tile grid: by layout, layout type or metadata.

    Tiles without any data are left out. Tiles of equal key are merged first (``unique_keys``).
    """
    epsg = single_epsg(layer)
    target, found = layout_for(layer, layout, epsg)
    placed = _scatter(layer, target, method)
    return to_tiles(placed.with_df(placed.df, epsg=epsg, zoom=zoom if zoom is not None else found))


def reproject(layer: Layer, epsg: int, layout=None, method: str = "NearestNeighbor") -> Layer:
    """The layer in another CRS.

    Inverse mapping: each source block finds the target tiles that its envelope, sampled and widened by
    a bound on its bulge, covers, and looks their cells' centres up in itself. ``layout`` may be a layout or a layout type; without one, local
    256-cell tiles at about the source resolution are used.
    """
    source = single_epsg(layer)
    if isinstance(layout, Layout):
        target, zoom = layout, None
    else:
        wanted = layout or LocalLayout(256)
        extent, size = source_grid(layer)
        moved = projection.transform_extent(extent, source, epsg)
        # keep the number of cells along the diagonal
        cells = ((extent.width / size[0]) ** 2 + (extent.height / size[1]) ** 2) ** 0.5
        step = (moved.width ** 2 + moved.height ** 2) ** 0.5 / cells
        target, zoom = wanted.layout_for(epsg, moved, (step, step))
    out = _scatter(layer, target, method, (source, epsg))
    return to_tiles(out.with_df(out.df, epsg=epsg, zoom=zoom, extent=None))


def stitch_cells(layer: Layer, extent: Extent | None = None, cols: int | None = None,
                 rows: int | None = None, method: str = "NearestNeighbor") -> Layer:
    """The layer as one raster of ``cols`` x ``rows`` cells over the extent, as distributed cells."""
    at = layer.meta.layout
    extent = extent or layer.meta.extent or at.extent
    cols = cols or max(1, round(extent.width / at.cell_width))
    rows = rows or max(1, round(extent.height / at.cell_height))
    return _scatter(layer, Layout(extent, 1, 1, cols, rows), method)


def resample_to_power_of_two(layer: Layer, col_power: int, row_power: int,
                             method: str = "NearestNeighbor") -> Layer:
    """Every tile resized to 2^col_power x 2^row_power cells on the same tile grid; zoom dropped."""
    target = replace(layer.meta.layout, tile_cols=2 ** col_power, tile_rows=2 ** row_power)
    out = _scatter(layer, target, method)
    return to_tiles(out.with_df(out.df, zoom=None))


# --- pyramid ---------------------------------------------------------------------------------

def _shrinks(a: Layout, b: Layout) -> tuple[int, int] | None:
    """Whole-number reduction (x, y) by which tiles can be shrunk on their own, if there is one."""
    fx, fy = a.layout_cols / b.layout_cols, a.layout_rows / b.layout_rows
    if fx in (1, 2) and fy in (1, 2) and a.tile_cols % fx == 0 and a.tile_rows % fy == 0:
        return int(fx), int(fy)
    return None


def _shrink_tiles(layer: Layer, target: Layout, fx: int, fy: int, method: str) -> Layer:
    """Each tile shrinks in place, then the (at most four) parts of a parent tile are put together:
    only the reduced arrays are shuffled."""
    at, keys = layer.meta.layout, layer.keys
    rows, cols = at.tile_rows, at.tile_cols
    h, w = rows // fy, cols // fx
    others = [k for k in keys if k not in ("col", "row")]
    n_bands = layer.meta.bands
    types = dict(layer.df.dtypes)

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("flat").flatten().to_numpy(zero_copy_only=False)
            stack = flat.reshape(-1, h, fy, w, fx)
            stack = np.moveaxis(stack, (2, 4), (0, 1)).reshape(fy * fx, -1, h, w)
            small = stencils.reduce_stack(method, stack, fx, fy)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keys] + [nullable_lists(
                    small.reshape(len(batch), n_bands * h * w))], [*keys, "vals"])

    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "vals array<double>"])
    flat = layer.df.select(*keys, F.flatten("bands").cast("array<double>").alias("flat"))
    parts = flat.mapInArrow(shrink, schema).select(
        F.floor(F.col("col") / fx).cast("int").alias("col"),
        F.floor(F.col("row") / fy).cast("int").alias("row"), *others,
        F.struct(((F.col("col") % fx) * w).alias("px"),
                 ((F.col("row") % fy) * (h * n_bands)).alias("py"),
                 F.lit(w).alias("w"), F.lit(h * n_bands).alias("h"), "vals").alias("piece"))
    grouped = parts.groupBy(*keys).agg(F.collect_list("piece").alias("pieces"))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bands lie below each other inside every part: rows are (part y, band, y)
            tall = padded_windows(batch.column("pieces"), rows * n_bands, cols, 0)
            whole = tall.reshape(-1, fy, n_bands, h, cols).swapaxes(1, 2)
            yield _with_data(batch.select(keys), whole.reshape(len(batch), n_bands * rows * cols))

    done = grouped.select(*keys, "pieces").mapInArrow(
        assemble, ", ".join([*(f"{k} {types[k]}" for k in keys), "flat array<double>"]))
    kind = layer.meta.cell_type if method in SELECTING else CellType.parse("float64")
    bands = unflatten(rows * cols, n_bands, kind.compute_type)
    return layer.with_df(done.select(*keys, bands.alias("bands")), layout=target, cell_type=kind)


def pyramid(layer: Layer, method: str = "NearestNeighbor", end_zoom: int = 0,
            materialize: bool = True) -> list[Layer]:
    """All levels from the layer's own down to ``end_zoom``, each from the one above; tiles of equal
    key are merged first.

    A layer with a zoom uses the global scheme, otherwise the local scheme with an inferred level.
    Every level is written to the shared folder once, a quarter of the one above, so that whatever
    reads the levels does not compute the chain again; ``materialize=False`` keeps them lazy.
    """
    if layer.kind == "tile" and layer.base.isEmpty() or layer.kind == "cell" and layer.df.isEmpty():
        raise ValueError("cannot build a pyramid over an empty layer")
    meta = layer.meta
    is_global = meta.zoom is not None
    zoom = meta.zoom if is_global else meta.layout.level()
    level = unique_keys(layer) if layer.kind == "tile" else to_tiles(layer)
    level = level.with_df(level.df, zoom=zoom)
    folder = run_folder(layer.base.sparkSession, "pyramid") if materialize else None
    out = [level]
    while zoom > end_zoom:
        zoom -= 1
        at = level.meta.layout
        target = global_level(meta.epsg, zoom, at.tile_cols) if is_global else at.zoom_out()
        factors = _shrinks(at, target)
        easy = method in AGGREGATES or method in ("NearestNeighbor", "Bilinear")
        if factors and easy:
            level = _shrink_tiles(level, target, *factors, method)
        else:
            level = to_tiles(_scatter(level, target, method))
        level = level.with_df(level.df, zoom=zoom)
        if folder:
            level = level.with_df(through_table(level.df, f"{folder}/zoom={zoom}"))
        out.append(level)
    return out


def pyramid_cells(levels: list[Layer]) -> DataFrame:
    """All levels as one table of cells with a ``zoom`` column."""
    parts = [to_cells(level).df.withColumns({"v": F.col("v").cast("double"),
                                             "zoom": F.lit(level.zoom)}) for level in levels]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
