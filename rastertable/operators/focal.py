"""Neighbourhood operations on one band, across tile borders.

Every tile sends the strips its neighbours need to them (one shuffle of about the size of the
band), and each tile is then computed as a numpy stencil over its padded array. What meets in one
group is the tile and its neighbours' strips, whatever the size of the layer. Where the neighbourhood
reaches far past a tile's border, blocks of tiles are computed instead, so that a tile goes to the blocks
near it and not to every tile within reach.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stencils
from ..functions.neighborhoods import Square, reach
from ..model import CellType, Layer, Layout
from .fold import in_parts
from .shape import to_tiles

# Operation names; the ones of the second line keep integer layers integer.
STATISTICS = ("Mean", "Median", "StandardDeviation",
              "Sum", "Min", "Max", "Mode")


def strip(cells: Column, tc: int, x0: int, x1: int, y0: int, y1: int) -> Column:
    """Row-major sub-window of a tile array."""
    if x1 - x0 == tc:
        return F.slice(cells, y0 * tc + 1, (y1 - y0) * tc)
    rows = F.transform(F.sequence(F.lit(y0), F.lit(y1 - 1)),
                       lambda y: F.slice(cells, y * tc + x0 + 1, x1 - x0))
    return F.flatten(rows)


def halo(tiles: DataFrame, cells: Column, layout: Layout, r: int, keys: list[str]) -> DataFrame:
    """Per tile the pieces of its padded window: ``pieces ARRAY<STRUCT<px,py,w,h,vals>>``."""
    tc, tr = layout.tile_cols, layout.tile_rows
    kx, ky = -(-r // tc), -(-r // tr)
    others = [k for k in keys if k not in ("col", "row")]
    sends = []
    for dr in range(-ky, ky + 1):
        for dc in range(-kx, kx + 1):
            # the receiver lies (dc, dr) tiles away; its window reaches r cells past its border
            x0, x1 = max(0, dc * tc - r), min(tc, dc * tc + tc + r)
            y0, y1 = max(0, dr * tr - r), min(tr, dr * tr + tr + r)
            if x0 >= x1 or y0 >= y1:
                continue
            sends.append(F.struct(
                (F.col("col") + dc).alias("col"), (F.col("row") + dr).alias("row"),
                F.lit((dc, dr) == (0, 0)).cast("int").alias("centre"),
                F.struct(F.lit(x0 - dc * tc + r).alias("px"), F.lit(y0 - dr * tr + r).alias("py"),
                         F.lit(x1 - x0).alias("w"), F.lit(y1 - y0).alias("h"),
                         strip(F.col("cells"), tc, x0, x1, y0, y1).alias("vals")).alias("piece")))
    sent = (tiles.select("col", "row", *others, cells.cast("array<double>").alias("cells"))
            .select(*others, F.explode(F.array(*sends)).alias("s")).select(*others, "s.*")
            .where(F.col("col").between(0, layout.layout_cols - 1)
                   & F.col("row").between(0, layout.layout_rows - 1)))
    grouped = sent.groupBy(*keys).agg(F.sum("centre").alias("centres"),
                                      F.collect_list("piece").alias("pieces"))
    once = F.when(F.col("centres") > 1, F.raise_error(
        F.lit("duplicate tile key; merge first")).cast("int")).otherwise(F.col("centres"))
    return grouped.where(once == 1).select(*keys, "pieces")


def padded_windows(pieces: pa.ListArray, rows: int, cols: int, r: int,
                   name: str = "vals") -> np.ndarray:
    """Stack of padded arrays of a batch, NaN where there is no piece or no data."""
    offsets = pieces.offsets.to_numpy()
    parts = pieces.values
    px, py, w, h = (parts.field(n).to_numpy() for n in ("px", "py", "w", "h"))
    vals = parts.field(name)
    starts = vals.offsets.to_numpy()
    flat = vals.values.to_numpy(zero_copy_only=False)
    out = np.full((len(pieces), rows + 2 * r, cols + 2 * r), np.nan)
    for t in range(len(pieces)):
        for k in range(offsets[t], offsets[t + 1]):
            out[t, py[k]:py[k] + h[k], px[k]:px[k] + w[k]] = (
                flat[starts[k]:starts[k + 1]].reshape(h[k], w[k]))
    return out


def nullable_lists(values: np.ndarray) -> pa.ListArray:
    """Arrow lists from rows of numbers, NaN as null."""
    n, width = values.shape
    flat = values.ravel()
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width),
                                    pa.array(flat, mask=np.isnan(flat)))


#: Cells along a side of a block of tiles, where the radius does not ask for less.
BLOCK = 512


def block_tiles(layout: Layout, r: int) -> tuple[int, int] | None:
    """Tiles of a block, across and down; none where tiles themselves send each cell to few others."""
    tc, tr = layout.tile_cols, layout.tile_rows
    if (tc + 2 * r) * (tr + 2 * r) <= 4 * tc * tr:
        return None
    along = lambda size, most: min(-(-min(4 * r, BLOCK) // size), most)
    return along(tc, layout.layout_cols), along(tr, layout.layout_rows)


def block_halo(tiles: DataFrame, cells: Column, layout: Layout, r: int, keys: list[str], block: tuple[int, int]) -> DataFrame:
    """Per block of tiles the tiles that its padded window reaches: ``(bc, br, .., pieces)``, like ``halo``
    but for whole tiles, which may stick out, and ``own`` for those of the block."""
    others = [k for k in keys if k not in ("col", "row")]
    rows = tiles.select(*keys, cells.cast("array<double>").alias("vals"))
    for at, to, size, n, most in (("col", "bc", layout.tile_cols, block[0], layout.layout_cols),
                                  ("row", "br", layout.tile_rows, block[1], layout.layout_rows)):
        start, side = F.col(at).cast("bigint") * size, n * size
        first, last = F.floor((start - r) / side), F.floor((start + (size + r - 1)) / side)
        rows = rows.withColumn(to, F.explode(F.sequence(first, last))).where(F.col(to).between(0, (most - 1) // n))
    own = ((F.floor(F.col("col") / block[0]) == F.col("bc")) & (F.floor(F.col("row") / block[1]) == F.col("br"))
           & (F.col("col") < layout.layout_cols) & (F.col("row") < layout.layout_rows))
    px = F.col("col").cast("bigint") * layout.tile_cols - F.col("bc") * (block[0] * layout.tile_cols) + r
    py = F.col("row").cast("bigint") * layout.tile_rows - F.col("br") * (block[1] * layout.tile_rows) + r
    sent = rows.select("bc", "br", *others, F.struct(px.cast("int").alias("px"), py.cast("int").alias("py"),
                                                     own.alias("own"), "vals").alias("piece"))
    place = F.when(F.col("piece.own"), F.struct("piece.px", "piece.py"))
    grouped = sent.groupBy("bc", "br", *others).agg(F.count(place).alias("tiles"), F.size(F.collect_set(place)).alias("places"),
                                                    F.collect_list("piece").alias("pieces"))
    once = F.when(F.col("tiles") > F.col("places"), F.raise_error(
        F.lit("duplicate tile key; merge first")).cast("bigint")).otherwise(F.col("tiles"))
    return grouped.where(once > 0).select("bc", "br", *others, "pieces")


def run_blocks(compute: Callable, layout: Layout, r: int, keys: list[str], block: tuple[int, int]) -> Callable:
    """Arrow batches of ``block_halo`` to rows of tiles; ``compute`` gives the cells of padded windows."""
    tc, tr, others = layout.tile_cols, layout.tile_rows, [k for k in keys if k not in ("col", "row")]
    height, width = block[1] * tr, block[0] * tc

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            pieces = pa.concat_arrays([batch.column("pieces")])
            ends, parts = pieces.offsets.to_numpy(), pieces.values
            px, py = (parts.field(n).to_numpy() for n in ("px", "py"))
            own = parts.field("own").to_numpy(zero_copy_only=False)
            vals = parts.field("vals")
            starts, flat = vals.offsets.to_numpy(), vals.values.to_numpy(zero_copy_only=False)
            bc, br = (batch.column(n).to_numpy() for n in ("bc", "br"))
            for t in range(len(batch)):
                window = np.full((height + 2 * r, width + 2 * r), np.nan)
                for k in range(ends[t], ends[t + 1]):
                    x, y = px[k], py[k]
                    tile = flat[starts[k]:starts[k + 1]].reshape(tr, tc)
                    window[max(y, 0):max(y + tr, 0), max(x, 0):max(x + tc, 0)] = tile[
                        max(-y, 0):height + 2 * r - y, max(-x, 0):width + 2 * r - x]
                mine = np.flatnonzero(own[ends[t]:ends[t + 1]]) + ends[t]
                col, row = (px[mine] - r) // tc, (py[mine] - r) // tr
                out = compute(window[None])[0].reshape(block[1], tr, block[0], tc).swapaxes(1, 2)[row, col]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(col + bc[t] * block[0], pa.int32()), pa.array(row + br[t] * block[1], pa.int32()),
                     *(batch.column(k).take(pa.array([t] * len(mine))) for k in others),
                     nullable_lists(out.reshape(len(mine), tr * tc))], ["col", "row", *others, "cells"])
    return run


def run_stencil(layer: Layer, stencil: Callable, r: int, band: int, target: str,
                cell_type: str, weight: int = 8) -> Layer:
    """One stencil over one band; ``target`` says which cells it recomputes, others are kept."""
    if target not in ("All", "Data", "NoData"):
        raise ValueError(f"unknown target {target!r}")
    tiles = to_tiles(layer)
    layout, keys = layer.meta.layout, tiles.keys
    rows, cols = layout.tile_rows, layout.tile_cols
    cells = F.get("bands", F.lit(band))
    block = block_tiles(layout, r)

    def compute(padded: np.ndarray) -> np.ndarray:
        out = stencils.blockwise(stencil, padded, r, weight)
        if target == "All":
            return out
        centre = padded[:, r:padded.shape[1] - r, r:padded.shape[2] - r]
        chosen = np.isnan(centre) if target == "NoData" else ~np.isnan(centre)
        return np.where(chosen, out, centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            out = compute(padded_windows(pa.concat_arrays([batch.column("pieces")]), rows, cols, r))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), nullable_lists(
                out.reshape(len(out), rows * cols))], [*keys, "cells"])

    windows = block_halo(tiles.df, cells, layout, r, keys, block) if block else halo(tiles.df, cells, layout, r, keys)
    types = dict(tiles.df.dtypes)
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "cells array<double>"])
    done = windows.mapInArrow(run_blocks(compute, layout, r, keys, block) if block else run, schema)
    kind = CellType.parse(cell_type)
    bands = F.array(F.col("cells")).cast(f"array<array<{kind.compute_type}>>")
    return tiles.with_df(done.select(*keys, bands.alias("bands")), cell_type=kind, bands=1)


def focal(layer: Layer, operation: str, neighborhood=Square(1), band: int = 0,
          target: str = "All", z_factor: float = 1.0) -> Layer:
    """Focal statistic, Slope or Aspect of one band.

    Statistics run over the data cells of the neighbourhood; a cell with none becomes NoData.
    StandardDeviation is that of the population. Temporal layers look at the same instant only.
    """
    if operation == "Slope":
        return slope(layer, z_factor, band, target)
    if operation == "Aspect":
        return aspect(layer, band, target)
    if operation not in STATISTICS:
        raise ValueError(f"unknown focal operation {operation!r}")
    offsets = neighborhood.offsets()
    r = reach(offsets)
    whole = operation in STATISTICS[3:] and not layer.is_floating
    stacked = operation in ("Median", "Mode") and not stencils.Wide(offsets, r).worth(offsets, operation)
    many = len(offsets) if stacked else 8
    return run_stencil(layer, stencils.focal_statistic(operation, offsets, r), r, band, target,
                       "int32" if whole else "float64", many)


def slope(layer: Layer, z_factor: float = 1.0, band: int = 0, target: str = "All") -> Layer:
    """Slope in degrees (Horn 1981)."""
    at = layer.meta.layout
    return run_stencil(layer, stencils.slope(at.cell_width, at.cell_height, z_factor), 1, band,
                       target, "float64", 16)


def aspect(layer: Layer, band: int = 0, target: str = "All") -> Layer:
    """Aspect in degrees clockwise from north, -1 where flat."""
    at = layer.meta.layout
    return run_stencil(layer, stencils.aspect(at.cell_width, at.cell_height), 1, band, target,
                       "float64", 16)


def hillshade(layer: Layer, azimuth: float = 315.0, altitude: float = 45.0,
              z_factor: float = 1.0, band: int = 0, target: str = "All") -> Layer:
    """Shaded relief 0..255."""
    at = layer.meta.layout
    stencil = stencils.hillshade(at.cell_width, at.cell_height, azimuth, altitude, z_factor)
    return run_stencil(layer, stencil, 1, band, target, "int32", 16)


def tobler(layer: Layer, z_factor: float = 1.0, target: str = "All", band: int = 0) -> Layer:
    """Walking speed in km/h from slope (Tobler 1993), slope taken across tile borders."""
    def speed(degrees: Column) -> Column:
        return F.lit(6.0) * F.exp(F.abs(F.tan(F.radians(degrees)) + 0.05) * -3.5)

    # the formula of the inventory: 6 exp(-3.5 |tan(slope) + 0.05|)
    return slope(layer, z_factor, band, target).map_cells(speed, "float64")
