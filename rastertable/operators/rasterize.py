"""Geometry burnt into a layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import CellType, Extent, Layer, Layout, Meta, global_level
from .filters import Moment, moment
from .geometry import (coverage_spans, mask_cells, polygon_spans, segment_cells, segment_spans, tile_masks,
                       tile_shares)
from .shape import to_tiles


def rasterize_on(layout: Layout, epsg: int, fill: float, cell_type: str = "int32",
                 polygons: DataFrame | None = None, lines: DataFrame | None = None,
                 points: DataFrame | None = None, instant: Moment | None = None,
                 zoom: int | None = None, partial: bool = False) -> Layer:
    """Tiles with ``fill`` in the cells that polygons hold, lines cross or points fall in.

    A polygon holds the cells whose centre is inside; with ``partial`` also those its edges cross.
    """
    kind = CellType.parse(cell_type)
    meta = Meta(kind, layout, epsg, 1, zoom=zoom)
    value = F.lit(fill).cast(kind.compute_type)
    if polygons is not None and lines is None and points is None:
        masks = tile_masks(_spans(polygons, layout, partial), layout, by_geometry=False)
        cells = F.transform(mask_cells(F.col("mask"), layout),
                            lambda inside: F.when(inside, value))
        out = Layer(masks.select("col", "row", F.array(cells).alias("bands")), meta, "tile")
    else:
        parts = []
        if polygons is not None:
            spans = _spans(polygons, layout, partial)
            parts.append(spans.select(F.explode(F.sequence("x0", F.col("x1") - 1)).alias("x"), "y"))
        if lines is not None:
            parts.append(segment_cells(lines, layout).select("x", "y"))
        if points is not None:
            x, y = layout.cell_of(F.col("x"), F.col("y"))
            at = points.select(x.alias("x"), y.alias("y"))
            parts.append(at.where(F.col("x").between(0, layout.cols - 1)
                                  & F.col("y").between(0, layout.rows - 1)))
        if not parts:
            raise ValueError("nothing to rasterize")
        cells = parts[0]
        for part in parts[1:]:
            cells = cells.unionByName(part)
        rows = cells.distinct().select("x", "y", F.lit(0).alias("band"), value.alias("v"))
        out = to_tiles(Layer(rows, meta, "cell"))
    if instant is None:
        return out
    return out.with_df(out.df.select("col", "row", moment(instant).alias("instant"), "bands"),
                       temporal=True)


def _spans(polygons: DataFrame, layout: Layout, partial: bool) -> DataFrame:
    """Runs of the cells that polygons hold; they may overlap where cells are held in part."""
    inside = polygon_spans(polygons, layout)
    return inside.unionByName(segment_spans(polygons, layout)) if partial else inside


def rasterize_coverage(layout: Layout, epsg: int, polygons: DataFrame, instant: Moment | None = None,
                       zoom: int | None = None) -> Layer:
    """Tiles with the share of each cell that polygons cover, ``float64``; NoData where none does.

    Shares of several polygons add up, so where they overlap a cell may hold more than 1. Rings of a
    polygon may run either way round but must not cross.
    """
    meta = Meta(CellType.parse("float64"), layout, epsg, 1, zoom=zoom)
    tiles = tile_shares(coverage_spans(polygons, layout, by_geometry=False), layout, by_geometry=False)
    runs, none = F.col("shares"), F.lit(None).cast("double")
    gap = lambda e, k: e["i"] - F.coalesce(F.get(runs, k - 1)["i"] + F.get(runs, k - 1)["n"], F.lit(0))
    end = F.element_at(runs, -1)
    cells = F.concat(F.flatten(F.transform(runs, lambda e, k: F.concat(
        F.array_repeat(none, gap(e, k)), F.array_repeat(e["share"], e["n"])))),
        F.array_repeat(none, layout.tile_cells - end["i"] - end["n"]))
    if instant is None:
        return Layer(tiles.select("col", "row", F.array(cells).alias("bands")), meta, "tile")
    out = tiles.select("col", "row", moment(instant).alias("instant"), F.array(cells).alias("bands"))
    return Layer(out, meta, "tile").with_df(out, temporal=True)


def rasterize(epsg: int, zoom: int, fill: float, cell_type: str = "int32", tile_size: int = 256,
              **geometry) -> Layer:
    """``rasterize_on`` over the global layout of a zoom level."""
    return rasterize_on(global_level(epsg, zoom, tile_size), epsg, fill, cell_type, zoom=zoom,
                        **geometry)


def rasterize_single(extent: Extent, epsg: int, instant: Moment, cols: int, rows: int, fill: float,
                     polygons: DataFrame, cell_type: str = "int32", partial: bool = False) -> Layer:
    """A temporal layer of one tile over the given extent."""
    return rasterize_on(Layout(extent, 1, 1, cols, rows), epsg, fill, cell_type,
                        polygons=polygons, instant=instant, partial=partial)
