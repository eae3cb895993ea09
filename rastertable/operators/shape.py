"""Conversion between tile arrays and cell rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import Layer


def unnest(df: DataFrame, keep: list[str], array: str, at: str, value: str) -> DataFrame:
    """One row per element of an array: its position ``at`` and ``value`` next to ``keep``.

    The outer generator keeps the optimizer from testing the size of the array beforehand, which
    would build computed arrays twice.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(at, value))
    return rows.where(F.col(at).isNotNull())


def _exploded(layer: Layer) -> DataFrame:
    keys = layer.keys
    bands = unnest(layer.df, keys, "bands", "band", "cells")
    return unnest(bands, [*keys, "band"], "cells", "i", "v")


def to_cells(layer: Layer, keep_nodata: bool = False) -> Layer:
    """Tiles to cell rows: two generators, no shuffle. NoData cells are dropped on request."""
    if layer.kind == "cell":
        return layer.with_df(layer.df)
    layout = layer.meta.layout
    cells = _exploded(layer)
    if not keep_nodata:
        cells = cells.where(F.col("v").isNotNull())
    tx, ty = layout.place_of(F.col("i"))
    x = F.col("col").cast("bigint") * layout.tile_cols + tx
    y = F.col("row").cast("bigint") * layout.tile_rows + ty
    instant = ["instant"] if layer.meta.temporal else []
    return layer.with_df(
        cells.select(x.alias("x"), y.cast("bigint").alias("y"), *instant, "band", "v"), "cell")


def dense_array(entries: Column, n: int, value_type: str) -> Column:
    """Array of ``n`` values from an array of (i, v) sorted by i; gaps become NULL.

    Every entry contributes the gap before it and itself, so the work is linear in ``n``.
    ``entries`` must be a plain column. A position that occurs twice raises an error.
    """
    null = F.lit(None).cast(value_type)

    def piece(e: Column, k: Column) -> Column:
        gap = e["i"] - F.coalesce(F.get(entries, k - 1)["i"], F.lit(-1)) - 1
        checked = F.when(gap < 0, F.raise_error(F.lit("duplicate cell in a tile; merge first"))
                         .cast("int")).otherwise(gap)
        return F.concat(F.array_repeat(null, checked), F.array(e["v"]))

    tail = F.lit(n - 1) - F.coalesce(F.get(entries, F.size(entries) - 1)["i"], F.lit(-1))
    return F.concat(F.flatten(F.transform(entries, piece)), F.array_repeat(null, tail))


STRIP_CELLS = 1024


def strip_size(tile_cols: int, tile_rows: int) -> int:
    """Cells of the whole rows of a tile that are gathered at once; divides the tile."""
    fitting = [k for k in range(1, tile_rows + 1)
               if tile_rows % k == 0 and k * tile_cols <= STRIP_CELLS]
    return tile_cols * max(fitting, default=1)


def to_tiles(layer: Layer) -> Layer:
    """Cell rows to full tiles with NULL for NoData. One shuffle by tile key.

    A group holds at most one tile, because cells are unique; the gathered list is therefore
    bounded by the tile size whatever the size of the layer. Large tiles are gathered as strips of
    rows first and then from these arrays, in the partition the one shuffle made, so that a task
    never holds whole tiles as single cells.
    """
    if layer.kind == "tile":
        return layer.with_df(layer.df)
    meta = layer.meta
    n, vtype = meta.layout.tile_cells, meta.cell_type.compute_type
    col, row = meta.layout.key_of(F.col("x"), F.col("y"))
    at = F.col("band") * n + meta.layout.index_of(F.col("x"), F.col("y"))
    instant = ["instant"] if meta.temporal else []
    keys = ["col", "row", *instant]
    placed = layer.df.select(col.alias("col"), row.alias("row"), *instant,
                             at.cast("int").alias("at"), "v")

    def gathered(df: DataFrame, by: list[str], i: Column, v: str) -> DataFrame:
        entry = F.struct(i.alias("i"), F.col(v).alias("v"))
        return df.groupBy(*by).agg(F.sort_array(F.collect_list(entry)).alias("entries"))

    if n * meta.bands <= 4 * STRIP_CELLS:
        flat = gathered(placed, keys, F.col("at"), "v").select(
            *keys, dense_array(F.col("entries"), n * meta.bands, vtype).alias("flat"))
    else:
        size = strip_size(meta.layout.tile_cols, meta.layout.tile_rows)
        placed = placed.repartition(*keys).withColumn(
            "strip", F.floor(F.col("at") / size).cast("int"))
        strips = gathered(placed, [*keys, "strip"], F.col("at") % size, "v").select(
            *keys, "strip", dense_array(F.col("entries"), size, vtype).alias("cells"))
        whole = gathered(strips, keys, F.col("strip"), "cells").select(*keys, dense_array(
            F.col("entries"), n * meta.bands // size, f"array<{vtype}>").alias("strips"))
        gap = F.array_repeat(F.lit(None).cast(vtype), size)
        flat = whole.select(*keys, F.flatten(F.transform(
            "strips", lambda s: F.coalesce(s, gap))).alias("flat"))
    bands = F.array(*[F.slice("flat", b * n + 1, n) for b in range(meta.bands)])
    return layer.with_df(flat.select("col", "row", *instant, bands.alias("bands")), "tile")


def grid(layer: Layer) -> DataFrame:
    """Dense cells, NoData included, over the tile keys that exist."""
    return to_cells(to_tiles(layer), keep_nodata=True).df


def keys(layer: Layer) -> DataFrame:
    """All keys of a layer, duplicates kept."""
    if layer.kind == "scene":
        names = ["epsg", "xmin", "ymin", "xmax", "ymax"]
        return layer.df.select(*names, *(["instant"] if layer.meta.temporal else []))
    return layer.base.select(*layer.keys)
