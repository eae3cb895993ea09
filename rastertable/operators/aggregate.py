"""Aggregation of stacked tiles, merging, summaries, histograms and quantiles."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.classes import ColorMap
from ..model import CellType, Extent, Layer, Meta
from ..plans.lineage import run_folder, through_table
from .fold import fold_tiles, shared_bands
from .geometry import explode_range
from .resample import layout_for, single_epsg
from .shape import to_cells, unnest

# Operation names of aggregate_by_cell.
OPERATIONS = ("Sum", "Min", "Max", "Mean", "Variance", "StandardDeviation")


def aggregate_by_cell(layer: Layer, operation: str) -> Layer:
    """Tiles of equal key, combined cell by cell; the shape of the layer is kept.

    Sum gives NoData where any of the tiles has NoData (in a cell layer, absent cells are in no
    tile); the others skip NoData. Variance and StandardDeviation are those of a sample. Partial
    results combine before the shuffle, so a key may repeat without bound. Of tiles with different
    numbers of bands, the bands that all tiles of the key have.
    """
    if operation not in OPERATIONS:
        raise ValueError(f"unknown operation {operation!r}")
    meta = layer.meta
    whole = operation in ("Sum", "Min", "Max")
    kind = meta.cell_type if whole else CellType.parse("float64")
    if layer.kind == "tile":
        n = meta.layout.tile_cells
        folded = fold_tiles(layer.df, layer.keys, F.flatten("bands"), n * meta.bands, operation,
                            meta.cell_type.compute_type)
        return layer.with_df(folded.select(*layer.keys, shared_bands(
            n, kind.compute_type).alias("bands")), cell_type=kind)
    fn = {"Sum": F.sum, "Min": F.min, "Max": F.max, "Mean": F.avg, "Variance": F.var_samp,
          "StandardDeviation": F.stddev_samp}[operation]
    out = layer.df.groupBy(*layer.keys).agg(fn("v").alias("v")).where(F.col("v").isNotNull())
    return layer.with_df(out, cell_type=kind)


def merge(layers: Layer | Sequence[Layer]) -> Layer:
    """One value per key and cell: NoData is filled from the next layer in order.

    Keys that repeat inside one layer are resolved by an optional ``priority`` column, lowest
    first, then by the smaller value. Tile layers give tiles, others cells.
    """
    layers = [layers] if isinstance(layers, Layer) else list(layers)
    first = layers[0]
    ranked = ["priority" in layer.base.columns for layer in layers]
    same = all(t.kind == "tile" and t.meta.bands == first.meta.bands for t in layers)
    if same and (len(layers) == 1 or not any(ranked)):
        parts = [t.df.select(*first.keys, "bands", (
            F.col("priority") if has else F.lit(nth)).alias("rank"))
            for nth, (t, has) in enumerate(zip(layers, ranked))]
        n = first.meta.layout.tile_cells
        folded = fold_tiles(reduce(DataFrame.unionByName, parts), first.keys, F.flatten("bands"),
                            n * first.meta.bands, "First", first.meta.cell_type.compute_type, F.col("rank"))
        return first.with_df(folded.select(*first.keys, shared_bands(
            n, first.meta.cell_type.compute_type).alias("bands")))
    first = to_cells(layers[0])
    parts = []
    for nth, (layer, has) in enumerate(zip(layers, ranked)):
        cells = _cells_with_priority(layer) if has else to_cells(layer).df
        inner = F.col("priority").cast("bigint") if has else F.lit(0).cast("bigint")
        rank = F.struct(F.lit(nth).alias("nth"), inner.isNull().alias("last"), inner.alias("inner"), F.col("v").alias("v"))
        parts.append(cells.select(*first.keys, "v", rank.alias("rank")))
    merged = (reduce(DataFrame.unionByName, parts).groupBy(*first.keys)
              .agg(F.min_by("v", "rank").alias("v")))
    return first.with_df(merged)


def _cells_with_priority(layer: Layer) -> DataFrame:
    at = layer.meta.layout
    instant = ["instant"] if layer.meta.temporal else []
    keep = ["col", "row", *instant, "priority"]
    bands = unnest(layer.df, keep, "bands", "band", "cells")
    rows = unnest(bands, [*keep, "band"], "cells", "i", "v").where(F.col("v").isNotNull())
    tx, ty = at.place_of(F.col("i"))
    return rows.select(
        (F.col("col").cast("bigint") * at.tile_cols + tx).alias("x"),
        (F.col("row").cast("bigint") * at.tile_rows + ty).alias("y"),
        *instant, "band", "priority", "v")


def raster_summary(layer: Layer) -> DataFrame:
    """One row per CRS: cell type, smallest cell size, envelope, time bounds, scene count."""
    if layer.kind != "scene":
        raise ValueError("a summary is taken from scenes")
    cw = (F.col("xmax") - F.col("xmin")) / F.col("cols")
    ch = (F.col("ymax") - F.col("ymin")) / F.col("rows")
    size = F.min_by(F.struct(cw.alias("w"), ch.alias("h")), cw * ch)
    times = [F.min("instant").alias("start"), F.max("instant").alias("end")]
    return (layer.base.groupBy("epsg")
            .agg(F.lit(str(layer.meta.cell_type)).alias("cell_type"), size.alias("size"),
                 F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
                 F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
                 *(times if layer.meta.temporal else []),
                 F.count(F.lit(1)).alias("tile_count"))
            .withColumns({"cell_width": F.col("size.w"), "cell_height": F.col("size.h")})
            .drop("size"))


def _union_type(summaries: DataFrame) -> Column:
    """Aggregate of ``cell_type``: the union of all types, taken in the order of their names."""
    known = sorted(r[0] for r in summaries.select("cell_type").distinct().collect())  # a few types
    while True:  # unions of unions, until none is new; by name, as the NoData of floats equals nothing
        pairs = {f"{a}|{b}": str(CellType.parse(a).union(CellType.parse(b))) for a in known for b in known}
        new = set(pairs.values()) - set(known)
        if not new:
            break
        known += sorted(new)
    if not known:
        return F.max("cell_type")
    table = F.create_map(*[F.lit(x) for pair, union in pairs.items() for x in (pair, union)])
    found = F.sort_array(F.collect_set("cell_type"))
    return F.aggregate(found, F.get(found, F.lit(0)), lambda all_, name: F.element_at(table, F.concat_ws("|", all_, name)))


def combine_summaries(summaries: Sequence[DataFrame]) -> DataFrame:
    """Summaries of several layers folded into one row per CRS; its cell type holds all of theirs."""
    every = reduce(DataFrame.unionByName, summaries)
    times = ([F.min("start").alias("start"), F.max("end").alias("end")]
             if "start" in every.columns else [])
    size = F.min_by(F.struct("cell_width", "cell_height"),
                    F.col("cell_width") * F.col("cell_height"))
    return (every.groupBy("epsg")
            .agg(_union_type(every).alias("cell_type"), size.alias("size"),
                 F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
                 F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"), *times,
                 F.sum("tile_count").alias("tile_count"))
            .select("*", "size.cell_width", "size.cell_height").drop("size"))


def collect_metadata(layer: Layer, layout) -> Meta:
    """Metadata of scenes for a layout or layout type; they must have exactly one CRS."""
    epsg = single_epsg(layer)
    target, zoom = layout_for(layer, layout, epsg)
    r = raster_summary(layer).first()
    extent = Extent(r["xmin"], r["ymin"], r["xmax"], r["ymax"])
    found, bounds = target.key_bounds(extent), None
    if found is not None:
        c0, r0, c1, r1 = found
        bounds = {"minKey": {"col": c0, "row": r0}, "maxKey": {"col": c1, "row": r1}}
    if bounds and layer.meta.temporal:
        bounds["minKey"]["instant"], bounds["maxKey"]["instant"] = str(r["start"]), str(r["end"])
    return replace(layer.meta, layout=target, epsg=epsg, zoom=zoom, extent=extent, bounds=bounds)


def min_max(layer: Layer) -> DataFrame:
    """Smallest and largest value across all bands; empty bands are ignored."""
    if layer.kind == "cell":
        return layer.df.agg(F.min("v").alias("min"), F.max("v").alias("max"))
    per_tile = layer.df.select(F.flatten("bands").alias("v")).select(  # no cell becomes a row
        F.array_min("v").alias("low"), F.array_max("v").alias("high"))
    return per_tile.agg(F.min("low").alias("min"), F.max("high").alias("max"))


def histogram_exact(layer: Layer) -> DataFrame:
    """Exact histogram: (band, value, count)."""
    return (to_cells(layer).df.groupBy("band", F.col("v").alias("value"))
            .agg(F.count(F.lit(1)).alias("count")))


def histogram_approx(layer: Layer, buckets: int = 80) -> DataFrame:
    """Streaming histogram (Ben-Haim and Tom-Tov 2010): (band, value, count) bucket centres."""
    sketch = (to_cells(layer).df.groupBy("band")
              .agg(F.histogram_numeric(F.col("v").cast("double"), F.lit(buckets)).alias("h")))
    return sketch.select("band", F.explode("h").alias("b")).select(
        "band", F.col("b.x").alias("value"), F.col("b.y").alias("count"))


def histogram_to_json(histogram: DataFrame) -> DataFrame:
    """Histogram rows as JSON arrays of [value, count], in chunks of 65,536 neighbouring values so
    that no row grows with the number of distinct values: (band, chunk, json).

    Values are numbered per band in two steps: ranges of neighbouring values, then the values inside
    each range. The ranges are a table in the shared folder, so that both steps see the same ones.
    """
    path = run_folder(histogram.sparkSession, "histogram-ranges")
    ranged = through_table(histogram.select("band", "value", "count").repartitionByRange("band", "value")
                           .withColumn("part", F.spark_partition_id()), path)
    earlier = Window.partitionBy("band").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (ranged.groupBy("band", "part").agg(F.count(F.lit(1)).alias("n"))  # one row per range and band
              .select("band", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    inside = F.row_number().over(Window.partitionBy("band", "part").orderBy("value")) - 1
    numbered = ranged.withColumn("inside", inside).join(F.broadcast(before), ["band", "part"])
    pair = F.array(F.col("value").cast("double"), F.col("count").cast("double"))
    return (numbered.groupBy("band", F.floor((F.col("before") + F.col("inside")) / 65536).alias("chunk"))
            .agg(F.to_json(F.sort_array(F.collect_list(pair))).alias("json")))


def histogram_from_json(rows: DataFrame) -> DataFrame:
    """Inverse of ``histogram_to_json``."""
    pairs = F.from_json("json", "array<array<double>>")
    return rows.select("band", F.explode(pairs).alias("p")).select(
        "band", F.get("p", F.lit(0)).alias("value"), F.get("p", F.lit(1)).alias("count"))


def quantile_breaks(layer: Layer, n: int, accuracy: int = 10000) -> DataFrame:
    """Approximate quantile breaks i/n, i = 1..n, per band: (band, i, value)."""
    shares = F.array(*[F.lit(i / n) for i in range(1, n + 1)])
    found = (to_cells(layer).df.groupBy("band")
             .agg(F.percentile_approx("v", shares, F.lit(accuracy)).alias("q")))
    return found.select("band", F.posexplode("q").alias("i", "value")).withColumn(
        "i", F.col("i") + 1)


def quantile_breaks_exact(layer: Layer, n: int) -> DataFrame:
    """Exact breaks of integer layers: break i is the smallest value with cumulative share >= i/n.

    Counts are summed per block of 65,536 values first (at most 65,536 blocks of 32-bit values),
    which tells the blocks that hold a break; only these are ordered value by value. So no window
    is larger than 65,536 rows, however many distinct values there are.
    """
    if layer.is_floating:
        raise ValueError("exact quantiles are for integer layers")
    return quantile_breaks_of_histogram(histogram_exact(layer), n)


def quantile_breaks_of_histogram(histogram: DataFrame, n: int) -> DataFrame:
    """``quantile_breaks_exact`` from histogram rows (band, value, count)."""
    counts = histogram.select("band", F.col("value").alias("v"),
                              F.col("count").cast("bigint").alias("n"),
                              F.floor(F.col("value") / 65536).alias("block"))
    by_block = Window.partitionBy("band").orderBy("block")
    blocks = (counts.groupBy("band", "block").agg(F.sum("n").alias("size"))
              .withColumns({"upto": F.sum("size").over(by_block),
                            "total": F.sum("size").over(Window.partitionBy("band"))})
              .withColumn("before", F.col("upto") - F.col("size")))
    # shares by whole-number arithmetic: i is reached when i * total <= upto * n
    whole = lambda c: F.expr(f"({c} * {n}L) div total")
    holding = (blocks.where(whole("upto") > whole("before"))
               .select("band", "block", "before", "total"))
    # null-safe, so that no null test makes the two uses of the counts differ: they run once
    held = holding.withColumnsRenamed({"band": "_band", "block": "_block"})
    inside = counts.join(F.broadcast(held),  # at most n rows per band
                         F.col("band").eqNullSafe(F.col("_band"))
                         & F.col("block").eqNullSafe(F.col("_block")))
    by_value = Window.partitionBy("band", "block").orderBy("v")
    steps = (inside.withColumn("upto", F.col("before") + F.sum("n").over(by_value))
             .withColumn("prior", F.col("upto") - F.col("n")))
    rows = explode_range(steps, "i", whole("prior") + 1, whole("upto"))
    return rows.select("band", F.col("i").cast("int").alias("i"), F.col("v").alias("value"))


def color_map_from_quantiles(layer: Layer, colors: Sequence[int], no_data_color: int = 0,
                             fallback_color: int = 0, band: int = 0, exact: bool = False,
                             boundary: str = "LessThanOrEqualTo") -> ColorMap:
    """Colour map with one quantile break of the layer per ramp colour."""
    breaks = (quantile_breaks_exact if exact else quantile_breaks)(layer, len(colors))
    return _color_map(breaks, colors, no_data_color, fallback_color, band, boundary)


def color_map_from_histogram(histogram: DataFrame, colors: Sequence[int], no_data_color: int = 0,
                             fallback_color: int = 0, band: int = 0,
                             boundary: str = "LessThanOrEqualTo") -> ColorMap:
    """Colour map with one quantile break of histogram rows per ramp colour."""
    breaks = quantile_breaks_of_histogram(histogram, len(colors))
    return _color_map(breaks, colors, no_data_color, fallback_color, band, boundary)


def _color_map(breaks, colors, no_data_color, fallback_color, band, boundary) -> ColorMap:
    rows = breaks.where(F.col("band") == band).orderBy("i").collect()  # one row per colour
    pairs = {r["value"]: c for r, c in reversed(list(zip(rows, colors)))}
    return ColorMap.from_map(pairs, no_data_color, fallback_color, boundary)


def summary_json(layer: Layer) -> str:
    """The summary rows as JSON text (one row per CRS)."""
    return json.dumps([r.asDict(recursive=True) for r in raster_summary(layer).collect()],
                      default=str)
