"""Masks, statistics and time series inside polygons, and sampling at points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.kernels import kernel_weight, least_weight, support
from ..model import Extent, Layer
from ..plans.joins import lookup_join
from .fold import in_parts, read_cells
from .geometry import (WORD, coverage_spans, envelope, extent_edges, in_mask, mask_bytes, mask_cells, near,
                       polygon_spans, tile_bound, tile_masks, tile_shares, tiles_for_geometry,
                       tiles_for_points)
from .shape import to_tiles, unnest


def _spread(layer: Layer) -> list[str] | None:
    """What tells tiles of one place apart; without time a place has one tile."""
    return ["instant"] if layer.meta.temporal else None


def mask(layer: Layer, edges: DataFrame) -> Layer:
    """Keep the cells inside any polygon; tiles without such a cell are dropped.

    The polygons become one bit mask per tile, joined by tile key: the raster itself is not
    shuffled while the masks pass the size check.
    """
    tiles = to_tiles(layer)
    layout = layer.meta.layout
    masks = tile_masks(polygon_spans(edges, layout), layout, by_geometry=False)
    area, most, _ = tile_bound(edges, layout)
    joined = lookup_join(near(tiles.df, layout, area), masks, ["col", "row"], "inner",
                         mask_bytes(layout), _spread(layer), most=most)
    kept = F.transform("bands", lambda band: F.zip_with(
        band, mask_cells(F.col("mask"), layout), lambda v, inside: F.when(inside, v)))
    return tiles.with_df(joined.select(*tiles.keys, kept.alias("bands")))


def _zone_cells(layer: Layer, edges: DataFrame, by_geometry: bool,
                band: int | None = None) -> DataFrame:
    """Data cells inside the polygons: (geom_id | nothing, instant, band, v), not shuffled."""
    tiles = to_tiles(layer)
    layout = layer.meta.layout
    masks = tile_masks(polygon_spans(edges, layout), layout, by_geometry)
    area, most, each = tile_bound(edges, layout)
    joined = lookup_join(near(tiles.df, layout, area), masks, ["col", "row"], "inner",
                         mask_bytes(layout), _spread(layer), ["geom_id"] if by_geometry else None,
                         each if by_geometry else most)
    tags = (["geom_id"] if by_geometry else []) + (["instant"] if layer.meta.temporal else [])
    if band is None:
        rows = unnest(joined, [*tags, "mask"], "bands", "band", "cells")
    else:
        rows = joined.select(*tags, "mask", F.lit(band).alias("band"),
                             F.get("bands", F.lit(band)).alias("cells"))
    rows = unnest(rows, [*tags, "mask", "band"], "cells", "i", "v")
    return (rows.where(F.col("v").isNotNull() & in_mask(F.col("mask"), F.col("i"), layout))
            .select(*tags, "band", "v"))


#: Masks that meet a tile in one row.
TOGETHER = 64


def _packed(masks: DataFrame, zone: str) -> DataFrame:
    """Masks of a tile, some of them in a row, so that its cells are read once for all of these; no
    shuffle, and a tile with very many polygons has several rows."""
    kind = dict(masks.dtypes)[zone]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            col, row = (batch.column(c).to_numpy() for c in ("col", "row"))
            new = np.concatenate([[True], (col[1:] != col[:-1]) | (row[1:] != row[:-1])])
            starts = np.flatnonzero(new)
            nth = np.arange(len(col)) - np.repeat(starts, np.diff([*starts, len(col)]))
            starts = np.flatnonzero(nth % TOGETHER == 0)
            each = pa.StructArray.from_arrays([batch.column(zone), batch.column("mask")], [zone, "mask"])
            lists = pa.ListArray.from_arrays(pa.array([*starts, len(col)], pa.int32()), each)
            yield pa.RecordBatch.from_arrays([pa.array(col[starts]), pa.array(row[starts]), lists], ["col", "row", "zones"])

    packed = masks.select("col", "row", zone, "mask").sortWithinPartitions("col", "row")
    return packed.mapInArrow(run, f"col int, row int, zones array<struct<{zone}: {kind}, mask: array<bigint>>>")


def _zone_parts(layer: Layer, edges: DataFrame, by_geometry: bool, band: int | None = None) -> DataFrame:
    """(geom_id | nothing, instant, band, cells, total, low, high): a row per tile, zone and band with
    data inside. Cells never become rows; the raster is not shuffled."""
    tiles = to_tiles(layer)
    layout, number = layer.meta.layout, layer.meta.cell_type.compute_type
    masks = tile_masks(polygon_spans(edges, layout), layout, by_geometry)
    zone = "geom_id"
    if not by_geometry:
        masks = masks.withColumn(zone, F.lit(0))
    area, most, each = tile_bound(edges, layout)
    zones = _packed(masks, zone)
    joined = lookup_join(near(tiles.df, layout, area), zones, ["col", "row"], "inner", mask_bytes(layout) * (TOGETHER if by_geometry else 1),
                         _spread(layer), ["zones"] if by_geometry else None, -(-each // TOGETHER) + most if by_geometry else most)
    instant = ["instant"] if layer.meta.temporal else []
    bands = F.col("bands") if band is None else F.array(F.get("bands", F.lit(band)))
    rows = joined.select(*instant, F.flatten(bands).cast(f"array<{number}>").alias("flat"), "zones").where("flat IS NOT NULL")
    types = dict(rows.dtypes)
    names = [zone, *instant, "band", "cells", "total", "low", "high"]
    kind = dict(masks.dtypes)[zone]
    tr, tc, per_row, first = layout.tile_rows, layout.tile_cols, -(-layout.tile_cols // WORD), band or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            values, ok, ends = read_cells(batch.column("flat"))
            out: list[tuple] = []
            times = batch.column("instant").to_pylist() if instant else None
            zones = pa.concat_arrays([batch.column("zones")])  # those of the part only
            parts, at = zones.values, zones.offsets.to_numpy()
            words = parts.field("mask")
            bits, starts = pc.fill_null(words.values, 0).to_numpy(zero_copy_only=False), words.offsets.to_numpy()
            zone_names = parts.field(zone).to_pylist()
            for i in range(len(batch)):
                v = values[ends[i]:ends[i + 1]].reshape(-1, tr, tc)
                data = ok[ends[i]:ends[i + 1]].reshape(-1, tr, tc)
                for k in range(at[i], at[i + 1]):
                    mask = np.unpackbits(bits[starts[k]:starts[k + 1]].astype("<u4").view(np.uint8), bitorder="little")
                    mask = mask.reshape(tr, per_row * WORD)[:, :tc].astype(bool)
                    lines = np.flatnonzero(mask.any(axis=1))
                    if not len(lines):
                        continue
                    cut = slice(lines[0], lines[-1] + 1)
                    for b in range(len(v)):
                        inside = v[b, cut][mask[cut] & data[b, cut]]
                        if len(inside):
                            out.append((zone_names[k], *((times[i],) if instant else ()), first + b, len(inside),
                                        inside.sum(), inside.min(), inside.max()))
            if out:
                cell = pa.int64() if number == "bigint" else pa.float64()
                kinds = [parts.field(zone).type, *[batch.schema.field(c).type for c in instant], pa.int32(), pa.int64(), cell, cell, cell]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    found = rows.mapInArrow(run, ", ".join([f"{zone} {kind}", *(f"{c} {types[c]}" for c in instant), "band int", "cells bigint",
                                            *(f"{c} {number}" for c in ("total", "low", "high"))]))
    return found if by_geometry else found.drop(zone)


def _total() -> Column:
    return F.sum("total")


def _mean() -> Column:
    return F.sum("total").cast("double") / F.sum("cells")


def _polygonal(layer: Layer, edges: DataFrame, agg: Column, by_geometry: bool) -> DataFrame:
    keys = (["geom_id"] if by_geometry else []) + (["instant"] if layer.meta.temporal else [])
    return _zone_parts(layer, edges, by_geometry).groupBy(*keys, "band").agg(agg.alias("value"))


def polygonal_min(layer: Layer, edges: DataFrame, by_geometry: bool = True) -> DataFrame:
    """Smallest value per band (and geometry). Without ``by_geometry`` all polygons are one zone."""
    return _polygonal(layer, edges, F.min("low"), by_geometry)


def polygonal_max(layer: Layer, edges: DataFrame, by_geometry: bool = True) -> DataFrame:
    return _polygonal(layer, edges, F.max("high"), by_geometry)


def polygonal_mean(layer: Layer, edges: DataFrame, by_geometry: bool = True) -> DataFrame:
    return _polygonal(layer, edges, _mean(), by_geometry)


def polygonal_sum(layer: Layer, edges: DataFrame, by_geometry: bool = True) -> DataFrame:
    return _polygonal(layer, edges, _total(), by_geometry)


def polygonal_summary(layer: Layer, edges: DataFrame, by_geometry: bool = True) -> DataFrame:
    """All zonal statistics in one pass."""
    keys = (["geom_id"] if by_geometry else []) + (["instant"] if layer.meta.temporal else [])
    return (_zone_parts(layer, edges, by_geometry).groupBy(*keys, "band")
            .agg(F.sum("cells").alias("cells"), F.min("low").alias("min"), F.max("high").alias("max"),
                 _total().alias("sum"), _mean().alias("mean")))


def polygonal_weighted(layer: Layer, edges: DataFrame) -> DataFrame:
    """(geom_id, [instant], band, weight, sum, mean): cells count by the share that the polygon covers.

    ``weight`` is the covered area of cells with data, in cells. A tile is summed along its rows once per
    polygon it meets, and a run of equal shares costs two lookups; cells never become rows. Polygons without
    data under them are left out. Rings of a polygon may run either way round but must not cross.
    """
    tiles = to_tiles(layer)
    layout = layer.meta.layout
    shares = tile_shares(coverage_spans(edges, layout), layout)
    area, _, each = tile_bound(edges, layout)
    joined = lookup_join(near(tiles.df, layout, area, 1), shares, ["col", "row"], "inner", 32 + 16 * layout.tile_cells,
                         _spread(layer), ["geom_id"], each)
    instant = ["instant"] if layer.meta.temporal else []
    rows = joined.select("geom_id", *instant, F.flatten("bands").cast("array<double>").alias("flat"), "shares")
    rows = rows.where("flat IS NOT NULL")
    types, names = dict(rows.dtypes), ["geom_id", *instant, "band", "weight", "total"]
    tr, tc = layout.tile_rows, layout.tile_cols

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            values, ok, ends = read_cells(batch.column("flat"))
            shares = pa.concat_arrays([batch.column("shares")])  # those of the part only
            runs, at = shares.values, shares.offsets.to_numpy()
            i, n, share = (runs.field(k).to_numpy() for k in range(3))
            which, bands, weights, totals = [], [], [], []
            for k in range(len(batch)):
                here = slice(at[k], at[k + 1])
                a, b, s = i[here], i[here] + n[here], share[here]
                y, a, b = a // tc, a % tc, b - a // tc * tc
                v = values[ends[k]:ends[k + 1]].reshape(-1, tr, tc)
                data = ok[ends[k]:ends[k + 1]].reshape(-1, tr, tc)
                summed = np.zeros((2, len(v), tr, tc + 1))
                np.cumsum(data, axis=2, out=summed[0, :, :, 1:])
                np.cumsum(np.where(data, v, 0), axis=2, out=summed[1, :, :, 1:])
                weight, total = ((summed[:, :, y, b] - summed[:, :, y, a]) * s).sum(axis=2)
                some = np.flatnonzero(weight > 0)
                which += [k] * len(some)
                bands += some.tolist()
                weights += weight[some].tolist()
                totals += total[some].tolist()
            if which:
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(which)) for c in ("geom_id", *instant)), pa.array(bands, pa.int32()),
                     pa.array(weights, pa.float64()), pa.array(totals, pa.float64())], names)

    parts = rows.mapInArrow(run, ", ".join([*(f"{c} {types[c]}" for c in names[:-3]), "band int, weight double, total double"]))
    return parts.groupBy("geom_id", *instant, "band").agg(
        F.sum("weight").alias("weight"), F.sum("total").alias("sum"), (F.sum("total") / F.sum("weight")).alias("mean"))


def _series(layer: Layer, edges: DataFrame, agg: Column, band: int) -> DataFrame:
    if not layer.meta.temporal:
        raise ValueError("a series needs a temporal layer")
    return _zone_parts(layer, edges, False, band).groupBy("instant").agg(agg.alias("value")).orderBy("instant")


def sum_series(layer: Layer, edges: DataFrame, band: int = 0) -> DataFrame:
    """Sum per instant over the union of the polygons; overlaps count once."""
    return _series(layer, edges, _total(), band)


def min_series(layer: Layer, edges: DataFrame, band: int = 0) -> DataFrame:
    return _series(layer, edges, F.min("low"), band)


def max_series(layer: Layer, edges: DataFrame, band: int = 0) -> DataFrame:
    return _series(layer, edges, F.max("high"), band)


def mean_series(layer: Layer, edges: DataFrame, band: int = 0) -> DataFrame:
    return _series(layer, edges, _mean(), band)


def histogram_series(layer: Layer, edges: DataFrame, band: int = 0) -> DataFrame:
    """Exact histogram rows (instant, value, count)."""
    cells = _zone_cells(layer, edges, False, band)
    return (cells.groupBy("instant", F.col("v").alias("value"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("instant", "value"))


def filter_by_geometry(layer: Layer, edges: DataFrame | None = None,
                       points: DataFrame | None = None) -> Layer:
    """Tiles that polygons touch or points fall in.

    The bounding box of the geometry becomes a range predicate on the keys that reaches the scan
    before the join.
    """
    if (edges is None) == (points is None):
        raise ValueError("give edges or points")
    layout = layer.meta.layout
    df = near(layer.df, layout, envelope(edges if edges is not None else points)[0])
    wanted = (tiles_for_geometry(edges, layout).select("col", "row").distinct()
              if edges is not None else tiles_for_points(points, layout))
    return layer.with_df(lookup_join(df, wanted, ["col", "row"], "left_semi", 16, _spread(layer)))


def crop(layer: Layer, extent: Extent) -> Layer:
    """Cells whose centre lies in the extent; keys outside are pruned by a range predicate."""
    layout = layer.meta.layout
    bounds = layout.key_bounds(extent)
    if bounds is None:
        return layer.with_df(layer.df.where("false"), extent=extent)
    c0, r0, c1, r1 = bounds
    x, y = layout.centre_of(F.col("x"), F.col("y"))
    inside = ((x >= extent.xmin) & (x < extent.xmax) & (y > extent.ymin) & (y <= extent.ymax))
    if layer.kind == "cell":
        return layer.with_df(layer.df.where(inside), extent=extent)
    df = layer.df.where(F.col("col").between(c0, c1) & F.col("row").between(r0, r1))

    def keep(v: Column, i: Column) -> Column:
        tx, ty = layout.place_of(i)
        gx, gy = layout.centre_of(F.col("col") * layout.tile_cols + tx,
                                  F.col("row") * layout.tile_rows + ty)
        return F.when((gx >= extent.xmin) & (gx < extent.xmax)
                      & (gy > extent.ymin) & (gy <= extent.ymax), v)

    bands = F.transform("bands", lambda b: F.transform(b, keep))
    return layer.with_df(df.withColumn("bands", bands), extent=extent)


def point_values(layer: Layer, points: DataFrame, method: str = "NearestNeighbor") -> DataFrame:
    """Value of every band at every point: ``(point_id, x, y, [instant], values ARRAY<DOUBLE>)``.

    Points off the layer get NULL values. Point methods take the weighted mean of the data cells
    around the point, so only the cells a point needs are touched.
    """
    tiles = to_tiles(layer)
    layout, tc, tr = layer.meta.layout, layer.meta.layout.tile_cols, layer.meta.layout.tile_rows
    instant = ["instant"] if layer.meta.temporal else []
    gx, gy = layout.to_grid(F.col("x"), F.col("y"))
    places = points.select("point_id", gx.alias("gx"), gy.alias("gy"))
    if method == "NearestNeighbor":
        taps = places.select("point_id", F.floor("gx").alias("cx"), F.floor("gy").alias("cy"),
                             F.lit(1.0).alias("weight"))
    else:
        a = support(method)
        ux, uy = F.col("gx") - 0.5, F.col("gy") - 0.5
        steps = F.sequence(F.lit(1 - a), F.lit(a))
        taps = (places.withColumn("dx", F.explode(steps)).withColumn("dy", F.explode(steps))
                .select("point_id", (F.floor(ux) + F.col("dx")).alias("cx"),
                        (F.floor(uy) + F.col("dy")).alias("cy"),
                        *[(kernel_weight(m, ux - F.floor(ux) - F.col("dx"))
                           * kernel_weight(m, uy - F.floor(uy) - F.col("dy"))).alias(name)
                          for m, name in ((method, "weight"), ("Bilinear", "tent"))])
                .where("weight <> 0"))
    col, row = layout.key_of(F.col("cx"), F.col("cy"))
    weights = [c for c in ("weight", "tent") if c in taps.columns]
    taps = taps.select("point_id", *weights, col.alias("col"), row.alias("row"),
                       layout.index_of(F.col("cx"), F.col("cy")).alias("i"))
    # many points: hot tiles are split, the tiles go where their points are
    reach = 0 if method == "NearestNeighbor" else support(method)
    area, n = envelope(points)
    met = lookup_join(near(tiles.df, layout, area, reach + 1), taps, ["col", "row"], "inner", 40,
                      _spread(layer), ["point_id", "i"], n * max(1, 4 * reach * reach))
    if method == "NearestNeighbor":
        values = F.transform("bands", lambda b: F.get(b, F.col("i")).cast("double"))
        found = met.select("point_id", *instant, values.alias("values"))
    else:
        per_band = unnest(met, ["point_id", *instant, *weights, "i"], "bands", "band", "cells")
        v = F.get("cells", F.col("i"))
        sums = (per_band.select("point_id", *instant, "band",
                                F.when(v.isNotNull(), F.col("weight")).alias("w"),
                                (v * F.col("weight")).alias("wv"),
                                F.when(v.isNotNull(), F.col("tent")).alias("t"),
                                (v * F.col("tent")).alias("tv"))
                .groupBy("point_id", *instant, "band")
                .agg(*[F.sum(c).alias(c) for c in ("wv", "w", "tv", "t")]))
        # too little weight on data cells: bilinear weights, so that no point these fill is lost
        value = (F.when(F.col("w") > least_weight(method), F.col("wv") / F.col("w"))
                 .when(F.col("t") > least_weight("Bilinear"), F.col("tv") / F.col("t")))
        # one slot per band: bounded by the band count of the layer
        found = (sums.withColumn("value", value).groupBy("point_id", *instant)
                 .agg(*[F.max(F.when(F.col("band") == b, F.col("value"))).alias(f"b{b}")
                        for b in range(layer.meta.bands)])
                 .select("point_id", *instant,
                         F.array(*[F.col(f"b{b}") for b in range(layer.meta.bands)])
                         .alias("values")))
    return points.select("point_id", "x", "y").join(found, "point_id", "left")


def extent_zone(layer: Layer, extent: Extent) -> DataFrame:
    """The extent as an edge table."""
    return extent_edges(layer.base.sparkSession, extent)
